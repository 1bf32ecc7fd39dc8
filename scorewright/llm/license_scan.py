"""Licence scan by a positional index of rare licence words.

Each template's words have an inverse document frequency over the whole corpus; its rarest ones are its anchors and
their postings (template, position) form the index. Every place of an anchor in a file proposes an alignment of the
template; an alignment that all anchors of the template propose is a candidate, and its mandatory phrases are verified
word by word. A phrase that is mandatory as a whole is thus found at every place.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import words

ANCHORS = 3


@dataclass(frozen=True)
class Template:
    """A licence notice. ``mandatory``: phrases of the text that must stand where the alignment puts them."""

    label: str
    text: str
    mandatory: tuple[str, ...]


# Wording of public licences and of their usual notices. The first three are wholly mandatory.
BASE = (
    Template("mit", "under the mit license", ("under the mit license",)),
    Template("apache-2", "apache license version 2", ("apache license version 2",)),
    Template("cc-by-nc", "cc by nc", ("cc by nc",)),
)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "to any person obtaining a copy")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify and or distribute", "with or without fee")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "are permitted provided that")),
    Template("gpl-2", "gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3", "gnu general public license version 3", ("gnu general public license version 3",)),
    Template("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl-3", "gnu affero general public license version 3", ("gnu affero general public license",)),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    Template("epl-2", "eclipse public license v 2 0", ("eclipse public license v 2 0",)),
    Template("cc-by-sa", "creative commons attribution sharealike", ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "creative commons attribution noncommercial", ("creative commons attribution noncommercial",)),
    Template("cc0", "cc0 1 0 universal", ("cc0 1 0 universal",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "released into the public domain")),
)


def document_counts(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """In how many documents each licence word stands: one number for each of a few dozen words."""
    found = F.array_intersect(words(F.col(text)), F.array(*map(F.lit, vocabulary)))  # each word once
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return {r.word: r.n for r in counts.collect()}


def spans(template: Template) -> list[tuple[int, int]]:
    """First word and length of each mandatory phrase."""
    its, out = template.text.split(), []
    for phrase in template.mandatory:
        p = phrase.split()
        out.append((next(i for i in range(len(its)) if its[i : i + len(p)] == p), len(p)))
    return out


def anchors(template: Template, counts: dict[str, int]) -> list[int]:
    """Places of the rarest words of the mandatory phrases, one place a word; ties go to the earlier word. What holds
    the phrases has them all."""
    its = template.text.split()
    first = {its[i]: i for a, n in reversed(spans(template)) for i in reversed(range(a, a + n))}
    return sorted(sorted(first.values(), key=lambda i: (counts.get(its[i], 0), i))[:ANCHORS])


def index(docs: DataFrame, templates: tuple[Template, ...], base: int, text: str = "text") -> DataFrame:
    """Postings of the anchors: word, place in the template, and what verification needs. A few dozen rows."""
    counts = document_counts(docs, sorted({w for t in templates for w in t.text.split()}), text)
    rows, most = [], most_phrases(templates)
    for number, t in enumerate(templates):
        its = t.text.split()
        if not t.mandatory:
            raise ValueError(f"{t.label}: no mandatory phrase")
        chosen = anchors(t, counts)
        rows += [(its[i], number, t.label, number < base, i, len(chosen), its, *chain(*(spans(t) * most)[:most])) for i in chosen]
    schema = "word string, template int, label string, base boolean, offset int, need int, its array<string>" + "".join(f", at{k} int, n{k} int" for k in range(most))
    return docs.sparkSession.createDataFrame(rows, schema)


def most_phrases(templates: tuple[Template, ...]) -> int:
    return max((len(t.mandatory) for t in templates), default=0)


def _phrases(most: int) -> Column:
    """Whether the file's words at an alignment have all mandatory phrases of the template. One condition a phrase:
    F.forall is interpreted and would copy all words of the file for each."""
    same = (F.slice("w", F.col("start") + F.col(f"at{k}") + 1, F.col(f"n{k}")) == F.slice("its", F.col(f"at{k}") + 1, F.col(f"n{k}")) for k in range(most))
    return reduce(and_, same, F.lit(True))


def scan(docs: DataFrame, base: tuple[Template, ...] = BASE, more: tuple[Template, ...] = NOTICES, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words and matches, an array of (label, base, start, share): every verified
    place of a template, its first word and the share of the template's words that stand where they should.

    Null and empty texts have no words and no matches; repeated rows and rows without doc_id are each scanned; other
    columns are left out. All templates and all places count.
    """
    postings = F.broadcast(index(docs, (*base, *more), len(base), text))
    d = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words(F.col(text)).alias("w"))
    # Place -1 stands for the document itself, so that one without matches has a row.
    d = d.select("*", F.size("w").alias("n"), F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    d = d.withColumn("word", F.when(F.col("at") < 0, F.lit("")).otherwise(F.get("w", F.col("at"))))
    d = d.join(postings, "word", "left").where((F.col("at") < 0) | F.col("template").isNotNull())
    d = d.withColumn("start", F.col("at") - F.col("offset"))
    inside = (F.col("start") >= 0) & (F.col("start") + F.size("its") <= F.col("n"))
    d = d.where((F.col("at") < 0) | (inside & F.when(inside, _phrases(most_phrases((*base, *more)))).otherwise(False)))
    aligned = F.when(F.col("at") >= 0, F.slice("w", F.col("start") + 1, F.size("its")))
    d = d.select("row", "doc_id", "n", "template", "label", "base", "start", "need", "its", aligned.alias("own"))
    d = d.groupBy("row", "doc_id", "n", "template", "start").agg(F.first("label").alias("label"), F.first("base").alias("base"), F.first("need").alias("need"), F.first("its").alias("its"), F.first("own").alias("own"), F.count("*").alias("votes"))
    d = d.where(F.col("template").isNull() | (F.col("votes") == F.col("need")))
    same = F.size(F.filter(F.zip_with("own", "its", lambda a, b: a == b), lambda x: x))
    match = F.when(F.col("template").isNotNull(), F.struct("label", "base", "start", (same / F.size("its")).alias("share")))
    d = d.select("row", "doc_id", "n", match.alias("match"))
    per = d.groupBy("row", "doc_id", "n").agg(F.array_sort(F.collect_list("match")).alias("matches"))
    return per.select("doc_id", F.col("n").cast("long").alias("n_words"), "matches")
