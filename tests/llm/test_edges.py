"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from scorewright.llm import bpe, decontam, fingerprint, lang_id, license_scan, line_dedup, pii, quality, simhash, token_count
from scorewright.llm import queries as Q

LONG = "alpha beta gamma. " * 30_000
ROWS = [(None, None, None, None), (None, "", "en", "s"), (1, None, "en", None), (2, "", None, "s"), (3, "   \n\t ", "en", "s"), (4, LONG, "en", "s"), (5, "twice told tale", "fr", "s"), (5, "twice told tale", "fr", "s"), (5, "another text", "fr", "s"), (6, "!!! 123 ???", "en", "s")]
CLASH = ["row", "at", "n", "len", "hash", "own", "key1", "KEY2", "fp", "node", "root", "part", "tail", "tie", "score", "spans", "N_card", "n_lines", "matches", "word", "template", "label", "ids", "decoded", "_matches", "hit_words", "dropped", "draw", "h1", "w", "items"]


def documents(spark, rows, clash=False):
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return d.select("*", *(F.lit(7).alias(c) for c in CLASH)) if clash else d


def bench(spark, rows=((1, "alpha beta gamma. alpha beta"), (2, None), (3, ""), (None, "twice told"), (4, "told tale"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def labels(spark, rows=((4, 1, 0), (5, 0, 0), (5, 1, 0), (6, None, 1), (None, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def op8(s, d):
    return quality.score(d, quality.learn(d, labels(s), F.lit(True)))


OPERATORS = {
    "op1": lambda s, d: lang_id.label_languages(d, lang_id.learn(d, F.lit(True))),
    "op2": lambda s, d: token_count.count_tokens(d, P.path(Q.COUNT_VOCABULARY), 10),
    "op3": lambda s, d: license_scan.scan(d),
    "op4": lambda s, d: bpe.decode(bpe.encode(d, P.path(Q.BPE_RANKS)), P.path(Q.BPE_RANKS)),
    "op5": lambda s, d: decontam.scan(d, bench(s)),
    "op6": lambda s, d: simhash.near_duplicates(d, 4, 4),
    "op7": lambda s, d: line_dedup.drop_frequent_lines(d, 1, 2),
    "op8": op8,
    "op9": lambda s, d: fingerprint.fingerprint_edits(d),
    "op10": lambda s, d: pii.pseudonymise(d, "k"),
}


def rows_of(df, names):
    return sorted((tuple(str(r[n]) for n in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_rows_and_clashing_names(spark, name):
    op = OPERATORS[name]
    plain = op(spark, documents(spark, ROWS))
    own = [c for c in plain.columns if c not in ("lang", "source", "n_chars")]
    got = rows_of(plain, own)
    assert sorted(r[own.index("doc_id")] for r in got) == sorted(str(r[0]) for r in ROWS)
    assert rows_of(op(spark, documents(spark, ROWS, clash=True)), own) == got


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).count() == 0


def test_nothing_to_learn_from(spark):
    d = documents(spark, ROWS)
    assert {(r.lang_pred, r.score) for r in lang_id.label_languages(d, lang_id.learn(d, F.lit(False))).collect()} == {("und", 0.0)}
    assert {r.score for r in quality.score(d, quality.learn(d, labels(spark, []), F.lit(True))).collect()} == {0.5}
    assert {r.n_hit for r in decontam.scan(d, bench(spark, [])).collect()} == {0}


def test_defined_values(spark):
    d = documents(spark, ROWS)
    lang = {(r.doc_id, r.lang_pred) for r in OPERATORS["op1"](spark, d).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (6, "und"), (4, "en")} <= lang
    lines = {(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in OPERATORS["op7"](spark, d).collect()}
    assert {(1, 1, 0, ""), (3, 2, 0, "   \n\t "), (5, 1, 1, ""), (5, 1, 0, "another text")} <= lines
    hits = {(r.doc_id, r.n_words, r.n_hit, ",".join(r.item_ids)) for r in OPERATORS["op5"](spark, d).collect()}
    assert {(5, 3, 3, "4"), (5, 2, 0, ""), (1, 0, 0, ""), (4, 90_000, 90_000 - 1, "1")} <= hits
