"""Removal of lines that recur in many documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import lower_ascii, row_key, stored

STRIPPED = " \t\n\x0b\f\r"  # fixed: what is stripped from both ends of a line
BROADCAST_LINES = 1_000_000  # hashes of 12 bytes; more lines than that are joined by a shuffle


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> list[Column]:
    """96 bits of a normalised line."""
    return [F.xxhash64(key).alias("h1"), F.hash(key).alias("h2")]


def frequent_lines(docs: DataFrame, min_chars: int, min_docs: int, text: str = "text") -> DataFrame:
    """Hashes of the normalised lines of at least ``min_chars`` code points that at least ``min_docs`` rows hold.

    A row's repeated lines count once, before anything is shuffled; the counts are combined per task, so a line that
    every document holds costs one row a task.
    """
    keys = F.transform(_lines(lower_ascii(F.col(text))), lambda x: F.btrim(x, F.lit(STRIPPED)))
    line = docs.select(F.explode(F.array_distinct(keys)).alias("line")).where(F.char_length("line") >= min_chars)
    counts = line.select(*_hashes(F.col("line"))).groupBy("h1", "h2").agg(F.count("*").alias("n"))
    return stored(counts.where(F.col("n") >= min_docs).select("h1", "h2"), "lines")


def drop_frequent_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without its frequent lines, and with n_lines (before) and n_dropped.

    A line's key is the line, stripped and with A-Z lower-cased; keys of at least ``min_chars`` code points that occur
    in at least ``min_docs`` documents lose all their lines everywhere, the others stay, joined by a line feed. Each
    row counts as one document, also when a doc_id repeats or is null. Null and empty texts have one empty line and
    come out empty. Columns of ``docs`` stay, but for those named n_lines, n_dropped or like the helper columns
    (key1, key2, dropped), which are replaced or left out. An empty table gives an empty result.
    """
    frequent = frequent_lines(docs, min_chars, min_docs, text)
    if frequent.count() <= BROADCAST_LINES:
        frequent = F.broadcast(frequent)
    doc, own = F.col(text), {"n_lines", "n_dropped", "key1", "key2", "dropped"}
    kept = [c for c in docs.columns if c.lower() not in own]
    keyed = docs.select(*[f"`{c}`" for c in kept], *row_key(doc, F.col("doc_id")))
    each = keyed.select("key1", "key2", F.posexplode(_lines(lower_ascii(doc))).alias("at", "line"))
    each = each.select("key1", "key2", "at", *_hashes(F.btrim("line", F.lit(STRIPPED))), F.char_length(F.btrim("line", F.lit(STRIPPED))).alias("n"))
    hits = each.where(F.col("n") >= min_chars).join(frequent, ["h1", "h2"], "left_semi")
    dropped = hits.groupBy("key1", "key2").agg(F.collect_set("at").alias("dropped"))
    joined = keyed.join(dropped, ["key1", "key2"], "left")
    lines, gone = _lines(doc), F.coalesce("dropped", F.array().cast("array<int>"))
    n = F.size(lines)
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), n - 1), gone))
    rest = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    out = [F.when(F.size(gone) == 0, F.coalesce(doc, F.lit(""))).otherwise(rest).alias(c) if c == text else F.col(f"`{c}`") for c in kept]
    return joined.select(*out, n.cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_dropped"))
