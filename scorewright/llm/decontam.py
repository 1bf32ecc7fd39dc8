"""Benchmark decontamination by a set of normalised n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import row_key, stored, words

WINDOW = 13
BROADCAST_WINDOWS = 200_000  # of about 150 bytes, and (window, item) pairs; more than that are joined by a shuffle
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # fixed: the words before A-Z are lower-cased


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of the items (number, length, hash and words), and the distinct pairs of a window's number and
    an item that holds it. An item of fewer words than ``window`` is one window; one without words has none. No row
    holds a list of items; items without id have no pairs."""
    w = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("at"))
    w = w.select("item_id", F.slice("w", F.col("at") + 1, window).alias("gram"))
    grams = w.select("gram").distinct().select(F.monotonically_increasing_id().alias("window"), F.size("gram").alias("len"), F.xxhash64("gram").alias("hash"), "gram")
    windows = bounded(stored(grams, "windows"))
    pairs = w.where(F.col("item_id").isNotNull()).distinct().join(windows, "gram").select("window", "item_id")
    return windows, bounded(stored(pairs, "window-items"))


def bounded(df: DataFrame) -> DataFrame:
    """``df``, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_WINDOWS else df


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, key1 and key2 (its row key), n_words, n_hit (words inside any occurrence of a
    window), item_ids (of items with occurring windows, sorted as strings) and spans of hit words.

    Each document gives one row for itself and one for every place of a window's length; places are looked up in the
    hash set of windows and verified word by word. All rows of a document come from one task and only itself and its
    hits, as places and window numbers, are shuffled; the items of each of its distinct windows are then looked up. Null and empty texts have no words and no hits; repeated rows and rows without doc_id are each
    scanned; other columns are left out. Items without words or without id hit as others do, the latter unlisted.
    """
    windows, pairs = item_windows(benchmark, window)
    lengths = sorted(r.len for r in windows.select("len").distinct().collect())  # at most ``window`` numbers
    d = docs.select("doc_id", *row_key(F.col("text"), F.col("doc_id")), F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("w"))
    d = d.select("*", F.size("w").alias("n"), F.explode(F.array(*map(F.lit, [0, *lengths]))).alias("len"))
    places = F.when(F.col("len") == 0, F.array(F.lit(-1))).when(F.col("n") >= F.col("len"), F.sequence(F.lit(0), F.col("n") - F.col("len")))
    d = d.select("*", F.explode(places).alias("at"))
    own = F.when(F.col("at") < 0, F.array().cast("array<string>")).otherwise(F.slice("w", F.col("at") + 1, F.col("len")))
    d = d.select("row", "doc_id", "key1", "key2", "n", "len", "at", own.alias("own"))
    d = d.withColumn("hash", F.when(F.col("at") < 0, F.col("row")).otherwise(F.xxhash64("own")))
    found = d.join(windows, (d.hash == windows.hash) & (d.len == windows.len) & (d.own == windows.gram), "left")
    found = found.where((F.col("at") < 0) | F.col("window").isNotNull())
    hit = F.when(F.col("at") >= 0, F.struct("at", (F.col("at") + d.len - 1).alias("last")))
    per = found.groupBy("row", "doc_id", "key1", "key2", "n").agg(F.collect_list(hit).alias("hits"), F.collect_set("window").alias("held"))
    per = stored(per, "hits")  # the numbers of rows stay
    items = per.select("row", F.explode("held").alias("window")).join(pairs, "window").groupBy("row", F.col("item_id").cast("string").alias("item")).agg(F.lit(1))
    per = per.join(items.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("item_ids")), "row", "left")
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda x: F.sequence(x["at"], x["last"]))))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return per.select("doc_id", "key1", "key2", F.col("n").cast("long").alias("n_words"), F.size(covered).cast("long").alias("n_hit"), ids.alias("item_ids"), F.array_sort(covered).alias("hit_words"))


def contaminated(share: int = 20) -> Column:
    """Whether at least one in ``share`` words of a scanned document is hit, and any at all."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, remove: str = "documents") -> DataFrame:
    """``docs`` without its contaminated documents, or (remove="spans") with the hit words of those cut out together
    with the separator after each. Other documents stay as they are; all columns of ``docs`` stay, but for any named
    like the helper columns key1, key2 and hit_words."""
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in ("key1", "key2", "hit_words")]
    keyed = docs.select(*kept, *row_key(F.col("text"), F.col("doc_id")))
    bad = scan(docs, benchmark, window).where(contaminated(share)).select("key1", "key2", "hit_words")
    if remove == "documents":
        return keyed.join(bad, ["key1", "key2"], "left_anti").select(*kept)
    joined = keyed.join(bad.dropDuplicates(["key1", "key2"]), ["key1", "key2"], "left")
    raw, between = F.regexp_extract_all("text", F.lit(RAW_WORD), F.lit(0)), F.split("text", RAW_WORD, -1)
    left = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(raw) - 1), F.col("hit_words")))
    text = F.concat(F.get(between, F.lit(0)), F.array_join(F.transform(left, lambda i: F.concat(F.get(raw, i), F.get(between, i + 1))), ""))
    text = F.when(F.col("hit_words").isNull(), F.col("text")).otherwise(text)
    return joined.select(*(text.alias("text") if c == "`text`" else F.col(c) for c in kept))
