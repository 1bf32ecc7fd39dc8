"""Phrase collocations by dynamic itemset counting.

Texts are encoded once, as hashes of their words, and dealt to SHARDS shards that are scanned in a cycle. All lengths are counted together: a phrase is
counted from the first scan before which the counts of both its subphrases (without its last and without its first
word) have reached the threshold, and for one whole cycle. So two-word phrases are counted while single words still
are, and a phrase that starts late ends as much later. The scans end when every phrase that was started has had its
cycle. Counts are those of hashed slots, which are never too low: what is frequent is found, whatever shares its slot.

A last scan then counts the phrases of the frequent slots as texts, which gives their exact counts.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.llm.common import A_Z, bound_batches, shared_dir, shuffles_end_with_jobs, stored
from scorewright.llm.slots import SLOT_BITS, count_slots, few_tasks, slots

SHARDS = 4
LONGEST = 5
NEVER = 255  # scan number of slots that are not frequent
ENDS = b".,;:!?\n\x0b\x0c\r"  # fixed: what ends a piece
SEPARATOR = re.compile(rb"[.,;:!?\n-\r]")
BORDER = b"."  # stands between pieces, and can't be a word
PLAIN = bytes.maketrans(ENDS + A_Z.encode(), BORDER * len(ENDS) + A_Z.lower().encode())
PART = 4 << 20  # bytes of a text that are split into words at once
WORDS_KEPT = 600_000  # hashes of words that a task keeps
FLUSH = 500_000  # phrases that a task holds before it passes them on
STEP = np.uint64(0xD6E8FEB86659FD93)  # fixed: an odd multiplier


class WordHashes(dict):
    """Hash of each word; the border has 0 and words never do."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = 0 if word == BORDER else xxhash.xxh64_intdigest(word) or 1
        return h


def parts(text: bytes) -> Iterator[bytes]:
    """Consecutive parts of about PART bytes that end at the end of a piece; a longer piece is a part of its own."""
    at = 0
    while len(text) - at > PART:
        cut = max(text.rfind(ENDS[i : i + 1], at, at + PART) for i in range(len(ENDS)))
        if cut < 0:
            after = SEPARATOR.search(text, at + PART)
            cut = after.start() if after else len(text)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


def pieces(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case, and a border after each piece."""
    return [*text.translate(PLAIN).replace(BORDER, b" . ").split(), BORDER]


class Places:
    """All places of a stretch of words where phrases may start, by length: ``keys[k]`` and ``valid[k]`` for phrases of
    k + 1 words. Equal phrases of a language have equal keys."""

    def __init__(self, hashes: np.ndarray, salts: np.ndarray) -> None:
        self.hashes = hashes
        self.keys, self.valid = [salts * STEP + hashes], [hashes != 0]

    def longer(self) -> None:
        k = len(self.keys)
        self.keys.append(self.keys[-1][:-1] * STEP + self.hashes[k:])
        self.valid.append(self.valid[-1][:-1] & self.valid[0][k:])


def salts(langs: list[str], lengths: list[int]) -> np.ndarray:
    """A hash of each word's language."""
    return np.repeat(np.array([xxhash.xxh64_intdigest(x) for x in langs], np.uint64), lengths)


def hashed(words: list[bytes], memo: WordHashes) -> np.ndarray:
    if len(memo) > WORDS_KEPT:
        memo.clear()
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, shard and words (hashes of 8 bytes, 0 at borders) for each text, or for each part of a long one."""
    memo = WordHashes()
    for batch in batches:
        rows: list[tuple[str, int, bytes]] = []
        size = 0
        for lang, shard, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "shard", "text"))):
            for part in parts(text.encode()):
                rows.append((lang, shard, hashed(pieces(part), memo).tobytes()))
                size += len(part)
                if size >= PART:
                    yield encoded_rows(rows)
                    rows, size = [], 0
        yield encoded_rows(rows)


def encoded_rows(rows: list[tuple[str, int, bytes]]) -> pa.RecordBatch:
    langs, shards, words = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(shards, pa.int32()), pa.array(words, pa.binary())], ["lang", "shard", "words"])


def active_slots(batch: pa.RecordBatch, first: np.ndarray, scan: int, shards: int, longest: int) -> Iterator[np.ndarray]:
    """Slots of the phrases that are counted in this scan. first: the scan from which a slot's supersets may start."""
    each = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("words")]
    if not each:
        return
    places = Places(np.concatenate(each), salts(batch.column("lang").to_pylist(), [len(x) for x in each]))
    own = slots(places.keys[0])
    if scan < shards:
        yield own[places.valid[0]]
    since = np.where(places.valid[0], first[own], NEVER)
    for k in range(1, longest):
        places.longer()
        start = np.maximum(since[:-1], since[1:])
        at = np.flatnonzero(places.valid[k] & (start < NEVER))
        if not len(at):
            return
        own, due = slots(places.keys[k][at]), start[at].astype(np.int16)
        yield own[(due <= scan) & (scan < due + shards)]
        since = np.full(len(start), NEVER, np.uint8)
        since[at] = np.maximum(first[own], start[at])  # a shared slot may be frequent before the phrase is counted


def frequent_slots(shard, shards: int, longest: int, least: int, spark) -> np.ndarray:
    """Which slots may hold phrases of at least ``least`` occurrences; ``shard(i)`` gives the rows of a shard.

    Phrases of k words that reach the threshold have all been started by scan shards * (k - 1), so no scan after
    shards * longest can add any."""
    if not 1 <= least < NEVER or shards * longest >= NEVER:
        raise ValueError("threshold, or shards times longest, beyond 254")
    total = np.zeros(1 << SLOT_BITS, np.uint8)
    first = np.full(1 << SLOT_BITS, NEVER, np.uint8)
    scan, last = 0, shards - 1
    while scan <= last:
        shared = spark.sparkContext.broadcast(first)  # 16 MB, whatever the input

        def found(batch: pa.RecordBatch, now: int = scan, shared=shared) -> Iterator[np.ndarray]:
            return active_slots(batch, shared.value, now, shards, longest)

        more = count_slots(shard(scan % shards), found, least, lambda n: np.minimum(n, least))
        total = np.minimum(total.astype(np.uint16) + more, least).astype(np.uint8)
        new = (total >= least) & (first == NEVER)
        first[new] = scan + 1
        if new.any():
            last = min(scan + shards, shards * longest - 1)
        shared.destroy()
        scan += 1
    return total >= least


def named_counts(docs: DataFrame, frequent, longest: int) -> DataFrame:
    """lang, phrase, size and n for the phrases of frequent slots, each batch's share of them; a row with a null phrase
    has the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, table, held = WordHashes(), frequent.value, Counter()

        def rows() -> pa.RecordBatch:
            langs, phrases, sizes = zip(*held)
            out = [pa.array(langs, pa.string()), pa.array([None if p is None else p.decode() for p in phrases], pa.string()), pa.array(sizes, pa.int32()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(out, ["lang", "phrase", "size", "n"])

        def count(words: list[bytes], langs: list[str], lengths: list[int]) -> None:
            places, ends = Places(hashed(words, memo), salts(langs, lengths)), np.cumsum(lengths)
            for lang, n in zip(langs, np.add.reduceat(places.valid[0].astype(np.int64), ends - lengths).tolist()):
                held[lang, None, 0] += n
            seen = np.flatnonzero(places.valid[0] & table[slots(places.keys[0])])
            for k in range(longest):
                if k:  # a phrase is frequent only if those without its last and without its first word are
                    places.longer()
                    seen = seen[:-1][np.diff(seen) == 1] if len(seen) else seen
                    seen = seen[places.valid[k][seen]]
                    seen = seen[table[slots(places.keys[k][seen])]]
                _, at, n = np.unique(places.keys[k][seen], return_index=True, return_counts=True)
                at = seen[at]
                for i, owner, c in zip(at.tolist(), np.searchsorted(ends, at, "right").tolist(), n.tolist()):
                    held[langs[owner], b" ".join(words[i : i + k + 1]), k + 1] += c

        for batch in batches:
            words: list[bytes] = []
            langs: list[str] = []
            lengths: list[int] = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for part in parts(text.encode()):
                    found = pieces(part)
                    words += found
                    langs.append(lang)
                    lengths.append(len(found))
                    if len(words) >= PART // 8:
                        count(words, langs, lengths)
                        words, langs, lengths = [], [], []
            if words:
                count(words, langs, lengths)
            if len(held) > FLUSH:
                yield rows()
                held.clear()
        if held:
            yield rows()

    return few_tasks(docs.select("lang", "text")).mapInArrow(run, "lang string, phrase string, size int, n long")


def phrase_counts(docs: DataFrame, least: int, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """lang, phrase, size (words) and n for the phrases of up to ``longest`` words that occur ``least`` times or more
    in a language, and a row with a null phrase and size 0 with the number of all words of each language."""
    spark = docs.sparkSession
    bound_batches(spark)
    path = os.path.join(shared_dir(spark), "llm", f"shards-{uuid.uuid4().hex}")
    whole = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"))
    schema = "lang string, shard int, words binary"
    with shuffles_end_with_jobs(spark):
        whole.mapInArrow(encode, schema).write.partitionBy("shard").option("compression", "none").parquet(path)
        coded = spark.read.schema(schema).parquet(path)
        shard = lambda i: coded.where(F.col("shard") == i).select("lang", "words")
        frequent = spark.sparkContext.broadcast(frequent_slots(shard, shards, longest, least, spark))
        counts = named_counts(whole, frequent, longest).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
        return stored(counts.where(F.col("phrase").isNull() | (F.col("n") >= least)), "phrases")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, longest: int = LONGEST, absorbed: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases.

    Pieces end at punctuation and line ends, words at blanks and tabs; A-Z is in lower case. A candidate has 2 to
    ``longest`` words and a >= ``least`` occurrences (overlapping ones count). Of its cuts into l (occurrences of the
    first part) and r (of the rest) the one with the least floor(1000 * a * n / (l * r)) counts, of equal ones the
    first; n is the language's number of words. Candidates that lie in a longer one with at least ``absorbed`` percent
    of their occurrences are dropped. Ranks are by score, then a, descending, then phrase in byte order.

    Null lang is ``und``; null and empty texts have no words; every row counts, repeated ones and those without doc_id
    too; other columns are left out. An empty table gives an empty result. A text's memory is that of 4 MB or of its
    longest piece.
    """
    counts = phrase_counts(docs, least, longest)
    totals = counts.where(F.col("phrase").isNull()).select("lang", F.col("n").alias("total"))
    known = counts.where(F.col("phrase").isNotNull())
    words = F.split("phrase", " ")
    join = lambda a, n: F.array_join(F.slice("words", a, n), " ")
    candidates = known.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("words"))

    inside = candidates.where(F.col("size") > 2).select("lang", "size", "a", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("len"))
    inside = inside.select("lang", "a", "words", "len", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("len") + 1)).alias("at"))
    inside = inside.select("lang", join(F.col("at"), F.col("len")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * absorbed))

    cuts = kept.join(totals, "lang").select("lang", "phrase", "a", F.col("total").alias("n"), "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "n", "k", join(F.lit(1), F.col("k")).alias("left"), join(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    side = lambda part, n: known.select("lang", F.col("phrase").alias(part), F.col("n").alias(n))
    cuts = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumn("up", F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).withColumn("down", wide("l") * wide("r"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("up div down").alias("score"), "k", "l", "r")).alias("cut"))
    order: list[Column] = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
