"""Language identification of mixed texts.

The scripts of a word's letters narrow its candidate languages to those that use them. Each language has a
log-probability for every hashed n-gram of letters (one to three, with word ends marked) and for whole words; a word's
score is their sum. Viterbi decoding over the words, with a penalty for each switch of language, labels spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import bound_batches, by_bytes, texts

BUCKETS = 1 << 16
MAX_LEARNED = 3000  # texts of each language that the sample aims at, whatever the size of the table
PENALTY = 12.0  # cost of a switch, in nats
SCALE = 0.4  # of scores: the n-grams of a word overlap
SMOOTH = 0.5
UNDETERMINED = "und"
BATCH = 2 << 20

# First and last code point of the ranges of letters of a script. Anything else is OTHER.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "ethiopic": ((0x1200, 0x139F),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)),
}
OTHER = len(SCRIPTS)


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: 0 or the lower-case letter, and its script."""
    letter, script = np.zeros(0x110000, np.uint32), np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        if unicodedata.category(x := chr(c))[0] == "L":
            low = x.lower()
            letter[c] = ord(low) if len(low) == 1 else c
    for i, ranges in enumerate(SCRIPTS.values()):
        for a, b in ranges:
            script[a : b + 1] = i
    return letter, script


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)


@dataclass
class Words:
    """The words of several texts: n-gram buckets of each letter, word starts, sizes and places."""

    grams: list[np.ndarray]
    start: np.ndarray
    size: np.ndarray
    whole: np.ndarray
    script: np.ndarray
    place: np.ndarray
    owner: np.ndarray


def split(items: list[str]) -> Words:
    """Words (runs of letters) of the texts and the buckets of their n-grams."""
    letter, script = tables()
    joined = "\n".join(items) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)) + 1)
    low = letter[points]
    at = np.flatnonzero(low)
    # Letters side by side, one gap between words: a gap is 0 and marks word ends in the n-grams.
    new = np.append(True, np.diff(at) > 1)[: len(at)]
    word = np.cumsum(new) - 1
    spread = np.arange(len(at)) + word + 1
    x = np.zeros(len(at) + (word[-1] + 1 if len(at) else 0) + 2, np.uint64)
    x[spread] = low[at]
    a, b, c = x[spread - 1], x[spread], x[spread + 1]
    with np.errstate(over="ignore"):
        two = a * np.uint64(0x100000001B3) + b + np.uint64(1 << 40)
        three = (two * np.uint64(0x9E3779B97F4A7C15) + c) * np.uint64(0xC2B2AE3D27D4EB4F)
        grams = [_bucket(b * np.uint64(0x9E3779B97F4A7C15)), _bucket(two * np.uint64(0xC2B2AE3D27D4EB4F)), _bucket(three)]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        power = (np.arange(len(at)) - np.repeat(first, size)).astype(np.uint64)
        each = (b + np.uint64(7)) * (power * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93) | np.uint64(1))
        whole = _bucket(np.add.reduceat(each, first) * np.uint64(0x2545F4914F6CDD1D)) if len(first) else np.zeros(0, np.int64)
    return Words(grams, first, size, whole, script[points[at[first]]], at[first], np.searchsorted(ends, at[first], side="right"))


@dataclass
class Model:
    """Log-probabilities by bucket and language, and which scripts a language uses."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray

    def word_scores(self, w: Words) -> np.ndarray:
        """Score of each word in each language; a language that lacks the word's script is out of the question,
        unless all lack it."""
        if not len(w.start):
            return np.zeros((0, len(self.languages)), np.float32)
        total = self.logs[w.grams[0]]
        total += self.logs[w.grams[1]]
        total += self.logs[w.grams[2]]
        out = np.add.reduceat(total, w.start, axis=0) + self.logs[w.whole]
        out *= SCALE
        allowed = self.scripts[w.script]
        allowed = allowed | ~allowed.any(1, keepdims=True)
        return np.where(allowed, out, out.min(1, keepdims=True) - 1e4).astype(np.float32)


def viterbi(scores: np.ndarray, first: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Best label of each word, for texts whose words start at ``first``. All texts advance together, longest first."""
    label = np.zeros(len(scores), np.int16)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    if not len(order):
        return label
    begin, length = first[order], n[order]
    active = np.searchsorted(-length, -np.arange(length[0]), side="left")
    best = scores[begin].astype(np.float64)
    stayed = np.ones(scores.shape, bool)
    top = np.zeros(len(scores), np.int16)
    for t in range(1, length[0]):
        k = active[t]
        at, b = begin[:k] + t, best[:k]
        peak = b.argmax(1)
        highest = b[np.arange(k), peak]
        switch = highest[:, None] - penalty
        stay = b >= switch
        stayed[at], top[at] = stay, peak
        best[:k] = np.where(stay, b, switch) + scores[at] - highest[:, None]
    current = best.argmax(1)
    for t in range(length[0] - 1, -1, -1):
        k = active[t]
        at = begin[:k] + t
        label[at] = now = current[:k]
        current[:k] = np.where(stayed[at, now], now, top[at])
    return label


def learn(docs: DataFrame, eligible, text: str = "text", limit: int = MAX_LEARNED) -> Model:
    """Model of the rows for which ``eligible`` holds and whose lang and text are not null.

    About ``limit`` texts of each language are drawn by a hash of doc_id; fewer are all taken. Their n-grams are
    counted in the tasks, so the driver receives BUCKETS numbers a language at most."""
    known = docs.where(eligible & F.col("lang").isNotNull() & F.col(text).isNotNull()).select("lang", F.col(text).alias("text"), (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 20)) / (1 << 20)).alias("draw"))
    many = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(many)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((OTHER + 1, 0), bool))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, limit / many[k])))
    drawn = known.where(F.col("draw") < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, items = batch.column("lang").to_pylist(), texts(batch)
            for lang in set(langs):
                n = totals.setdefault(lang, np.zeros(BUCKETS + OTHER + 1, np.int64))
                own = [x for x, y in zip(items, langs) if y == lang]
                for a, b in by_bytes(own, BATCH):
                    w = split(own[a:b])
                    for g in (*w.grams, w.whole):
                        n[:BUCKETS] += np.bincount(g, minlength=BUCKETS)
                    n[BUCKETS:] += np.bincount(w.script, minlength=OTHER + 1)
        for lang, n in totals.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "bucket", "n"])

    counts = np.zeros((BUCKETS + OTHER + 1, len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    summed = drawn.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    for r in summed.toLocalIterator():
        counts[r.bucket, place[r.lang]] = r.n
    grams, scripts = counts[:BUCKETS] + SMOOTH, counts[BUCKETS:]
    logs = np.log(grams / grams.sum(0))
    return Model(languages, logs.astype(np.float32), scripts > 0.01 * scripts.sum(0))


def label(items: list[str], model: Model) -> tuple[list[str], list[float], list[list[dict]]]:
    """Language, score and spans of each text. The language has the most letters; the score is its share of them."""
    w = split(items)
    languages, n = len(model.languages), np.bincount(w.owner, minlength=len(items))
    first = np.cumsum(n) - n
    if not languages:
        return [UNDETERMINED] * len(items), [0.0] * len(items), [[] for _ in items]
    found = viterbi(model.word_scores(w), first, n)
    letters = np.bincount(w.owner * languages + found, weights=w.size, minlength=len(items) * languages).reshape(-1, languages)
    best, total = letters.argmax(1), letters.sum(1)
    lang = [model.languages[b] if t else UNDETERMINED for b, t in zip(best.tolist(), total.tolist())]
    score = (letters.max(1) / np.maximum(total, 1)).tolist()
    turn = np.flatnonzero(np.append(True, (np.diff(found) != 0) | (np.diff(w.owner) != 0))[: len(found)])
    base = np.cumsum(np.fromiter(map(len, items), np.int64, len(items)) + 1)
    base = np.append(0, base[:-1]) if len(items) else base
    last = np.append(turn[1:], len(found))[: len(turn)] - 1
    owner = w.owner[turn]
    start, stop = w.place[turn] - base[owner], w.place[last] + w.size[last] - base[owner]
    spans: list[list[dict]] = [[] for _ in items]
    for o, a, b, k in zip(owner.tolist(), start.tolist(), stop.tolist(), found[turn].tolist()):
        spans[o].append({"start": a, "stop": b, "lang": model.languages[k]})
    return lang, score, spans


def label_languages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and spans (code points from start to before stop, and their language).

    Text that is null or has no letters is `und` with score 0 and no spans. Ties go to the language first in order.
    Rows come out one for one, also repeated ones and those without doc_id; other columns are left out, whatever their
    names. Without any text to learn from, every text is `und`.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers a language
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = texts(batch)
            for a, b in by_bytes(items, BATCH):
                lang, score, spans = label(items[a:b], shared.value)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, span)], ["doc_id", "lang_pred", "score", "spans"])

    kept = docs.select("doc_id", F.col(text).alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>")
