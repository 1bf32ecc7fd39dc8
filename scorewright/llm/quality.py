"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its words and their shapes (letters, case, digits and marks, runs collapsed), hashed into fixed
numbers of buckets, and how many words repeat the one before. Weighted by log count and inverse document frequency and
reduced by a truncated singular value decomposition, the terms give a latent vector. The vectors of a bounded labelled
sample are broadcast; for each batch of documents the cosines with all of them are exact products of blocks, and the
nearest neighbours vote with their similarity as weight.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from scorewright.llm.common import bound_batches, texts

SHAPES, WORDS = 1 << 10, 1 << 10
TERMS = SHAPES + WORDS + 1
MAX_LABELLED = 6000  # labelled rows the sample aims at, whatever the number of labels
DIMENSIONS = 48
NEIGHBOURS = 31
SHARPNESS = 8  # power of the cosine in a vote
BLOCK = 512  # documents by labelled vectors in one product
MAX_MEMO = 300_000

_MARKS = re.compile(r"[\W\d_]+")
_LETTERS, _DIGITS, _REPEATS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")
_memo: dict[str, int] = {}


def _case(letters: str) -> str:
    return "a" if letters.islower() else "A" if letters.isupper() and len(letters) > 1 else "Aa"


def shape(word: str) -> str:
    """A word with runs of letters as a, Aa or A, runs of digits as 9 and other repeats once."""
    if word.isalpha():
        return _case(word)
    return _REPEATS.sub(r"\1", _DIGITS.sub("9", _LETTERS.sub(lambda m: _case(m[0]), word)))


def _terms(word: str) -> int:
    stem = word if word.isalpha() else _MARKS.sub("", word) or word
    return crc32(shape(word).encode()) % SHAPES << 16 | crc32(stem.lower().encode()) % WORDS


def counts(text: str) -> np.ndarray:
    """Term counts of a text."""
    words = text.split()
    if len(_memo) > MAX_MEMO:
        _memo.clear()
    for w in set(words).difference(_memo):
        _memo[w] = _terms(w)
    codes = np.fromiter(map(_memo.__getitem__, words), np.int64, len(words))
    out = np.zeros(TERMS, np.float32)
    out[:SHAPES] = np.bincount(codes >> 16, minlength=SHAPES)
    out[SHAPES:-1] = np.bincount(codes & 0xFFFF, minlength=WORDS)
    out[-1] = sum(map(eq, words, words[1:]))
    return out


@dataclass
class Model:
    """Term weights, the projection to latent space, and the labelled unit vectors there."""

    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, rows: np.ndarray) -> np.ndarray:
        """Unit latent vectors of term counts; no terms give zeros."""
        x = profile(rows, self.weight) @ self.axes
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Share of the nearest neighbours' weight that has label 1; the mean label where nothing is similar."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if len(self.labels) == 0 or len(rows) == 0:
            return np.full(len(rows), prior)
        cosine = self.latent(rows) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(1)
        return np.where(total > 1e-12, (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-12), prior)


def profile(rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted unit vectors: shapes and words are each scaled to the text's length, so that long and short texts of
    one kind agree."""
    share = rows / np.maximum(rows[:, :SHAPES].sum(1, keepdims=True), 1)
    x = np.sqrt(share) * weight
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Model of the term counts of labelled texts."""
    if len(rows) == 0:
        return Model(np.zeros(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0))
    spread = np.log((1 + len(rows)) / (1 + (rows > 0).sum(0)))
    weight = np.where((rows > 0).any(0), spread + 0.2, 0).astype(np.float32)
    weight[SHAPES:-1] *= 0.3
    square = np.zeros((TERMS, TERMS))
    for i in range(0, len(rows), BLOCK):
        x = profile(rows[i : i + BLOCK], weight).astype(np.float64)
        square += x.T @ x
    axes = np.linalg.eigh(square)[1][:, ::-1][:, :DIMENSIONS].astype(np.float32)
    model = Model(weight, axes, np.zeros((0, DIMENSIONS), np.float32), labels.astype(np.float64))
    model.vectors = np.concatenate([model.latent(rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK)])
    return model


def learn(docs: DataFrame, labels: DataFrame, eligible: Column, text: str = "text", limit: int = MAX_LABELLED) -> Model:
    """Model of a sample of the labelled documents for whose doc_id ``eligible`` holds.

    About ``limit`` labels are drawn by a hash of doc_id; fewer are all taken. Only the drawn ids are joined with the
    texts, and only their term counts come to the driver. A doc_id labelled more than once has its lowest label, one with
    several rows gives one text, chosen by hash; null labels and null texts teach nothing."""
    known = labels.where(eligible & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    n = known.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 20)) / (1 << 20)
    drawn = F.broadcast(known.where(draw < limit / max(n, 1)))
    kept = docs.select("doc_id", F.col(text).alias("text")).where(F.col("text").isNotNull()).join(drawn, "doc_id")
    kept = kept.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.hash("text"))).alias("text")).select("doc_id", "text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(x) for x in texts(batch)]
            at = [np.flatnonzero(r).astype(np.int16) for r in rows]
            some = [pa.array([a.tobytes() for a in x], pa.binary()) for x in (at, [r[i] for r, i in zip(rows, at)])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("label"), *some], ["id", "label", "at", "n"])

    bound_batches(docs.sparkSession)
    found = sorted(kept.mapInArrow(count, "id string, label double, at binary, n binary").collect())
    rows = np.zeros((len(found), TERMS), np.float32)
    for row, r in zip(rows, found):
        row[np.frombuffer(r.at, np.int16)] = np.frombuffer(r.n, np.float32)
    return fit(rows, np.array([r.label for r in found], np.float64))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1 (higher: label 1 likelier).

    Null, empty and blank texts, and any when nothing was learned, have the mean label (0.5 without labels). Rows come
    out one for one; a column of ``docs`` named score is replaced, the others stay.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # limit x DIMENSIONS numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = texts(batch, text)
            found = [shared.value.scores(np.array([counts(x) for x in items[i : i + BLOCK]])) for i in range(0, len(items), BLOCK)]
            scores = pa.array(np.concatenate([np.zeros(0), *found]), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    kept = docs.select(*(docs[f"`{c}`"] for c in docs.columns if c.lower() != "score"))
    return kept.mapInArrow(run, StructType([*kept.schema.fields, StructField("score", DoubleType())]))
