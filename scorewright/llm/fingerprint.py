"""Document fingerprints by invertible Bloom lookup sketches.

A text's paragraphs, cut further at sentence ends and, where a sentence is very long, at words chosen by their hash,
have 64-bit digests (a repeated paragraph's further occurrences have digests of their own). Each digest goes into one
cell of each of three subtables; a cell holds a count, the XOR of digests and the XOR of check values. Two sketches
subtract cell by cell, and peeling the cells that hold one digest recovers the digests in which the texts differ. If
peeling ends early, the pair is sketched again with more cells. All pairs of a batch are peeled together.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.llm.common import bound_batches, by_bytes

TABLES = 3
CELLS = 24  # of a fingerprint
LONG = 600  # characters from which a sentence is cut further
RANGES = 4  # ranges of doc_id for each shuffle partition

_PIECE = re.compile(r"[^\n.!?]+[\n.!?]*|[\n.!?]+")
_WORD = re.compile(r"\S*\s*")


def pieces(text: str) -> list[str]:
    """Paragraphs of a text, cut at sentence ends; together they are the text."""
    out = []
    for p in _PIECE.findall(text):
        if len(p) < LONG:
            out.append(p)
            continue
        start = 0
        for m in _WORD.finditer(p):
            if m.end() > start and (crc32(m[0].encode()) % 16 == 0 or m.end() == len(p)):
                out.append(p[start : m.end()])
                start = m.end()
    return out


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def digests(items: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the pieces of all texts in a row, all different within a text, and how many each text has."""
    cut = [pieces(x) for x in items]
    n = np.fromiter(map(len, cut), np.int64, len(cut))
    keys = np.fromiter((xxhash.xxh64_intdigest(p.encode()) for c in cut for p in c), np.uint64, int(n.sum()))
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    place = np.arange(len(k))
    first = np.append(True, (k[1:] != k[:-1]) | (o[1:] != o[:-1]))[: len(k)]
    again = place - np.maximum.accumulate(np.where(first, place, 0)) if len(k) else place
    out = np.empty_like(keys)
    out[order] = np.where(again > 0, mix(k ^ mix(again.astype(np.uint64), 9), 7), k)
    return out, n


def places(keys: np.ndarray, base: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """One cell in each subtable, for keys whose sketch starts at ``base`` and has ``cells`` cells."""
    each = (cells // TABLES).astype(np.uint64)
    return np.stack([base + ((mix(keys, j) % each).astype(np.int64) + j * each.astype(np.int64)) for j in range(TABLES)])


def check(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 5) >> np.uint64(32)).astype(np.uint32)


class Sketches:
    """Sketches of several sets of digests side by side; set i has cells[i] cells."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells
        self.base = np.cumsum(cells) - cells
        total = int(cells.sum())
        self.count, self.key, self.check = np.zeros(total, np.int32), np.zeros(total, np.uint64), np.zeros(total, np.uint32)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign: np.ndarray | int) -> np.ndarray:
        """Adds (sign 1) or takes away (-1) digests; returns the cells."""
        at = places(keys, self.base[owner], self.cells[owner])
        c = check(keys)
        for row in at:
            np.add.at(self.count, row, sign)
            np.bitwise_xor.at(self.key, row, keys)
            np.bitwise_xor.at(self.check, row, c)
        return at

    def text(self, i: int) -> str:
        """A sketch as a string."""
        a, b = self.base[i], self.base[i] + self.cells[i]
        return base64.b64encode(self.count[a:b].tobytes() + self.key[a:b].tobytes() + self.check[a:b].tobytes()).decode()

    def peel(self) -> tuple[np.ndarray, np.ndarray]:
        """Number of digests recovered from each sketch, and whether that is all of them."""
        found = np.zeros(len(self.cells), np.int64)
        owner = np.repeat(np.arange(len(self.cells)), self.cells)
        some = np.arange(len(self.count))
        while len(some):
            pure = some[(np.abs(self.count[some]) == 1) & (check(self.key[some]) == self.check[some])]
            keys, who, sign = self.key[pure], owner[pure], self.count[pure].copy()
            at = places(keys, self.base[who], self.cells[who])
            here = np.zeros(len(self.count), bool)
            here[pure] = True
            twin = ((at < pure) & here[at] & (self.key[at] == keys)).any(0)  # recovered from an earlier cell
            right = (at == pure).any(0) & ~twin
            keys, who, sign = keys[right], who[right], sign[right]
            if not len(keys):
                break
            found += np.bincount(who, minlength=len(found))
            some = np.unique(self.add(keys, who, -sign))
        rest = np.bincount(owner[(self.count != 0) | (self.key != 0)], minlength=len(found))
        return found, rest == 0


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each pair of digest sets: 1 less the share of digests that are in one only, by subtracting and peeling.

    The first try has as many cells as a fingerprint. A pair whose peeling ends early is sketched again, the second
    time with enough cells for wholly different sets, and then with twice as many each time."""
    (ka, na), (kb, nb) = a, b
    total, out = na + nb, np.ones(len(na))
    start_a, start_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    todo = np.flatnonzero(total > 0)
    cells = np.full(len(na), CELLS)
    while len(todo):
        s = Sketches(cells[todo])
        for keys, start, n, sign in ((ka, start_a, na, 1), (kb, start_b, nb, -1)):
            owner = np.repeat(np.arange(len(todo)), n[todo])
            within = np.arange(len(owner)) - np.repeat(np.cumsum(n[todo]) - n[todo], n[todo])
            s.add(keys[start[todo][owner] + within], owner, sign)
        found, whole = s.peel()
        done = todo[whole]
        out[done] = 1 - found[whole] / total[done]
        todo = todo[~whole]
        cells[todo] = np.maximum(2 * cells[todo], -(-total[todo] // 2) * TABLES)
    return out


def compare(rows: list[str], following: list[str]) -> dict[str, list]:
    """Result columns for texts and the text that follows each."""
    edited = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(rows, following)]
    own, other = digests(rows), digests(edited)
    after = digests(following)
    prints = []
    for keys, n in (own, other):
        s = Sketches(np.full(len(n), CELLS))
        s.add(keys, np.repeat(np.arange(len(n)), n), 1)
        prints.append([s.text(i) for i in range(len(n))])
    return {
        "n_chars": [len(x) for x in rows],
        "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edited],
        "fingerprint": prints[0],
        "edited_fingerprint": prints[1],
        "near_edited": likeness(own, other).tolist(),
        "near_next": likeness(own, after).tolist(),
    }


SCHEMA = pa.schema([("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def in_order(docs: DataFrame, text: str) -> DataFrame:
    """Rows by descending doc_id in ranges: part, tail, doc_id, text. A range's rows are in one partition, in order,
    and the first row of the next range follows them as its tail, so each row's successor is the row after it.

    Only doc_ids are read to find the ranges and their first rows, of which the driver gets one each. Rows without
    doc_id come last; those of one doc_id are in order of a hash of the text."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select("doc_id", content.alias("text"), F.xxhash64(content).alias("tie"))
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)
    step = max(1, int(len(cuts) ** 0.5))
    coarse, fine = cuts[step - 1 :: step], [cuts[i : i + step] for i in range(0, len(cuts), step)] + [[]]

    def array(xs: list) -> Column:
        kind = docs.schema["doc_id"].dataType
        return F.array(*(F.lit(x).cast(kind) for x in xs)) if xs else F.array().cast(f"array<{kind.simpleString()}>")

    above = lambda xs: F.size(F.filter(xs, lambda c: c > F.col("doc_id")))
    first = above(array(coarse))
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(first * step + above(F.get(F.array(*map(array, fine)), first)))
    keyed = keyed.withColumn("part", part)
    order = F.struct(F.coalesce(F.col("doc_id"), F.lit(0)).alias("doc_id"), "tie")
    heads = sorted((r.part, r.head.doc_id, r.head.tie) for r in keyed.groupBy("part").agg(F.max(order).alias("head")).collect())
    before = {p: heads[i - 1][0] for i, (p, _, _) in enumerate(heads)}  # the first range's head follows the last range
    table = spark.createDataFrame([(p, d, t, before[p]) for p, d, t in heads], f"part int, head_id {docs.schema['doc_id'].dataType.simpleString()}, head_tie long, before int")
    joined = keyed.join(F.broadcast(table), "part")
    is_head = (F.coalesce(F.col("doc_id"), F.lit(0)) == F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    here = F.struct(F.col("part"), F.lit(False).alias("tail"))
    copies = F.when(is_head, F.array(here, F.struct(F.col("before").alias("part"), F.lit(True).alias("tail")))).otherwise(F.array(here))
    rows = joined.select("doc_id", "text", "tie", F.explode(copies).alias("to")).select("to.part", "to.tail", "doc_id", "text", "tie")
    rows = rows.repartition(n // RANGES, "part").sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return rows.drop("tie")


def fingerprint_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for every row.

    A text's edited form has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the
    next document by descending doc_id, the first document following the last. Null text counts as empty; two texts
    without paragraphs are alike (1.0). Rows without doc_id come last; rows of one doc_id follow each other in order
    of a hash of their text, and repeated rows are each other's successors. A table of one row follows itself. Other
    columns are left out, whatever their names. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    rows = in_order(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose successor is not known yet
        for batch in batches:
            found = list(zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "doc_id", "text"))))
            if held is not None:
                found.insert(0, held)
            if not found:
                continue
            held = found[-1]
            # Rows of one range follow each other; of several tails (equal rows) the first is the successor.
            pairs = [(a, b) for a, b in zip(found, found[1:]) if a[0] == b[0] and not a[1]]
            for i, j in by_bytes([a[3] for a, _ in pairs]):
                out = compare([a[3] for a, _ in pairs[i:j]], [b[3] for _, b in pairs[i:j]])
                ids = pa.array([a[2] for a, _ in pairs[i:j]], batch.schema.field("doc_id").type)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(out[f.name], f.type) for f in SCHEMA)], ["doc_id", *SCHEMA.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
