"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are parted into m groups. If two fingerprints differ in at most D bits and thresholds t_1..t_m sum to
D - m + 1, then in some group i they differ in at most t_i bits (a group with -1 is never looked at). Correlated bits
go into one group, so that the groups tell fingerprints apart independently; m follows from the number of distinct
fingerprints by a cost model. Each fingerprint takes the thresholds that cost it least, found by dynamic programming
over the candidate counts estimated from per-group histograms of all fingerprints, so common values are avoided. It
then probes the values within t_i of its own, and each candidate is verified on all 64 bits.

Equal fingerprints are one node, so a group of copies costs one row. A value that many distinct fingerprints share
has a pivot: what lies within D of the pivot is linked to it and need not be compared among itself, only with the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from scorewright.llm.common import bound_batches, row_key, stored, texts
from scorewright.llm.components import components

SEED = 42
BITS = 64
TOP = 16  # bits of a group that its histogram counts
CELLS = 22  # bits of the presence map of a group's values
CROWD = 64  # members from which a group value has a pivot
STEP = 1 << 16  # shingles that are unpacked at once


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of the shingles of a text; no words give 0."""
    words = text.encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    norm = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(size + 1) - size - 1
    k = min(shingle, len(words))
    first, stop = start[: len(words) - k + 1].tolist(), (start + size)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(first), STEP):
        h = np.array([digest(norm[a:b], SEED) for a, b in zip(first[i : i + STEP], stop[i : i + STEP])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(first), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``ids`` and fp (the fingerprint as a signed long) for every row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, shingle) for x in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ids), pa.array(fps.view(np.int64))], [*ids, "fp"])

    kept = docs.select(*ids, F.col(text).alias("text"))
    return kept.mapInArrow(run, StructType([*(kept.schema[c] for c in ids), StructField("fp", LongType())]))


def ball(width: int, radius: int) -> int:
    return sum(math.comb(width, d) for d in range(radius + 1))


def groups_for(n: int, distance: int) -> int:
    """Number of bit groups with the least expected probes and candidates for n distinct fingerprints."""

    def cost(m: int) -> float:
        width = BITS / m
        total = distance - m + 1
        each = [total // m + (i < total % m) for i in range(m)]
        probes = sum(ball(round(width), t) for t in each)
        return probes * (1 + n / 2**width)

    return min(range(1 + (distance > 0), distance + 2), key=cost)


def bit_groups(agree: np.ndarray, m: int) -> list[list[int]]:
    """Bits in m groups of nearly equal size, each grown by the bit most correlated with those in it."""
    left, out = set(range(BITS)), []
    for i in range(m):
        size = BITS // m + (i < BITS % m)
        group = [min(left)]
        left.discard(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: agree[b, group].sum())
            group.append(best)
            left.discard(best)
        out.append(sorted(group))
    return out


def values(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """The number that the bits of a group form."""
    out = np.zeros(len(fps), np.int64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << i
    return out


def masks(width: int, radius: int) -> np.ndarray:
    """All differences of exactly ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


def estimates(histogram: np.ndarray, width: int, distance: int) -> np.ndarray:
    """[t, v]: expected fingerprints within t of a value whose lowest TOP bits are v, for t up to ``distance``."""
    low = min(width, TOP)
    exact = [histogram.astype(float)]  # counts at exactly d bits, by one more bit at a time
    for bit in range(low):
        flipped = np.arange(1 << low) ^ (1 << bit)
        if bit == 0:
            ring = np.zeros((distance + 1, 1 << low))
            ring[0] = exact[0]
        ring = ring + np.vstack([np.zeros((1, 1 << low)), ring[:-1][:, flipped]])
    rest = width - low
    out = np.zeros_like(ring)
    for t in range(distance + 1):
        out[t] = sum(ring[d] * ball(rest, t - d) / 2**rest for d in range(t + 1))
    return out


def allocate(costs: list[list[np.ndarray]], distance: int) -> np.ndarray:
    """Thresholds by fingerprint and group that sum to distance - m + 1 at the least total cost. costs[i][t + 1]: cost
    of threshold t in group i."""
    m, n = len(costs), len(costs[0][0])
    want = distance + 1  # thresholds plus one sum to this
    best = np.full((want + 1, n), np.inf)
    best[0] = 0
    picks = []
    for group in costs:
        new, pick = np.full((want + 1, n), np.inf), np.zeros((want + 1, n), np.int8)
        for used in range(want + 1):
            for t in range(used + 1):
                better = (c := best[used - t] + group[t]) < new[used]
                new[used] = np.where(better, c, new[used])
                pick[used][better] = t
        best = new
        picks.append(pick)
    out, left, rows = np.zeros((n, m), np.int8), np.full(n, want), np.arange(n)
    for i in range(m - 1, -1, -1):
        out[:, i] = picks[i][left, rows] - 1
        left = left - picks[i][left, rows]
    return out


def _arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow over the batches' fp column as unsigned numbers; ``fn`` returns the columns of the schema."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for arrays in fn(batch.column("fp").to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names)

    return df.select("fp").mapInArrow(run, schema)


def bit_agreement(nodes: DataFrame) -> np.ndarray:
    """Absolute correlation of each two bits over all distinct fingerprints; each batch sends 64 x 64 counts."""

    def count(fps: np.ndarray):
        bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        yield np.arange(BITS * BITS), (bits.T @ bits).astype(np.int64).ravel()

    found = _arrow(nodes, count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for r in found:
        both[r.cell] = r.n
    both = both.reshape(BITS, BITS) / max(nodes.count(), 1)
    p = both.diagonal()
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return np.abs((both - np.outer(p, p)) / np.outer(spread, spread))


def histograms(nodes: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """Counts of the lowest TOP bits of each group's values: at most 65 536 numbers a group, whatever the input."""

    def count(fps: np.ndarray):
        for g, bits in enumerate(parts):
            v, n = np.unique(values(fps, bits) & ((1 << TOP) - 1), return_counts=True)
            yield np.full(len(v), g, np.int32), v, n

    out = [np.zeros(1 << min(len(b), TOP), np.int64) for b in parts]
    for r in _arrow(nodes, count, "g int, v long, n long").groupBy("g", "v").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.g][r.v] = r.n
    return out


def cell(v: np.ndarray) -> np.ndarray:
    """Place of a value in its group's presence map; values of up to CELLS bits have their own."""
    return (v ^ v >> CELLS) & ((1 << CELLS) - 1)


def presence(nodes: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """Which cells hold a value, as words of 64 bits: at most 65 536 words a group, whatever the input. A probe of an
    empty cell can find nothing and need not be sent."""

    def mark(fps: np.ndarray):
        for g, bits in enumerate(parts):
            c = np.unique(cell(values(fps, bits)))
            word, at = np.unique(c >> 6, return_index=True)
            ones = np.bitwise_or.reduceat(np.uint64(1) << (c & 63).astype(np.uint64), at) if len(c) else np.zeros(0, np.uint64)
            yield np.full(len(word), g, np.int32), word, ones.view(np.int64)

    out = [np.zeros(1 << (CELLS - 6), np.int64) for _ in parts]
    for r in _arrow(nodes, mark, "g int, word long, ones long").groupBy("g", "word").agg(F.bit_or("ones").alias("ones")).toLocalIterator():
        out[r.g][r.word] = r.ones
    return [x.view(np.uint64) for x in out]


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect all that differ in at most ``distance`` bits.

    Every edge is such a pair. Of the pairs among fingerprints near one pivot only those with the pivot are kept.
    """
    spark = nodes.sparkSession
    n = nodes.count()
    parts = bit_groups(bit_agreement(nodes), groups_for(max(n, 1), distance))
    tables = [estimates(h, len(b), distance) for h, b in zip(histograms(nodes, parts), parts)]
    shared = spark.sparkContext.broadcast((tables, presence(nodes, parts)))  # a few MB, whatever the input
    flips = [[masks(len(b), d) for d in range(distance + 1)] for b in parts]

    def own(fps: np.ndarray):
        for g, bits in enumerate(parts):
            yield np.full(len(fps), g, np.int32), values(fps, bits), fps.view(np.int64)

    def probe(fps: np.ndarray):
        near, there = shared.value
        mine = [values(fps, bits) for bits in parts]
        costs = []
        for g, bits in enumerate(parts):
            some = near[g][:, mine[g] & ((1 << min(len(bits), TOP)) - 1)]
            costs.append([np.zeros(len(fps)), *(some[t] + ball(len(bits), t) for t in range(distance + 1))])
        chosen = allocate(costs, distance)
        for g in range(len(parts)):
            for d in range(distance + 1):
                who, flip = np.flatnonzero(chosen[:, g] >= d), flips[g][d]
                step = max(1, (1 << 18) // max(1, len(flip)))
                for i in range(0, len(who), step):
                    v = (mine[g][who[i : i + step]][:, None] ^ flip[None, :]).ravel()
                    fp = np.repeat(fps[who[i : i + step]].view(np.int64), len(flip))
                    c = cell(v)
                    kept = (there[g][c >> 6] >> (c & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
                    yield np.full(kept.sum(), g, np.int32), v[kept], fp[kept]

    schema = "g int, v long, fp long"
    index = stored(_arrow(nodes, own, schema), "index")
    probes = _arrow(nodes, probe, schema).withColumnRenamed("fp", "q")
    apart = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    crowds = stored(index.groupBy("g", "v").agg(F.count("*").alias("n"), F.min("fp").alias("pivot")).where(F.col("n") >= CROWD).drop("n"), "crowds")
    # Side 0: members far from their crowd's pivot, and those of no crowd; 1: members near it; 2: the pivot itself.
    side = lambda c: F.when(apart(c, "pivot") <= distance, 1).otherwise(0)
    if crowds.isEmpty():
        index, probes = index.withColumn("side", F.lit(0)), probes.withColumn("side", F.lit(0))
    else:
        index = index.join(crowds, ["g", "v"], "left").select("g", "v", side("fp").alias("side"), "fp")
        index = index.unionByName(crowds.select("g", "v", F.lit(2).alias("side"), F.col("pivot").alias("fp")))
        sides = F.when(F.col("pivot").isNull(), F.array(F.lit(0))).when(side("q") == 1, F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))
        probes = probes.join(crowds, ["g", "v"], "left").select("g", "v", F.explode(sides).alias("side"), "q")
    found = probes.join(index, ["g", "v", "side"]).where((F.col("q") != F.col("fp")) & (apart("q", "fp") <= distance))
    return found.select(F.least("q", "fp").alias("u"), F.greatest("q", "fp").alias("v")).distinct()


def classes(prints: DataFrame, distance: int, first: Column) -> DataFrame:
    """fp, root and first for each distinct fingerprint: the component it is in and its least value of ``first``."""
    nodes = stored(prints.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    roots = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    return stored(nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "classes")


def near_duplicates(docs: DataFrame, shingle: int, distance: int, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row.

    Fingerprints that differ in at most ``distance`` bits are linked; component_id is the smallest doc_id that is
    reachable. Null and empty texts have fingerprint 0 and are linked like any other; rows without doc_id take part
    and get the component's smallest doc_id (null if none has one); repeated rows each get theirs; other columns are
    left out, whatever their names. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle, text), "prints")
    found = classes(prints, distance, F.col("doc_id"))
    lowest = found.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = found.join(lowest, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int, distance: int, text: str = "text") -> DataFrame:
    """One row of ``docs`` from each group of near-duplicates: that with the smallest doc_id.

    Rows without doc_id come after those with one; of rows that share a doc_id the one with the least hash stays, and
    of rows alike in doc_id and text the first met. All columns of ``docs`` stay, but for any named key1 or key2.
    """
    kept = [f"`{c}`" for c in docs.columns if c.lower() not in ("key1", "key2")]
    keyed = docs.select(*kept, *row_key(F.col(text), F.col("doc_id")))
    prints = stored(fingerprints(keyed, shingle, text, ("doc_id", "key1", "key2")), "prints")
    found = classes(prints, distance, F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key1", "key2"))
    stay = found.groupBy("root").agg(F.min("first").alias("first")).select("first.key1", "first.key2")
    rows = prints.groupBy("key1", "key2").agg(F.count("*").alias("n"))
    out = keyed.join(stored(rows.join(stay, ["key1", "key2"], "left_anti").drop("n"), "copies"), ["key1", "key2"], "left_anti")
    if not rows.where("n > 1").join(stay, ["key1", "key2"], "left_semi").isEmpty():
        out = out.dropDuplicates(["key1", "key2"])
    return out.select(*kept)
