"""Counters in a table of fixed size: what is counted is hashed to a slot, and the counts of a slot's members add up.

A slot's count is never below that of any member, so a table tells what may be frequent. Each task fills a table of its
own, whatever its input; tables are summed block by block. A table has 2^SLOT_BITS numbers, so its size does not grow
with the data; more members a slot make it less selective.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLOT_BITS = 24
BLOCK = 1 << 16  # slots of a block, the unit in which tables are summed
SPREAD = np.uint64(0x9E3779B97F4A7C15)  # fixed: 2^64 divided by the golden ratio


def slots(keys: np.ndarray) -> np.ndarray:
    """Slots of 64-bit keys."""
    return ((keys * SPREAD) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def few_tasks(df: DataFrame) -> DataFrame:
    """``df`` in at most two partitions a core: a task's counts are sent once, so longer tasks send less."""
    return df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)


def count_slots(df: DataFrame, found: Callable[[pa.RecordBatch], Iterator[np.ndarray]], limit: int, result: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """``result`` of the summed counts of all slots, as one byte each. ``found`` gives the slots that a batch counts.

    A task passes on up to ``limit`` a slot. ``result`` is applied to the sums of each block before they leave its task,
    so the driver gets at most 2^SLOT_BITS bytes, whatever the input.
    """
    kind = np.min_scalar_type(limit)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            for at in found(batch):
                np.add.at(table, at, 1)
        table = np.minimum(table, limit).astype(kind)
        used = np.flatnonzero(table.reshape(-1, BLOCK).any(axis=1))
        for i in range(0, len(used), 16):
            some = used[i : i + 16]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([table[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in some.tolist()], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, counts in zip(batch.column("block").to_pylist(), batch.column("counts")):
                if b not in sums:
                    sums[b] = np.zeros(BLOCK, np.int64)
                sums[b] += np.frombuffer(counts.as_buffer(), kind)
        out = [result(x).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(out, pa.binary())], ["block", "counts"])

    schema = "block long, counts binary"
    df = few_tasks(df)
    total = np.zeros(1 << SLOT_BITS, np.uint8)
    for r in df.mapInArrow(fill, schema).repartition("block").mapInArrow(add, schema).collect():
        total[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.counts, np.uint8)
    return total
