"""Helpers that the operators share: table reads, written stages, Arrow batch bounds and column naming."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed: digits, lower-case ASCII letters and everything beyond ASCII

BATCH_ROWS = 4000
BATCH_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case and nothing else; a text of ASCII alone may take the faster general function."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, A_Z, A_Z.lower()))


def row_key(text: Column, doc_id: Column) -> list[Column]:
    """96 bits, never null, that tell rows apart by doc_id and text. Rows alike in both have one result and one key."""
    whole = [doc_id.isNull().cast("int"), doc_id, text.isNull().cast("int"), text]
    return [F.xxhash64(*whole).alias("key1"), F.hash(*whole).alias("key2")]


def replace_columns(df: DataFrame, **new: Column) -> DataFrame:
    """``df`` with the columns ``new``; columns of these names, in any case, make way."""
    names = {n.lower() for n in new}
    kept = [df[f"`{c}`"] for c in df.columns if c.lower() not in names]
    return df.select(*kept, *(c.alias(n) for n, c in new.items()))


def words(c: Column) -> Column:
    """Lower-cased words of a text; null has none."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(c, F.lit(""))), F.lit(WORD), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir). Only a local session may go without it."""
    at = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(at := f"/tmp/checkpoints/{uuid.uuid4().hex}")
    return at


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: its lineage ends there, so a lost executor
    costs at most the tasks of the running stage."""
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end_with_jobs(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes a job's shuffle files when the job ends, for code that runs no frame's plan twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(df: DataFrame) -> None:
    """Deletes the files of a ``stored`` table that is not needed any more."""
    spark = df.sparkSession
    kept = os.path.join(shared_dir(spark), "llm")
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if f"{kept.split(':', 1)[-1].rstrip('/')}/" in path.replace("//", "/"):
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of about BATCH_BYTES whatever the length of the texts, unless the launcher chose otherwise."""
    launched = spark.sparkContext.getConf()
    for k, v in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if not launched.contains(k := f"spark.sql.execution.arrow.{k}"):
            spark.conf.set(k, str(v))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def by_bytes(items: list[str], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of items of about ``limit`` characters each (one item may exceed it)."""
    start = size = 0
    for i, x in enumerate(items):
        if size and size + len(x) > limit:
            yield start, i
            start, size = i, 0
        size += len(x)
    if start < len(items):
        yield start, len(items)
