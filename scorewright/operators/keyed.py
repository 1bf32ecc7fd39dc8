"""Tables kept by key (W1, W8): Parquet files bucketed and sorted by customer, with Bloom filters on the customer.

A bucketed table joins another by customer without a shuffle of its own rows, and the lookup of one customer opens the
one file of that customer's bucket. The catalog entry that tells Spark the bucketing lives in the session, so the
number of buckets is kept beside the files and any later session declares the table anew. Files and folder stay plain
Parquet that every reader understands.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession

from scorewright.config import ID_COL

ROWS_PER_BUCKET = 2_000_000  # about 100 MB of scores a file
MIN_BUCKETS = 8
NOTE = "_keyed.json"


def buckets_for(rows: int) -> int:
    """A power of two, so that a table of more buckets still joins one of fewer without moving it."""
    n = MIN_BUCKETS
    while n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def _file(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _name(path: str) -> str:
    return "keyed_" + hashlib.md5(path.encode()).hexdigest()


def write_keyed(df: DataFrame, path: str, buckets: int, key: str = ID_COL, moved: bool = True) -> None:
    """Writes ``df`` as a table keyed by ``key`` at ``path``, replacing what is there. ``moved`` False says that every
    partition of ``df`` holds one bucket already (it comes from a join with a keyed table of as many buckets), so that
    nothing is shuffled; otherwise rows are first brought to their buckets, and each bucket is one file."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")  # the entry alone: the table is external
    placed = df.repartition(buckets, key) if moved else df
    (
        placed.write.format("parquet")
        .mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(ROWS_PER_BUCKET))
        .option(f"parquet.bloom.filter.adaptive.enabled#{key}", "true")
        .saveAsTable(_name(path))
    )
    fs, at = _file(spark, os.path.join(path, NOTE))
    out = fs.create(at, True)
    out.write(bytearray(json.dumps({"key": key, "buckets": buckets}).encode()))
    out.close()


def keyed_note(spark: SparkSession, path: str) -> dict | None:
    """Key and number of buckets of the table at ``path``; None for files that are not keyed."""
    fs, at = _file(spark, os.path.join(path, NOTE))
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readNBytes(1 << 16)).decode())
    finally:
        stream.close()


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its bucketing declared, whichever session wrote it; plain Parquet if it has none."""
    note = keyed_note(spark, path)
    if note is None:
        return spark.read.parquet(path)
    if not spark.catalog.tableExists(_name(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        place = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {_name(path)} ({columns}) USING parquet CLUSTERED BY (`{note['key']}`) "
            f"SORTED BY (`{note['key']}`) INTO {int(note['buckets'])} BUCKETS LOCATION '{place}'"
        )
    return spark.table(_name(path))


def drop_keyed(spark: SparkSession, path: str) -> None:
    """Takes the table at ``path`` away, entry and files."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    fs, at = _file(spark, path)
    fs.delete(at, True)
