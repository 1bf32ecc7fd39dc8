"""Sinks (S3, S8, S9). Writers keep the partitioning of the data they are given: no ``coalesce(1)``, which would
funnel a whole job into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewright.config import ID_COL
from scorewright.sources.tables import CSV_SCHEMAS, RAW_ID


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """S3: snappy Parquet, one file per task."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header row (the raw-file layout the ETL reads with ``tables.read_csv``)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_raw_csv(df: DataFrame, path: str, name: str) -> None:
    """A table in the raw layout of ``tables.CSV_SCHEMAS[name]``: its id column, its column order, dates as yyyymmdd."""
    schema = CSV_SCHEMAS[name]
    raw = df.withColumnRenamed(ID_COL, RAW_ID)
    dates = {f.name for f in raw.schema.fields if f.dataType.typeName() == "date"}
    write_csv(raw.select(*(F.date_format(c, "yyyyMMdd").cast("int").alias(c) if c in dates else F.col(c) for c in schema.names)), path)


def append_job_metrics(metrics: DataFrame, path: str) -> None:
    """One row per timed job, appended."""
    metrics.write.mode("append").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, partitions: int | None = None,
               batch_size: int = 10_000) -> None:
    """Predictions to a relational store, for users who keep one: batched inserts from every task in parallel
    (``numPartitions`` caps concurrent connections). Not exercised here: no database may be started in this
    environment; the Parquet tables are the primary store."""
    w = df if partitions is None else df.repartition(partitions)
    w.write.mode("append").option("batchsize", batch_size).jdbc(url, table, properties=properties)
