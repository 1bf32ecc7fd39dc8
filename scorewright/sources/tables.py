"""Scans (S1, S2, S2b) with explicit schemas for text sources and column pruning for Parquet.

Parquet carries its own schema, so scans only select the columns an operator needs; Catalyst turns the ``select`` and
any ``filter`` into ``ReadSchema`` / ``PushedFilters`` of the file scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scorewright.config import ID_COL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

RAW_ID = "msno"  # fixed value: the id column of the raw files

# Raw CSV layouts of the three source files (S1): labels, members, transactions. Dates arrive as int yyyymmdd.
LABELS_CSV = T.StructType([T.StructField(RAW_ID, T.StringType()), T.StructField("is_churn", T.IntegerType())])
MEMBERS_CSV = T.StructType(
    [
        T.StructField(RAW_ID, T.StringType()),
        T.StructField("city", T.IntegerType()),
        T.StructField("bd", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("registered_via", T.IntegerType()),
        T.StructField("registration_init_time", T.IntegerType()),
    ]
)
TRANSACTIONS_CSV = T.StructType(
    [
        T.StructField(RAW_ID, T.StringType()),
        T.StructField("payment_method_id", T.IntegerType()),
        T.StructField("plan_list_price", T.DecimalType(18, 2)),
        T.StructField("payment_plan_days", T.IntegerType()),
        T.StructField("actual_amount_paid", T.DecimalType(18, 2)),
        T.StructField("is_auto_renew", T.IntegerType()),
        T.StructField("is_cancel", T.IntegerType()),
        T.StructField("transaction_date", T.IntegerType()),
        T.StructField("membership_expire_date", T.IntegerType()),
    ]
)
CSV_SCHEMAS = {"labels": LABELS_CSV, "members": MEMBERS_CSV, "transactions": TRANSACTIONS_CSV}


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan, pruned to ``columns`` when given."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"{name} lacks columns {missing}")
        df = df.select(*columns)
    return df


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """CSV with a declared schema (never inferred) whose header must name the same columns in the same order; a
    malformed row or another header fails the job. The raw id column becomes ``customer_id`` (P6)."""
    df = (
        spark.read.schema(CSV_SCHEMAS[name])
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return df.withColumnRenamed(RAW_ID, ID_COL)


def raw_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels, members and transactions from a folder that holds one CSV file or folder of each name."""
    return tuple(read_csv(spark, os.path.join(folder, name), name) for name in CSV_SCHEMAS)
