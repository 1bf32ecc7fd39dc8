"""Equality of tables as multisets of rows, by sums of row hashes.

A row's md5 is split into two numbers, and a table is the number of its rows and the two sums: the order of rows and the
way they are dealt change nothing, repeated rows count, and the rows themselves meet no shuffle (a task sends one row). Only where two tables
differ are sums taken per range of the hash, and only the rows of the ranges that differ are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGE_DIGITS = 3  # hex digits of the hash that name a range: 4096 ranges


def row_text(df: DataFrame, cols: list[str]) -> Column:
    """A row as text that no other row of these columns has: each value with its length, NULL apart. Zero has one sign, as
    in comparisons. Nested columns are refused."""
    parts = []
    for c in cols:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"{c} is nested")
        value = F.col(f"`{c}`")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            value = value + F.lit(0.0)
        text = F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def _hashed(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in cols), F.md5(row_text(df, cols)).alias("_hash"))


def _sums() -> list[Column]:
    half = lambda at: F.sum(F.conv(F.substring("_hash", at, 16), 16, 10).cast("decimal(20,0)"))
    return [F.count(F.lit(1)).alias("n"), half(1).alias("h1"), half(17).alias("h2")]


def fingerprint(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row: the number of rows and the two sums (0 without rows)."""
    sums = _hashed(df, cols or df.columns).agg(*_sums())
    return sums.select("n", *(F.coalesce(h, F.lit(0).cast("decimal(30,0)")).alias(h) for h in ("h1", "h2")))


def differences(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The distinct rows that the tables do not hold equally often, with ``n_a`` and ``n_b``, how often each holds them. Both
    tables are read once more where they differ, and of them only the rows of ranges that differ are shuffled."""
    cols = list(cols or a.columns)
    left, right = _hashed(a, cols), _hashed(b, cols)
    both = left.select("*", F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(right.select("*", F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    if fingerprint(a, cols).first() == fingerprint(b, cols).first():
        both = both.limit(0)
    else:
        part = F.substring("_hash", 1, RANGE_DIGITS)
        ranged = [t.groupBy(part.alias("_range")).agg(F.struct(*_sums()).alias(f"_{i}")) for i, t in enumerate((left, right))]
        unlike = ranged[0].join(ranged[1], "_range", "full").filter(~F.col("_0").eqNullSafe(F.col("_1"))).select("_range")
        both = both.join(F.broadcast(unlike), part == F.col("_range"), "left_semi")  # at most 4096 rows
    named = [F.col(f"`{c}`") for c in cols]
    out = both.groupBy("_hash", *named).agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b"))
    return out.filter(F.col("n_a") != F.col("n_b")).select(*named, "n_a", "n_b")
