"""Running totals over a sorted table without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.session import cut_lineage


def running_totals(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with running totals ``sums`` (column -> name) within ``group`` in ``order``, each row's own included.

    Rows are range-partitioned by (group, order) and written once, so a group of any size spans many tasks. The
    totals of the parts, a row each, give the offset of the next part; the rest is a window within a part. Rows equal
    in group and order must have been combined before.
    """
    keys = [F.col(g) for g in group]
    parts = cut_lineage(df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*group, "_part").agg(*(F.sum(c).alias(c) for c in sums))
    offsets = totals.select(*group, "_part", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_before_{c}") for c in sums))
    within = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = [(F.col(f"_before_{c}") + F.sum(c).over(within)).alias(name) for c, name in sums.items()]
    return parts.join(offsets, [*group, "_part"]).select(*df.columns, *out)
