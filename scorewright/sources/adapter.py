"""Adapter from the driver's TPC-H-style tables to the scoring data model (labels, members, transactions).

Mapping (fixed values, chosen once and documented in FIXTURES.md):
    members.customer_id      = customer.c_custkey as text; rows with c_custkey % 10 = 9 are absent
    members.city             = c_nationkey
    members.bd               = floor(c_acctbal / 80)           (dirty on purpose: negatives and > 100)
    members.gender           = c_mktsegment
    members.registered_via   = c_custkey % 5
    members.registration_init_time = yyyymmdd of 1990-01-01 + (c_custkey * 37) % 3650 days;
                               20000230 (not a date) when c_custkey % 97 = 0
    transactions             = one row per order: key o_custkey, id o_orderkey, date o_orderdate
    payment_method_id        = first character of o_orderpriority
    plan_list_price          = sum of l_extendedprice of the order (exact cents), 0 without lines
    actual_amount_paid       = sum of l_extendedprice * (1 - l_discount), rounded to cents, 0 without lines
    payment_plan_days        = sum of l_quantity, 0 without lines
    membership_expire_date   = transaction_date + payment_plan_days
    is_auto_renew / is_cancel = o_orderstatus = 'P' / = 'F'
    labels.is_churn          = 1 when the customer has no order after the reference date
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.sources.tables import read_table

MONEY = "decimal(18,2)"
REGISTRATION_BASE = dt.date(1990, 1, 1)
INVALID_REGISTRATION = 20000230


def _next_day_ts(d: dt.date, df: DataFrame, column: str) -> F.Column:
    """Start of the day after ``d`` as a literal of the column's own timestamp type, so a cutoff on it stays a
    plain range predicate that the Parquet scan receives as a pushed filter."""
    nxt = d + dt.timedelta(days=1)
    return F.lit(f"{nxt:%Y-%m-%d} 00:00:00").cast(df.schema[column].dataType)


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    reg = F.date_add(F.lit(REGISTRATION_BASE), ((F.col("c_custkey") * 37) % 3650).cast("int"))
    return c.filter(F.col("c_custkey") % 10 != 9).select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_nationkey").cast("int").alias("city"),
        F.floor(F.col("c_acctbal") / 80).cast("int").alias("bd"),
        F.col("c_mktsegment").alias("gender"),
        (F.col("c_custkey") % 5).cast("int").alias("registered_via"),
        F.when(F.col("c_custkey") % 97 == 0, F.lit(INVALID_REGISTRATION))
        .otherwise(F.date_format(reg, "yyyyMMdd").cast("int"))
        .alias("registration_init_time"),
    )


def _cents(c: str) -> F.Column:
    """A 2-decimal money column as exact integer cents (long arithmetic: no BigDecimal, fixed-width buffers)."""
    return F.round(F.col(c) * F.lit(100)).cast("long")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order line totals. Aggregated before the join so the big side shuffles one row per order (partial agg).
    Amounts are exact: list price in cents, paid in 1/10 000 units (cents x discount percent), summed as longs."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_discount", "l_quantity"])
    price = _cents("l_extendedprice")
    paid = price * (F.lit(100) - _cents("l_discount"))
    return li.groupBy("l_orderkey").agg(
        F.sum(price).alias("list_cents"),
        F.sum(paid).alias("paid_units"),
        F.sum(F.col("l_quantity").cast("int")).alias("qty"),
    )


def transactions(spark: SparkSession, sf_dir: str, cutoff: dt.date | None = None) -> DataFrame:
    """One transaction per order. ``cutoff`` (inclusive) becomes a range filter on the raw timestamp, so it reaches
    the Parquet scan as a pushed filter instead of running after a full read."""
    o = read_table(
        spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]
    )
    if cutoff is not None:
        o = o.filter(F.col("o_orderdate") < _next_day_ts(cutoff, o, "o_orderdate"))
    lines = order_lines(spark, sf_dir)
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    tdate = F.col("o_orderdate").cast("date")
    days = F.coalesce(F.col("qty"), F.lit(0)).cast("int")
    return j.select(
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderkey").alias("transaction_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_method_id"),
        (F.coalesce(F.col("list_cents"), F.lit(0)).cast("decimal(18,0)") / 100).cast(MONEY).alias("plan_list_price"),
        days.alias("payment_plan_days"),
        # half-up to cents: (units + 50) div 100 on non-negative amounts, exact
        (
            ((F.coalesce(F.col("paid_units"), F.lit(0)) + 50) - F.pmod(F.coalesce(F.col("paid_units"), F.lit(0)) + 50, F.lit(100)))
            .cast("decimal(20,0)") / 10000
        ).cast(MONEY).alias("actual_amount_paid"),
        (F.col("o_orderstatus") == "P").cast("int").alias("is_auto_renew"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_cancel"),
        tdate.alias("transaction_date"),
        F.date_add(tdate, days).alias("membership_expire_date"),
    )


def labels(spark: SparkSession, sf_dir: str, reference_date: dt.date) -> DataFrame:
    """Customer universe with the churn label: 1 when no order falls after the reference date."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey"]).select(
        F.col("c_custkey").cast("string").alias("customer_id")
    )
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    active = (
        o.filter(F.col("o_orderdate") >= _next_day_ts(reference_date, o, "o_orderdate"))
        .groupBy(F.col("o_custkey").cast("string").alias("customer_id"))
        .agg(F.lit(0).alias("is_churn"))
    )
    return c.join(active, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("is_churn"), F.lit(1)).cast("int").alias("is_churn")
    )
