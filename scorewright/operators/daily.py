"""Customer features kept by day (A1-A4): partial states that any later cutoff is merged from.

A state holds what the rollup of transactions needs and can be merged: counts, exact sums, extremes and the packed key of
the latest transaction with what it passes on. One row a customer and day is written once; a table rolled up to a
cutoff has the same columns, so the next night merges it with one day's states instead of reading all transactions.
Late rows are states like any others. Where a day is written anew (a correction), its customers alone are merged again
from their days, because an extreme cannot be taken back.

Sums are of integers (decimals as unscaled numbers), so the order of merging changes nothing; every buffer has a fixed
width and combines on the map side, so a customer with a third of all transactions is one row per task and day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import ID_COL
from scorewright.functions.exprs import as_date, date_lit
from scorewright.operators.etl import latest_key, tie_break

SUMS = ["n", "paid", "list_price", "plan_days", "n_auto_renew", "n_cancels"]
PASSED_ON = ["payment_method_id", "is_auto_renew", "is_cancel"]
STATE_COLUMNS = [ID_COL, *SUMS, "first_txn", "last_expire", "latest", *PASSED_ON]
MONEY_SCALE = 2  # digits after the point that money is kept with


def _cents(name: str, kind: T.DataType) -> Column:
    """Money as a whole number of its last digit; a plain integer has no digits after the point."""
    if isinstance(kind, T.DecimalType) and kind.scale > MONEY_SCALE:
        raise ValueError(f"{name} has {kind.scale} digits after the point, {MONEY_SCALE} are kept")
    return F.round(F.col(name) * 10**MONEY_SCALE, 0).cast("long")


def _merged(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in SUMS),
        F.min("first_txn").alias("first_txn"),
        F.max("last_expire").alias("last_expire"),
        F.max("latest").alias("_latest"),
        *(F.max_by(c, "latest").alias(c) for c in PASSED_ON),
    ).withColumnRenamed("_latest", "latest")


def day_states(tx: DataFrame) -> DataFrame:
    """One state per customer and ``day``. Transactions without customer or date belong to no day."""
    kinds = {f.name: f.dataType for f in tx.schema.fields}
    day, expire = as_date("transaction_date", kinds["transaction_date"]), as_date("membership_expire_date", kinds["membership_expire_date"])
    rows = tx.filter(F.col(ID_COL).isNotNull() & day.isNotNull()).select(
        ID_COL,
        day.alias("day"),
        F.lit(1).cast("long").alias("n"),
        _cents("actual_amount_paid", kinds["actual_amount_paid"]).alias("paid"),
        _cents("plan_list_price", kinds["plan_list_price"]).alias("list_price"),
        F.col("payment_plan_days").cast("long").alias("plan_days"),
        F.col("is_auto_renew").cast("long").alias("n_auto_renew"),
        F.col("is_cancel").cast("long").alias("n_cancels"),
        day.alias("first_txn"),
        expire.alias("last_expire"),
        latest_key(day, tie_break(tx.columns)).alias("latest"),
        *PASSED_ON,
    )
    return _merged(rows, [ID_COL, "day"])


def write_days(states: DataFrame, path: str, late: bool = False) -> None:
    """Day states by month, sorted by day: a night's filter prunes months by folder and days by row group. The months in
    ``states`` are replaced, so they come whole; ``late`` rows are added to what is there instead."""
    by_month = states.withColumn("month", F.date_format("day", "yyyy-MM"))
    by_month = by_month.repartition("month", F.pmod(F.xxhash64(ID_COL), F.lit(8)))  # a month is up to eight files
    out = by_month.sortWithinPartitions("month", "day", ID_COL).write.mode("append" if late else "overwrite")
    out.option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def days_between(days: DataFrame, after: dt.date | None, upto: dt.date) -> DataFrame:
    """The states of the days after ``after`` up to and with ``upto``; months are named so that folders are pruned."""
    d = days.filter((F.col("day") <= date_lit(upto)) & (F.col("month") <= upto.strftime("%Y-%m")))
    return d if after is None else d.filter((F.col("day") > date_lit(after)) & (F.col("month") >= after.strftime("%Y-%m")))


def roll(*states: DataFrame) -> DataFrame:
    """One state per customer, merged from tables of states (rolled ones, days, late rows)."""
    whole = states[0].select(*STATE_COLUMNS)
    for s in states[1:]:
        whole = whole.unionByName(s.select(*STATE_COLUMNS))
    return _merged(whole, [ID_COL]).select(*STATE_COLUMNS)


def correct(rolled: DataFrame, days: DataFrame, customers: DataFrame, upto: dt.date) -> DataFrame:
    """``rolled`` after days up to ``upto`` were written anew: the states of ``customers`` (those in the old or the new form
    of these days) are merged again from their days, the others stay. A customer without a day left has no state."""
    changed = customers.select(ID_COL).distinct()
    kept = rolled.join(changed, ID_COL, "left_anti").select(*STATE_COLUMNS)
    again = days_between(days, None, upto).join(changed, ID_COL, "left_semi")
    return kept.unionByName(roll(again))


def features(rolled: DataFrame, reference_date: dt.date) -> DataFrame:
    """A4's columns from states rolled up to the reference date."""
    money = lambda c: c.cast("double") / float(10**MONEY_SCALE)
    paid, listed = money(F.col("paid")), money(F.col("list_price"))
    return rolled.select(
        ID_COL,
        F.col("n").cast("int").alias("n_transactions"),
        paid.alias("total_paid"),
        (listed / F.col("n")).alias("avg_plan_price"),
        (F.col("plan_days").cast("double") / F.col("n")).alias("avg_plan_days"),
        F.col("n_auto_renew").cast("int").alias("n_auto_renew"),
        F.col("n_cancels").cast("int").alias("n_cancels"),
        "payment_method_id",
        F.col("is_auto_renew").alias("last_is_auto_renew"),
        F.col("is_cancel").alias("last_is_cancel"),
        (listed - paid).alias("total_discount"),
        F.datediff("last_expire", "first_txn").alias("membership_tenure_days"),
        F.datediff("last_expire", date_lit(reference_date)).alias("days_to_expire"),
    )
