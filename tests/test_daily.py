"""Features from states kept by day equal the rollup of all transactions, at any cutoff and after late or corrected rows."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from scorewright.operators import daily, etl

SCHEMA = ("customer_id string, payment_method_id int, plan_list_price decimal(18,2), payment_plan_days int, actual_amount_paid decimal(18,2), "
          "is_auto_renew int, is_cancel int, transaction_date date, membership_expire_date date, transaction_id long")
START = dt.date(2017, 1, 20)


def made(spark, n, seed, first_id=0):
    from decimal import Decimal

    r = random.Random(seed)
    day = lambda: START + dt.timedelta(r.randint(0, 59))
    money = lambda: r.choice([None, Decimal(r.randint(0, 99999)) / 100])
    # a third of the rows are one customer's; some have no customer or no date
    who = lambda: r.choice(["hot", "hot", "hot", f"u{r.randint(0, 9)}", f"u{r.randint(0, 9)}", f"u{r.randint(0, 9)}", f"u{r.randint(0, 9)}", None])
    rows = [(who(), r.randint(1, 9), money(), r.randint(0, 60), money(), r.randint(0, 1), r.randint(0, 1), r.choice([day(), day(), day(), None]), day(), first_id + i) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    assert a.columns == b.columns
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert key(a) == key(b)


def kept(spark, tx):
    path = tempfile.mkdtemp(prefix="scorewright-test-days-") + "/days"
    daily.write_days(daily.day_states(tx), path)
    return path


def test_any_cutoff_equals_the_full_rollup(spark):
    tx = made(spark, 400, 3)
    path = kept(spark, tx)
    days = spark.read.parquet(path)
    assert dict(days.dtypes)["month"] == "string"
    rolled, before = None, None
    for cutoff in (START, START + dt.timedelta(11), START + dt.timedelta(12), START + dt.timedelta(90)):
        new = daily.days_between(days, before, cutoff)
        rolled = daily.roll(new) if rolled is None else daily.roll(rolled, new)
        same(daily.features(rolled, cutoff), etl.aggregate_transactions(tx, cutoff))
        before = cutoff
    one = daily.days_between(days, START + dt.timedelta(10), START + dt.timedelta(11))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(day)" in plan
    assert {r[0] for r in one.select("month").distinct().collect()} == {"2017-01"}


def test_late_and_corrected_rows(spark):
    tx, late, cutoff = made(spark, 300, 4), made(spark, 60, 5, 10_000), START + dt.timedelta(40)
    path = kept(spark, tx)
    rolled = daily.roll(daily.days_between(spark.read.parquet(path), None, cutoff))
    states = daily.day_states(late)
    both = tx.unionByName(late)
    same(daily.features(daily.roll(rolled, states.filter(F.col("day") <= F.lit(cutoff))), cutoff), etl.aggregate_transactions(both, cutoff))
    daily.write_days(states, path, late=True)
    days = spark.read.parquet(path)
    same(daily.features(daily.roll(daily.days_between(days, None, cutoff)), cutoff), etl.aggregate_transactions(both, cutoff))
    # February is written anew: some rows gone, others with another customer
    feb = (F.month("transaction_date") == 2)
    right = both.filter(~feb | (F.col("transaction_id") > 60)).withColumn("customer_id", F.when(feb & (F.col("transaction_id") < 90), "new").otherwise(F.col("customer_id")))
    again = daily.day_states(right.filter(feb))
    old = daily.roll(daily.days_between(days, None, cutoff))
    old.write.parquet(path + "-rolled")
    touched = [r[0] for r in days.filter("month = '2017-02'").select("customer_id").union(again.select("customer_id")).distinct().collect()]
    daily.write_days(again, path)
    now = daily.correct(spark.read.parquet(path + "-rolled"), spark.read.parquet(path), spark.createDataFrame([(c,) for c in touched], "customer_id string"), cutoff)
    same(daily.features(now, cutoff), etl.aggregate_transactions(right, cutoff))


def test_without_rows_without_ids_and_too_fine_money(spark):
    tx = made(spark, 40, 6).drop("transaction_id")
    cutoff = START + dt.timedelta(30)
    same(daily.features(daily.roll(daily.day_states(tx).filter(F.col("day") <= F.lit(cutoff))), cutoff), etl.aggregate_transactions(tx, cutoff))
    assert daily.features(daily.roll(daily.day_states(tx.limit(0))), cutoff).isEmpty()
    with pytest.raises(ValueError, match="digits"):
        daily.day_states(tx.withColumn("actual_amount_paid", F.col("actual_amount_paid").cast("decimal(18,4)")))
