"""Transaction aggregation, the no-leakage cutoff and the customer table."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from scorewright.operators import etl
from scorewright.sources import tables

REF = dt.date(2017, 3, 1)
TX_COLS = ("customer_id payment_method_id plan_list_price payment_plan_days actual_amount_paid is_auto_renew "
           "is_cancel transaction_date membership_expire_date").split()


def _tx(spark, rows, with_id=False):
    cols = TX_COLS + (["transaction_id"] if with_id else [])
    return spark.createDataFrame(rows, cols)


def test_rollup_equals_plain_python(spark):
    r = random.Random(11)
    day = lambda: dt.date(2017, 1, 1) + dt.timedelta(r.randint(0, 119))
    rows = [(f"u{r.randint(0, 5)}", r.randint(1, 9), r.randint(0, 90), 30, r.randint(0, 90), r.randint(0, 1), r.randint(0, 1), day(), day(), i) for i in range(200)]
    number = lambda d: int(d.strftime("%Y%m%d"))
    tx = _tx(spark, [(*x[:7], number(x[7]), number(x[8]), x[9]) for x in rows], with_id=True)
    got = {x["customer_id"]: x for x in etl.aggregate_transactions(tx, REF).collect()}
    for user in {x[0] for x in rows}:
        own = [x for x in rows if x[0] == user and x[7] <= REF]
        last, ends = max(own, key=lambda x: (x[7], x[9])), max(x[8] for x in own)
        want = {
            "n_transactions": len(own), "total_paid": sum(x[4] for x in own), "total_discount": sum(x[2] - x[4] for x in own),
            "n_auto_renew": sum(x[5] for x in own), "n_cancels": sum(x[6] for x in own), "payment_method_id": last[1],
            "last_is_auto_renew": last[5], "last_is_cancel": last[6], "days_to_expire": (ends - REF).days,
            "membership_tenure_days": (ends - min(x[7] for x in own)).days,
        }
        assert {k: got[user][k] for k in want} == want


def test_any_transaction_id_breaks_ties(spark):
    big = (1 << 63) - 1
    rows = [("a", 1, 1, 1, 1, 0, 0, 20170210, 20170310, 1 << 43), ("a", 2, 1, 1, 1, 1, 1, 20170210, 20170310, big),
            ("b", 3, 1, 1, 1, 0, 0, 20170210, 20170310, -big - 1), ("b", 4, 1, 1, 1, 1, 0, 20170210, 20170310, -5), ("b", 5, 1, 1, 1, 1, 0, 20170209, 20170310, big)]
    got = {r["customer_id"]: r["payment_method_id"] for r in etl.aggregate_transactions(_tx(spark, rows, with_id=True), REF).collect()}
    assert got == {"a": 2, "b": 4}


def test_ties_without_an_id_do_not_depend_on_row_order(spark):
    rows = [("a", 9, 1, 1, 1, 0, 1, 20170210, 20170310), ("a", 9, 1, 1, 1, 1, 0, 20170210, 20170310), ("a", 8, 1, 1, 1, 1, 1, 20170210, 20170310)]
    for some in (rows, rows[::-1]):
        r = etl.aggregate_transactions(_tx(spark, some), REF).first()
        assert (r["payment_method_id"], r["last_is_auto_renew"], r["last_is_cancel"]) == (9, 1, 0)


def test_swapped_csv_columns_are_an_error(spark, tmp_path):
    good = "msno,city,bd,gender,registered_via,registration_init_time\nu1,3,44,male,7,20160101\n"
    (tmp_path / "good.csv").write_text(good)
    (tmp_path / "swapped.csv").write_text(good.replace("city,bd", "bd,city"))
    assert tables.read_csv(spark, str(tmp_path / "good.csv"), "members").first().asDict()["customer_id"] == "u1"
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_csv(spark, str(tmp_path / "swapped.csv"), "members").collect()


def test_cutoff_is_inclusive_and_invalid_dates_drop(spark):
    tx = _tx(spark, [
        ("a", 1, 10, 30, 10, 0, 0, 20170301, 20170331),  # on the reference day: kept
        ("a", 2, 10, 30, 10, 0, 0, 20170230, 20170331),  # not a date: dropped like NaT
    ])
    r = etl.aggregate_transactions(tx, REF).collect()
    assert len(r) == 1 and r[0]["n_transactions"] == 1 and r[0]["payment_method_id"] == 1


def test_date_ties_break_on_transaction_id(spark):
    tx = _tx(spark, [
        ("a", 7, 10, 30, 10, 1, 0, 20170210, 20170310, 5),
        ("a", 9, 10, 30, 10, 0, 1, 20170210, 20170312, 6),  # same date, larger id: the latest
        ("a", 3, 10, 30, 10, 1, 1, 20170101, 20170201, 99),
    ], with_id=True)
    r = etl.aggregate_transactions(tx, REF).first()
    assert (r["payment_method_id"], r["last_is_auto_renew"], r["last_is_cancel"]) == (9, 0, 1)


def test_customer_table_left_joins_and_zero_fill(spark):
    labels = spark.createDataFrame([("a", 0), ("b", 1), ("c", 0), (None, 1)], "customer_id string, is_churn int")
    members = spark.createDataFrame(
        [("a", 1, 30, "male", 7, 20160101), ("b", 13, 999, None, 9, 20170230)],
        "customer_id string, city int, bd int, gender string, registered_via int, registration_init_time int",
    )
    tx = _tx(spark, [("a", 41, 149, 30, 149, 1, 0, 20170201, 20170303)])
    rows = {r["customer_id"]: r for r in etl.build_customers(labels, members, tx, REF).collect()}
    assert set(rows) == {"a", "b", "c"}  # NULL ids dropped, label universe kept
    assert rows["a"]["registration_days"] == (REF - dt.date(2016, 1, 1)).days
    assert rows["b"]["registration_days"] is None  # invalid registration date
    assert rows["c"]["city"] is None and rows["c"]["n_transactions"] == 0 and rows["c"]["total_paid"] == 0.0
    assert rows["b"]["payment_method_id"] == 0 and rows["b"]["days_to_expire"] == 0


def test_transaction_rollup_is_a_hash_aggregate(spark):
    from conftest import SF_SMALL
    from scorewright.plans import registry as R

    plan = R.customers(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_cutoff_reaches_the_parquet_scan(spark):
    from conftest import SF_SMALL
    from scorewright.sources import adapter

    tx = adapter.transactions(spark, SF_SMALL, cutoff=dt.date(2000, 8, 1))
    plan = tx._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan


def test_first_n_and_precheck(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("customer_id"))
    assert [r[0] for r in etl.first_n(df, 3).collect()] == ["0", "1", "10"]
    r = etl.input_precheck(df, 1000).first()
    assert r["n_rows"] == 100 and r["passed"] is False
