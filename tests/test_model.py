"""Split, class weights and evaluation metrics (M4-M8, M5b) against brute force."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from scorewright.operators import model as M


def _auc_brute(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


def _ap_brute(y, s):
    y, s = np.asarray(y), np.asarray(s)
    ap, prev_recall = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        rec = tp / (y == 1).sum()
        ap += (rec - prev_recall) * prec
        prev_recall = rec
    return ap


def test_auc_and_ap_match_brute_force(spark):
    rng = np.random.default_rng(5)
    n = 400
    y = rng.integers(0, 2, n)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # coarse scores: many ties
    df = spark.createDataFrame([(int(a), float(b), "test") for a, b in zip(y, s)], "is_churn int, p double, split string")
    auc = M.auc_roc(df).first()["auc_roc"]
    ap = M.average_precision(df).first()["avg_precision"]
    assert auc == round(_auc_brute(y, s), 4)
    assert abs(ap - _ap_brute(y, s)) < 1e-4


def test_split_metrics(spark):
    rows = [(1, True), (1, False), (0, True), (0, False), (0, False)]
    df = spark.createDataFrame([(a, b, "s") for a, b in rows], "is_churn int, pred boolean, split string")
    r = M.split_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.6, 0.5, 0.5, 0.5)
    assert (r["churn_rate_actual"], r["churn_rate_predicted"]) == (0.4, 0.4)


def split_counts(df):
    got = {}
    for r in df.groupBy("is_churn", "split").count().collect():
        got.setdefault(r["is_churn"], {})[r["split"]] = r["count"]
    return {c: tuple(v.get(k, 0) for k in ("train", "val", "test")) for c, v in got.items()}


def test_split_sizes_are_exact(spark):
    for n, every in ((20000, 4), (1003, 7), (101, 100), (7, 2)):
        df = spark.range(n).select(F.col("id").cast("string").alias("customer_id"), (F.col("id") % every == 0).cast("int").alias("is_churn"))
        ones = -(-n // every)
        want = M.quotas({1: ones, 0: n - ones})
        a = M.assign_split(df)
        assert split_counts(a) == want and a.columns == ["customer_id", "is_churn", "split"]
        held = -(-3 * n // 10)
        assert [sum(v[i] for v in want.values()) for i in range(3)] == [n - held, held // 2, held - held // 2]
        assert a.exceptAll(M.assign_split(df.repartition(7))).isEmpty()  # the same however the rows are dealt
        # within a class the split follows the order of the hash
        import hashlib

        for c in (0, 1):
            rows = [r for r in a.collect() if r["is_churn"] == c]
            rows.sort(key=lambda r: hashlib.md5(f"{r['customer_id']}|{c}|42".encode()).hexdigest())
            t, v, e = want[c]
            assert [r["split"] for r in rows] == ["train"] * t + ["val"] * v + ["test"] * e


def test_split_sizes_of_the_full_data_set():
    parts = M.quotas({0: 883_630, 1: 87_330})
    assert tuple(sum(v[i] for v in parts.values()) for i in range(3)) == (679_672, 145_644, 145_644)
    assert all(abs(v[i] / sum(v) - f) < 1e-5 for v in parts.values() for i, f in enumerate((0.7, 0.15, 0.15)))


def test_split_of_repeated_null_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1)] * 60 + [(None, 0)] * 3 + [("b", None)] + [(str(i), 0) for i in range(37)], "customer_id string, is_churn int")
    got = M.assign_split(df)
    assert got.count() == 101 and got.filter("split IS NULL").count() == 0
    assert all(r[0] == 1 for r in got.groupBy("customer_id", "is_churn").agg(F.countDistinct("split").alias("k")).select("k").collect())
    none = M.assign_split(df.limit(0))
    assert none.columns == [*df.columns, "split"] and none.isEmpty()


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 25 + [(0,)] * 75, "is_churn int")
    w = {r["is_churn"]: r["weight"] for r in M.class_weights(df).collect()}
    assert w[1] == 100 / (2 * 25) and w[0] == 100 / (2 * 75)
