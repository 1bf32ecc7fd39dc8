"""Histogram view and PSI (A9-A13, W2-W4, P17, P22, P23) checked against a brute-force numpy computation."""

import math

import numpy as np
from pyspark.sql import functions as F

from scorewright.functions.exprs import risk_tier
from scorewright.operators import monitor


def _pred(spark, runs: dict):
    rows = [(f"c{i}", run, float(p)) for run, ps in runs.items() for i, p in enumerate(ps)]
    return spark.createDataFrame(rows, "customer_id string, run_id string, churn_probability double")


def _psi_numpy(ref, cur, n_bins=10, eps=1e-6):
    def dist(x):
        x = np.asarray(x)
        b = np.minimum(np.floor(x * n_bins).astype(int) + 1, n_bins)
        counts = np.array([(b == k).sum() for k in range(1, n_bins + 1)])
        return (counts + eps) / (len(x) + n_bins * eps)

    r, c = dist(ref), dist(cur)
    return float(np.sum((c - r) * np.log(c / r))), r, c


def test_psi_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    ref = np.round(rng.beta(2, 5, 3000), 4)
    cur = np.round(rng.beta(2.5, 4, 2500), 4)
    cur[:3] = [1.0, 0.0, 0.3]
    pred = _pred(spark, {"a": ref, "b": cur})
    dist = monitor.psi_distribution(monitor.psi_counts(pred))
    pairs = spark.createDataFrame([("b", "a")], "run_id string, ref_run_id string")
    bd = monitor.psi_breakdown(dist, pairs)
    got = monitor.psi(bd).first()
    want, r, c = _psi_numpy(ref, cur)
    assert math.isclose(got["psi"], want, rel_tol=1e-9)
    assert got["drift_flagged"] == (want > 0.2)
    rows = sorted(bd.collect(), key=lambda x: x["bin"])
    assert len(rows) == 10
    assert np.allclose([x["ref"] for x in rows], r) and np.allclose([x["cur"] for x in rows], c)


def test_psi_band_and_strict_flag(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (0.25,)], "psi double")
    from scorewright.functions.exprs import psi_band

    got = [r[0] for r in df.select(psi_band("psi")).collect()]
    assert got == ["stable", "moderate_change", "significant_shift", "significant_shift"]
    bd = spark.createDataFrame([("x", "y", 1, 0.2)], "run_id string, ref_run_id string, bin int, psi double")
    assert monitor.psi(bd).first()["drift_flagged"] is False  # 0.20 is significant yet not flagged


def test_all_bins_present_when_empty(spark):
    pred = _pred(spark, {"a": [0.05, 0.06], "b": [0.95]})
    d = monitor.psi_distribution(monitor.psi_counts(pred))
    assert d.count() == 20 and d.filter(F.col("count") == 0).count() == 18


def test_histogram_view_bins_and_fractions(spark):
    pred = _pred(spark, {"a": [0.0, 0.3, 0.7, 0.99, 1.0, 1.0, 0.45]})
    h = {r["bin"]: r for r in monitor.histogram(pred).collect()}
    assert h[11]["count"] == 2 and h[11]["bin_upper"] == 1.1  # p = 1.0 is bin 11
    assert h[4]["count"] == 1 and h[1]["count"] == 1  # width_bucket: 0.3 -> bin 4
    assert h[11]["fraction"] == round(2 / 7, 4)
    tiers = pred.withColumn("risk_tier", risk_tier("churn_probability", 0.7, 0.4))
    tiers = monitor.tier_totals(tiers).first()
    assert (tiers["low"], tiers["medium"], tiers["high"]) == (2, 1, 4)  # p = 1.0 is high
    wide = {r["bin"]: (r["bin_lower"], r["bin_upper"]) for r in monitor.histogram(pred, 20).collect()}
    assert wide[7] == (0.3, 0.35) and wide[1] == (0.0, 0.05)
    bt = {r["bin"]: r["bin_tier"] for r in monitor.bin_tier(monitor.histogram(pred)).collect()}
    assert bt[1] == "low" and bt[5] == "medium" and bt[8] == "high"


def test_fraction_rounding_is_half_up_and_exact(spark):
    # 1 of 8 = 0.125 exactly; 4 decimals keep it; 1 of 16 = 0.0625; 1 of 32 = 0.03125 -> 0.0313 (half up)
    pred = _pred(spark, {"a": [0.05] + [0.55] * 31})
    h = {r["bin"]: r["fraction"] for r in monitor.histogram(pred).collect()}
    assert h[1] == 0.0313


def test_previous_run_requires_earlier_start(spark):
    import datetime as dt

    runs = spark.createDataFrame(
        [("r1", dt.datetime(2000, 1, 1), "validated"), ("r2", dt.datetime(2000, 1, 2), "failed"),
         ("r3", dt.datetime(2000, 1, 3), "completed"), ("r4", dt.datetime(2000, 1, 4), "validated")],
        "run_id string, started_at timestamp_ntz, status string",
    )
    assert monitor.previous_run(runs, "r3").first()["run_id"] == "r1"
    assert monitor.previous_run(runs, "r1").count() == 0  # r4 is newer, not previous
    pairs = {r["run_id"]: r["ref_run_id"] for r in monitor.previous_runs(runs).collect()}
    assert pairs == {"r1": None, "r3": "r1", "r4": "r3"}
