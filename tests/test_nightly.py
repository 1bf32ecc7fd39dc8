"""The nightly job end to end: staged write, gate, publish under run partitions, events, PSI."""

import contextlib
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from scorewright.config import JobConfig
from scorewright.operators import quality, scoring, store
from scorewright.operators.runlog import RunLog
from scorewright.plans import nightly

FLAT = scoring.Scorecard(-0.85, {}, "flat")


def test_three_nights(spark):
    wh = tempfile.mkdtemp(prefix="scorewright-test-wh-")
    nightly.store_vocabulary(spark, SF_SMALL, wh)
    r1 = nightly.run_nightly(spark, SF_SMALL, wh, "n1")
    r2 = nightly.run_nightly(spark, SF_SMALL, wh, "n2", scoring.DEFAULT_SCORECARD.shifted(0.6))
    with pytest.raises(quality.GateFailure, match="degenerate"):
        nightly.run_nightly(spark, SF_SMALL, wh, "n3", FLAT)
    assert r1.validation_passed and r1.psi is None
    assert r2.validation_passed and r2.psi is not None and r2.psi > 0
    pred = spark.read.parquet(wh + "/predictions")
    counts = {r["run_id"]: r["count"] for r in pred.groupBy("run_id").count().collect()}
    assert counts == {"n1": r1.records_scored, "n2": r2.records_scored}  # the failed night published nothing
    runs = {r["run_id"]: r for r in RunLog(spark, wh + "/run_events").runs().collect()}
    assert runs["n1"]["status"] == "validated" and runs["n3"]["status"] == "failed"
    assert runs["n2"]["psi_vs_previous"] == r2.psi and runs["n1"]["psi_vs_previous"] is None
    # PSI from the stored bin counts equals PSI recomputed from the published predictions
    from scorewright.operators import monitor

    dist = monitor.psi_distribution(monitor.psi_counts(pred.filter(F.col("run_id").isin("n1", "n2"))))
    pairs = spark.createDataFrame([("n2", "n1")], "run_id string, ref_run_id string")
    assert abs(monitor.psi(monitor.psi_breakdown(dist, pairs)).first()["psi"] - r2.psi) < 1e-12
    # the kept latest scores equal those of the whole history
    latest = spark.read.parquet(wh + "/latest_scores")
    newest = latest.filter(F.col("attempt") == latest.agg(F.max("attempt")).first()[0]).select(*store.PREDICTION_COLUMNS)
    assert newest.exceptAll(store.latest_scores(pred).select(*store.PREDICTION_COLUMNS)).isEmpty() and newest.count() == r1.records_scored
    assert spark.read.parquet(wh + "/rejects").count() == 0
    # partition pruning: a run filter reads one directory
    plan = pred.filter(F.col("run_id") == "n2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def kept_latest_is_that_of(spark, wh, pred):
    kept = nightly.latest_table(spark, wh + "/latest_scores").select(*store.PREDICTION_COLUMNS)
    want = store.latest_scores(pred).select(*store.PREDICTION_COLUMNS)
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty()


def test_shrinking_rerun_leaves_no_stale_row(spark):
    rows = lambda *xs: spark.createDataFrame([(c, r, "v", p, False, 1, "low", t) for c, r, p, t in xs], "customer_id string, run_id string, model_version string, churn_probability double, churn_label boolean, churn_decile int, risk_tier string, scored_at int")
    first = rows(("a", "R0", 0.1, 1), ("b", "R0", 0.2, 1), ("a", "R1", 0.3, 5), ("b", "R1", 0.4, 5), ("c", "R1", 0.5, 5))
    for again in (rows(("a", "R1", 0.6, 6)), rows(("a", "R1", 0.6, 0)), rows(("b", "R1", 0.7, 3), ("d", "R1", 0.8, 3)), rows(("x", "R1", 0.0, 0)).limit(0)):
        now = first.filter("run_id = 'R0'").unionByName(again)
        got = store.replace_run(store.latest_scores(first), "R1", again, now)
        want = store.latest_scores(now).select(*store.PREDICTION_COLUMNS)
        assert sorted(map(str, got.select(*store.PREDICTION_COLUMNS).collect())) == sorted(map(str, want.collect()))


def test_rerun_of_a_night_replaces_its_partition(spark):
    wh = tempfile.mkdtemp(prefix="scorewright-test-wh-")
    nightly.store_vocabulary(spark, SF_SMALL, wh)
    nightly.run_nightly(spark, SF_SMALL, wh, "r1")
    first = nightly.run_nightly(spark, SF_SMALL, wh, "r2")
    again = nightly.run_nightly(spark, SF_SMALL, wh, "r2")  # the same night run again
    pred = spark.read.parquet(wh + "/predictions")
    counts = {r["run_id"]: r["count"] for r in pred.groupBy("run_id").count().collect()}
    assert counts == {"r1": first.records_scored, "r2": again.records_scored}
    state = lambda: {r["run_id"]: r for r in RunLog(spark, wh + "/run_events").runs().collect()}["r2"]
    good = state()
    assert good["status"] == "validated" and good["psi_vs_previous"] == again.psi
    with pytest.raises(quality.GateFailure):  # again, with a card that fails its gate
        nightly.run_nightly(spark, SF_SMALL, wh, "r2", FLAT)
    # what the run had published is taken back with it, from the latest scores too
    gone = spark.read.parquet(wh + "/predictions")
    assert {r[0] for r in gone.select("run_id").distinct().collect()} == {"r1"}
    assert {r[0] for r in spark.read.parquet(wh + "/run_bins").select("run_id").distinct().collect()} == {"r1"}
    kept_latest_is_that_of(spark, wh, gone)
    bad = state()
    assert (bad["status"], bad["validation_passed"], bad["model_version"]) == ("failed", False, "flat")
    assert bad["completed_at"] is None and bad["psi_vs_previous"] is None and bad["score_mean"] != good["score_mean"]
    nightly.run_nightly(spark, SF_SMALL, wh, "r2")  # and well again
    kept_latest_is_that_of(spark, wh, spark.read.parquet(wh + "/predictions"))
    assert len(nightly.latest_versions(spark, wh + "/latest_scores")) == 2
    assert (state()["status"], state()["model_version"], state()["score_mean"]) == ("validated", good["model_version"], good["score_mean"])


def test_guards_before_scoring(spark):
    wh = tempfile.mkdtemp(prefix="scorewright-test-wh-")
    with pytest.raises(nightly.MissingArtifact, match="vocabulary"):
        nightly.run_nightly(spark, SF_SMALL, wh, "g")
    nightly.store_vocabulary(spark, SF_SMALL, wh)
    with pytest.raises(nightly.MissingArtifact, match="gbt"):
        nightly.run_nightly(spark, SF_SMALL, wh, "g", model_path=wh + "/model/gbt")
    with pytest.raises(quality.GateFailure, match="at least"):
        nightly.run_nightly(spark, SF_SMALL, wh, "g", min_rows=10**6)
    assert RunLog(spark, wh + "/run_events").runs().first()["status"] == "failed"


def test_refused_rows_are_set_aside(spark):
    rows = [("a", 0.5, True, 5, "medium"), ("b", 1.5, True, 5, "high"), ("c", None, True, 5, "low"), ("d", 0.1, False, 0, "low"), ("e", 0.1, False, 1, "x"), ("f", 1.0, True, 10, "high")]
    df = spark.createDataFrame(rows, "customer_id string, churn_probability double, churn_label boolean, churn_decile int, risk_tier string")
    good, bad = scoring.split_rejects(df)
    assert {r[0] for r in good.collect()} == {"a", "f"} and {r[0] for r in bad.collect()} == {"b", "c", "d", "e"}


def test_partition_sizing_respects_launcher_settings(spark):
    from scorewright.session import input_bytes, size_partitions

    n = input_bytes(spark, [SF_SMALL + "/lineitem.parquet"])
    assert n > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = size_partitions(spark, 10 * 1024**4)  # 10 TB
    assert "spark.sql.shuffle.partitions" not in applied  # set explicitly by the test session builder
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))


def test_train_then_score_with_the_saved_model(spark):
    from scorewright.plans import train

    wh = tempfile.mkdtemp(prefix="scorewright-test-wh-")
    out = train.run_training(spark, SF_SMALL, wh, JobConfig(n_trees=5, max_depth=3, max_training_rows=10_000))
    assert set(out["metrics"]) == {"train", "val", "test"}
    paths = train.model_paths(wh)
    assert spark.read.parquet(paths["importances"]).count() == 15
    report = spark.read.json(paths["report"]).first()
    assert report["best_iteration"] <= 5 and report["n_features"] == 24 == len(report["feature_columns"]) and report["training_secs"] > 0
    with contextlib.suppress(quality.GateFailure):
        r = nightly.run_nightly(spark, SF_SMALL, wh, "g1", model_path=paths["gbt"], model_version="gbt-v1")
        assert r.records_scored == r.records_read
    runs = {x["run_id"]: x for x in RunLog(spark, wh + "/run_events").runs().collect()}
    assert runs["g1"]["model_version"] == "gbt-v1" and runs["g1"]["status"] in ("validated", "failed")
