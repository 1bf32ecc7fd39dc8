"""Run event fold (S5, S6), latest score (W1), bulk lookup (P21, W11, J3, J4, J8), paging."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewright.operators import store
from scorewright.plans import history as H


def _events(spark, specs, attempt=1):
    """specs: (run_id, seq, event, {field: value})"""
    frames = []
    for run_id, seq, name, fields in specs:
        one = spark.range(1).select(F.lit(run_id).alias("run_id"))
        cols = {k: (F.lit(v) if not hasattr(v, "_jc") else v) for k, v in fields.items()}
        frames.append(H.event(one, seq, name, cols, attempt))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_fold_explicit_null_wins_and_unset_keeps_older(spark):
    t0 = dt.datetime(2000, 1, 1, 2, 0)
    ev = _events(spark, [
        ("r1", 1, "register", {"status": "running", "model_version": "v1", "started_at": F.lit(t0).cast("timestamp_ntz")}),
        ("r1", 2, "spark_result", {"score_mean": 0.4, "psi_vs_previous": 0.3}),
        ("r1", 3, "monitor", {"psi_vs_previous": F.lit(None).cast("double"), "status": "validated"}),
        ("r1", 7, "register", {"status": "running", "model_version": "v9"}),  # retried registration: ignored
    ])
    r = store.fold_runs(ev).first()
    assert r["status"] == "validated"
    assert r["psi_vs_previous"] is None  # the newest event set it to NULL explicitly
    assert r["score_mean"] == 0.4  # no later event set it
    assert r["model_version"] == "v1"  # first registration wins
    assert r["started_at"] == t0


def test_register_runs_skips_existing(spark):
    ev = _events(spark, [("a", 1, "register", {"model_version": "v1"}), ("b", 1, "register", {"model_version": "v1"}),
                         ("b", 5, "register", {"model_version": "v2"})])
    existing = spark.createDataFrame([("a",)], "run_id string")
    got = {r["run_id"]: r["model_version"] for r in store.register_runs(existing, ev).collect()}
    assert got == {"b": "v1"}


def _pred(spark):
    t1, t2 = dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 2)
    rows = [
        ("c1", "r1", "v1", 0.2, False, 2, "low", t1),
        ("c1", "r2", "v1", 0.8, True, 8, "high", t2),
        ("c2", "r1", "v1", 0.5, True, 5, "medium", t1),
        ("c3", "r1", "v1", 0.6, True, 6, "medium", t2),
        ("c3", "r0", "v1", 0.1, False, 1, "low", t2),  # same time: larger run id wins
    ]
    return spark.createDataFrame(
        rows,
        "customer_id string, run_id string, model_version string, churn_probability double, churn_label boolean, "
        "churn_decile int, risk_tier string, scored_at timestamp_ntz",
    )


def test_latest_scores(spark):
    got = {r["customer_id"]: r["run_id"] for r in store.latest_scores(_pred(spark)).collect()}
    assert got == {"c1": "r2", "c2": "r1", "c3": "r1"}
    latest = store.latest_scores(_pred(spark))
    assert store.score_for(latest, "c1").first()["churn_probability"] == 0.8
    assert store.score_for(latest, "zz").count() == 0


def test_bulk_lookup_parse_dedupe_and_split(spark):
    latest = store.latest_scores(_pred(spark))
    text = spark.createDataFrame([("c2\n  c1 \n\nzz\nc2\n",)], "t string")
    ids = store.parse_id_text(text, "t")
    assert [r["customer_id"] for r in ids.orderBy("pos").collect()] == ["c2", "c1", "zz", "c2"]
    req = store.dedupe_ids(ids, ["pos"])
    assert [r["customer_id"] for r in req.orderBy("pos").collect()] == ["c2", "c1", "zz"]
    found = {r["customer_id"]: r["run_id"] for r in store.bulk_found(req, latest).collect()}
    assert found == {"c1": "r2", "c2": "r1"}  # the latest run of each requested customer
    assert [r["customer_id"] for r in store.bulk_not_found(req, latest).collect()] == ["zz"]
    s = store.bulk_summary(req, latest).first()
    assert (s["total_requested"], s["total_found"]) == (3, 2)


def test_a_long_request_is_refused_not_cut(spark):
    lines = "\n".join(["", "x"] * 600)
    ids = store.parse_id_text(spark.createDataFrame([(lines,)], "t string"), "t")
    assert ids.count() == 600
    with pytest.raises(ValueError, match="500"):
        store.checked_request(ids)
    assert store.checked_request(ids.limit(500)).count() == 500


def test_bulk_results_keep_request_order(spark):
    latest = store.latest_scores(_pred(spark))
    req = spark.createDataFrame([("zz", 0), ("c3", 1), ("aa", 2), ("c1", 3), ("c2", 4)], "customer_id string, pos int")
    assert [r["customer_id"] for r in store.bulk_found(req, latest).collect()] == ["c3", "c1", "c2"]
    assert [r["customer_id"] for r in store.bulk_not_found(req, latest).collect()] == ["zz", "aa"]


def test_a_later_attempt_replaces_every_field(spark):
    done = [("r", 1, "register", {"status": "running", "model_version": "v1"}),
            ("r", 2, "spark_result", {"score_mean": 0.4}), ("r", 4, "write", {"status": "completed", "total_duration_secs": 9.0})]
    failed = [("r", 1, "register", {"status": "running", "model_version": "v2"}),
              ("r", 3, "validation", {"validation_passed": False}), ("r", 4, "failure", {"status": "failed"})]
    for first, second in ((done, failed), (failed, done)):
        log = _events(spark, second, 2).unionByName(_events(spark, first, 1))
        r = store.fold_runs(log).first()
        alone = store.fold_runs(_events(spark, second, 1)).first()
        assert r == alone


def test_predictions_of_several_runs_are_written_in_order(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(3000).select(F.col("id").cast("string").alias("customer_id"), F.concat(F.lit("r"), F.col("id") % 3).alias("run_id"),
                                    F.lit("v").alias("model_version"), F.lit(0.5).alias("churn_probability"), F.lit(True).alias("churn_label"),
                                    F.lit(5).alias("churn_decile"), F.lit("medium").alias("risk_tier"), F.lit(dt.datetime(2000, 1, 1)).alias("scored_at"))
    store.write_predictions(rows.repartition(2), path)
    files = spark.read.parquet(path).select("customer_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at")).collect()
    for f in {r["f"] for r in files}:
        ids = [r["customer_id"] for r in sorted(files, key=lambda r: r["at"]) if r["f"] == f]
        assert len(ids) > 100 and ids == sorted(ids)


def test_merged_latest_equals_latest_of_all(spark):
    pred = _pred(spark)
    old, new = pred.filter("run_id <> 'r2'"), pred.filter("run_id = 'r2'")
    merged = store.merge_latest(store.latest_scores(old), new)
    assert sorted(map(str, merged.select(*pred.columns).collect())) == sorted(map(str, store.latest_scores(pred).select(*pred.columns).collect()))
    late = store.merge_latest(new, pred.filter("run_id = 'r1'"))  # an older run published late does not win
    assert {r["customer_id"]: r["run_id"] for r in late.collect()} == {"c1": "r2", "c2": "r1", "c3": "r1"}


def test_runs_page_and_totals(spark):
    runs = spark.createDataFrame(
        [(f"r{i}", dt.datetime(2000, 1, i + 1), "validated" if i % 2 else "failed") for i in range(5)],
        "run_id string, started_at timestamp_ntz, status string",
    )
    page = [r["run_id"] for r in store.runs_page(runs, page=2, size=2).collect()]
    assert page == ["r2", "r1"]
    assert store.runs_total(runs, "validated").first()["total"] == 2
    assert store.health(runs).first()["latest_run_id"] == "r4"
    assert store.latest_completed(runs).first()["run_id"] == "r3"


def test_run_id_format():
    import re

    from scorewright.plans.runs import new_run_id

    rid = new_run_id("run", dt.datetime(2024, 1, 2, 3, 4, 5))
    assert re.fullmatch(r"run-20240102-030405-[0-9a-f]{8}", rid)
    assert new_run_id() != new_run_id()
