"""Queries without an SQL oracle (trained models, sampling): checked against their defining
properties on the small tables instead."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL

Q = E.queries()


@pytest.fixture(scope="module")
def n_customers(spark):
    return spark.read.parquet(SF_SMALL + "/customer.parquet").count()


def test_gbt_model_queries(spark, n_customers):
    ev = {r["split"]: r for r in Q["m5_gbt_evaluation"](spark, SF_SMALL).collect()}
    assert set(ev) == {"train", "val", "test"}
    assert all(0.0 <= r["auc_roc"] <= 1.0 and 0.0 <= r["avg_precision"] <= 1.0 for r in ev.values())
    assert sum(r["n_samples"] for r in ev.values()) == n_customers
    report = {r["split"]: r for r in Q["s9_training_report"](spark, SF_SMALL).collect()}
    assert {k: report[k]["auc_roc"] for k in report} == {k: ev[k]["auc_roc"] for k in ev}
    scores = Q["m9_gbt_scores"](spark, SF_SMALL)
    agg = scores.agg(F.count("*"), F.min("churn_probability"), F.max("churn_probability"),
                     F.min("churn_decile"), F.max("churn_decile")).first()
    assert agg[0] == n_customers and 0.0 <= agg[1] <= agg[2] <= 1.0 and 1 <= agg[3] <= agg[4] <= 10
    imp = [r["importance"] for r in Q["w16_feature_importances"](spark, SF_SMALL).orderBy("rank").collect()]
    assert len(imp) == 15 and imp == sorted(imp, reverse=True) and sum(imp) <= 1.0 + 1e-9


def test_sampled_reference_is_a_subset_of_its_run(spark):
    from scorewright.plans.registry import HIST_RUN_A, history

    pred = history(spark, SF_SMALL).predictions
    run = pred.filter(F.col("run_id") == HIST_RUN_A)
    sample = Q["x1_sampled_reference"](spark, SF_SMALL)
    n, k = run.count(), sample.count()
    assert 0 < k < n
    assert sample.exceptAll(run).count() == 0
    from scorewright.operators import monitor

    fewer = monitor.sampled_reference(pred.repartition(7), HIST_RUN_A, rows=k // 2)
    assert fewer.count() == k // 2 and fewer.exceptAll(sample).count() == 0
    assert monitor.sampled_reference(pred, HIST_RUN_A, 1.0).count() == n


def test_timed_scoring_rows(spark, n_customers):
    from scorewright.plans import bench_jobs

    m = bench_jobs.timed_scoring(spark, SF_SMALL, "t").cache()
    assert m.count() == 6 and m.filter("duration_secs <= 0").isEmpty()
    assert {r["sample_size"] for r in m.collect()} == {max(1, int(n_customers * f)) for f in (0.1, 0.5, 1.0)}
    assert bench_jobs.engine_pivot(m).columns == ["sample_size", "spark_expr", "spark_pandas"]
    assert bench_jobs.speedup(m).first()[0] > 0
    assert [r["engine"] for r in bench_jobs.latest_set(m).collect()] == ["spark_expr"] * 3 + ["spark_pandas"] * 3
