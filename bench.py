"""Benchmark: headline jobs and queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Measured the way the system runs:
    nightly_*      the nightly job end to end from the raw tables, once per run of the run history
                   (ETL, features, score, staged write, gates, publish, events, PSI; one run fails its gate)
    analytics      the serving / monitoring queries over the stored tables that the nightly runs wrote
                   (latest score, lookup, bulk lookup, histogram, PSI, run summary, totals, high-risk list)
    scoring_*      throughput of feature building + scoring at the reference's 970 960 rows: the sf customer rows
                   repeated to that count, written once, then engineered, encoded and scored into ``noop`` (the
                   reference's ~95 K rows/s pandas figure also times feature building + prediction only); one
                   warm-up run is discarded, as the reference's benchmark does, and its time is reported too
    training       GBT training at the same row count (train + validation rows), reported apart from ``value``
``value`` is the sum of all timed steps in ``queries``. One untimed nightly run on sf0.001 warms the JVM first.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REFERENCE_ROWS = 970_960
REFERENCE_ROWS_PER_SEC = 95_000


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import functions as F

    from scorewright.config import ID_COL, TARGET_COL, JobConfig
    from scorewright.operators import features as FE, model as M, monitor, scoring, store
    from scorewright.operators.quality import GateFailure
    from scorewright.operators.runlog import RunLog
    from scorewright.plans import nightly, registry as R, runs as RN
    from scorewright.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", app="scorewright-bench", shuffle_partitions=cpus)
    spark.range(1000).agg(F.sum("id")).collect()  # JVM warm-up, untimed

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # ---- warm-up, untimed and discarded (as the reference's benchmark does): one nightly run on the smallest
    # sibling scale factor, so JIT and code generation are not charged to the first timed run
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        warm = R.scratch(spark, "bench-warmup")
        nightly.store_vocabulary(spark, warm_dir, warm)
        nightly.run_nightly(spark, warm_dir, warm, "warmup", RN.RUNS[0].card)

    # ---- nightly job, once per run of the history (the third run fails its gate and publishes nothing)
    wh = R.scratch(spark, "bench")
    timed("store_vocabulary", lambda: nightly.store_vocabulary(spark, sf_dir, wh))
    published = 0

    def night(r):
        try:
            nightly.run_nightly(spark, sf_dir, wh, r.run_id, r.card, started_at=r.started_at)
        except GateFailure:
            return 0
        return 1

    for i, r in enumerate(RN.RUNS, start=1):
        published += timed(f"nightly_run_{i}", lambda r=r: night(r))

    # ---- analytics over the stored tables
    pred = spark.read.parquet(os.path.join(wh, "predictions"))
    runs = RunLog(spark, os.path.join(wh, "run_events")).runs()
    customers = spark.read.parquet(os.path.join(wh, "customers"))
    latest = nightly.latest_table(spark, os.path.join(wh, "latest_scores"))
    last, prev = RN.RUNS[3].run_id, RN.RUNS[1].run_id

    def psi_pair():
        dist = monitor.psi_distribution(monitor.psi_counts(pred.filter(F.col("run_id").isin(prev, last))))
        pairs = spark.range(1).select(F.lit(last).alias("run_id"), F.lit(prev).alias("ref_run_id"))
        return monitor.psi(monitor.psi_breakdown(dist, pairs)).collect()

    def metrics():
        enc = FE.encoders_from_table(spark.read.parquet(os.path.join(wh, "model", "vocabulary")))
        m = M.assign_split(FE.feature_matrix(customers, enc, keep=(ID_COL, TARGET_COL)))
        return M.evaluation(m.select(ID_COL, TARGET_COL, "split", scoring.DEFAULT_SCORECARD.probability().alias("p"))).collect()

    timed("w1_latest_scores", lambda: noop(latest))
    timed("w1_latest_scores_rebuilt", lambda: noop(store.latest_scores(pred)))
    timed("w8_score_by_customer", lambda: store.score_for(latest, R.LOOKUP_CUSTOMER).collect())
    timed("j3_bulk_found", lambda: noop(store.bulk_found(R.request_ids(spark, sf_dir), latest)))
    timed("a9_score_histogram", lambda: monitor.histogram(pred).collect())
    timed("a11_psi", psi_pair)
    timed("w14_run_summary", lambda: store.run_summary(runs).collect())
    timed("a7_pipeline_totals", lambda: store.pipeline_totals(runs, pred).collect())
    timed("w4_psi_history", lambda: monitor.psi_history(runs).collect())
    timed("w15_high_risk", lambda: noop(store.high_risk(pred)))
    timed("m6_m8_metrics", metrics)

    # ---- feature building + scoring throughput at the reference's row count
    n_base = customers.count()
    copies = max(1, math.ceil(REFERENCE_ROWS / max(n_base, 1)))
    big = customers.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy"))
    big = big.withColumn(ID_COL, F.concat_ws("-", F.col(ID_COL), F.col("_copy").cast("string"))).drop("_copy")
    staged = os.path.join(wh, "scale_customers")
    big.repartition(cpus).write.mode("overwrite").parquet(staged)  # setup, untimed
    big = spark.read.parquet(staged)
    n_scale = big.count()
    _, enc = FE.training_frame(customers)  # fitted encoders are a model artifact, fitted once
    plan = scoring.score_scorecard(FE.feature_matrix(big, enc))
    t0 = time.perf_counter()
    noop(plan)  # first run: includes code generation and JIT warm-up (reported, not the throughput basis)
    cold_secs = time.perf_counter() - t0
    t0 = time.perf_counter()
    noop(plan)
    score_secs = time.perf_counter() - t0
    times["scoring_970k_rows"] = round(score_secs, 3)

    # ---- training at the reference's row count (reported apart from the query total): GBT of BENCH_TREES trees, here
    # fewer than the job's default, balanced class weights, validation split; the reference reports 24.21 s for 500
    # LightGBM trees
    train_frame, _ = FE.training_frame(customers)
    tbig = train_frame.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy"))
    tbig = tbig.withColumn(ID_COL, F.concat_ws("-", F.col(ID_COL), F.col("_copy").cast("string"))).drop("_copy")
    tstaged = os.path.join(wh, "scale_training")
    M.assign_split(tbig).repartition(cpus).write.mode("overwrite").parquet(tstaged)  # setup, untimed
    split_sizes = {r["split"]: r["count"] for r in spark.read.parquet(tstaged).groupBy("split").count().collect()}
    tdata = spark.read.parquet(tstaged).filter(F.col("split") != "test")
    n_train = split_sizes.get("train", 0) + split_sizes.get("val", 0)
    t0 = time.perf_counter()
    gbt = M.train_gbt(tdata, JobConfig(n_trees=int(os.environ.get("BENCH_TREES", "50"))))
    train_secs = time.perf_counter() - t0
    gbt_plan = scoring.score_spark_model(FE.feature_matrix(big, enc), gbt)  # all 24 columns
    noop(gbt_plan)
    t0 = time.perf_counter()
    noop(gbt_plan)
    gbt_secs = time.perf_counter() - t0
    times["scoring_970k_rows_gbt"] = round(gbt_secs, 3)

    total = round(sum(times.values()), 3)
    out = {
        "metric": "headline_jobs_and_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": cpus,
        "customers": n_base,
        "runs_published": published,
        "scoring_rows": n_scale,
        "scoring_rows_per_sec": round(n_scale / score_secs, 1) if score_secs > 0 else None,
        "scoring_cold_secs": round(cold_secs, 3),
        "baseline_rows_per_sec": REFERENCE_ROWS_PER_SEC,
        "training_rows": n_train,
        "split_sizes": split_sizes,
        "baseline_split_sizes": {"train": 679_672, "val": 145_644, "test": 145_644},
        "training_trees": gbt.getNumTrees,
        "training_secs": round(train_secs, 2),
        "training_secs_per_tree": round(train_secs / max(1, gbt.getNumTrees), 3),
        "gbt_scoring_rows_per_sec": round(n_scale / gbt_secs, 1),
        "baseline_training_secs": 24.21,
        "baseline_training_trees": 500,
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
