"""The run history as the nightly job leaves it: predictions, the run event log and the folded run table.

Per run, the job emits events in this order (each sets only the fields it names):
    1 register      status 'running', model_version, started_at, table defaults (records_failed 0, drift_flagged
                    false); a retried registration is ignored (S5)
    2 spark_result  records read/scored/failed, spark duration, score statistics (A5)
    3 validation    validation_passed, validation_notes (V6)
    4 failure       status 'failed'                                     (failed gate only; nothing is written)
    4 write         status 'completed', completed_at, total duration    (passed gate only)
    5 monitor       psi_vs_previous (explicit NULL for the first run), drift_flagged, status 'validated'

Every number comes from aggregates over the scored rows; only run ids, versions, timestamps and timings are
parameters (``runs.RUNS``). All per-run tables below are one row per run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.config import JobConfig
from scorewright.operators import monitor, quality, store
from scorewright.plans import runs as R
from scorewright.session import cut_lineage

RETRY_DELAY = dt.timedelta(hours=1)


@dataclass
class History:
    scored: DataFrame  # every run's rows, before gates
    gates: DataFrame  # one row per run
    stats: DataFrame  # one row per run
    predictions: DataFrame  # rows of passed runs (the stored table)
    passed: DataFrame  # parameters of the runs whose gate passed
    pairs: DataFrame  # run_id -> ref_run_id
    psi_breakdown: DataFrame
    psi: DataFrame
    events: DataFrame
    runs: DataFrame  # folded run table
    summary: DataFrame  # run summary view

    @cached_property
    def latest(self) -> DataFrame:
        """Latest score per customer, merged run by run as the job does, when the first query asks for it: the run
        queries need none of these shuffles of all customers."""
        latest = self.predictions.limit(0)
        for r in self.passed.orderBy("started_at", "run_id").select("run_id").collect():  # a merge a run, as nights pass
            latest = cut_lineage(store.merge_latest(latest, self.predictions.filter(F.col("run_id") == r["run_id"])), "latest")
        return latest


def event(df: DataFrame, seq: int, name: str, fields: dict[str, Column], attempt: int = 1) -> DataFrame:
    cols = [
        F.col("run_id"),
        F.lit(attempt).cast("long").alias("attempt"),
        F.lit(seq).cast("long").alias("seq"),
        F.lit(name).alias("event"),
        F.array(*[F.lit(k) for k in fields]).cast("array<string>").alias("set_fields"),
    ]
    for n, t in store.RUN_FIELDS:
        cols.append((fields[n] if n in fields else F.lit(None)).cast(t).alias(n))
    return df.select(*cols)


def build(
    customers: DataFrame,
    runs: list[R.RunSpec] = R.RUNS,
    cfg: JobConfig = JobConfig(),
    customers_materialized: bool = False,
) -> History:
    """Lineage is cut (reliable checkpoints in the session's checkpoint dir) after the ETL, after scoring and after
    the per-run aggregates: the many small per-run tables below all reuse materialised data instead of re-running
    the ETL once per branch."""
    spark = customers.sparkSession
    if not customers_materialized:
        customers = cut_lineage(customers, "customers")
    scored = cut_lineage(R.scored_runs(customers, runs, cfg), "scored_runs")
    gates = cut_lineage(R.run_gates(scored, customers, cfg))
    stats = cut_lineage(quality.score_stats(scored, ["run_id"]))
    pred = R.predictions(scored, gates)
    specs = R.run_specs(spark, runs)

    passed = specs.join(gates.filter("validation_passed").select("run_id"), "run_id", "left_semi")
    w = Window.orderBy("started_at", "run_id")  # one row per run
    order = passed.select("run_id", F.lag("run_id").over(w).alias("ref_run_id"))
    pairs = order.filter(F.col("ref_run_id").isNotNull())
    dist = monitor.psi_distribution(monitor.psi_counts(pred, cfg.psi_n_bins), cfg.psi_n_bins, cfg.psi_epsilon)
    breakdown = monitor.psi_breakdown(dist, pairs, cfg.psi_n_bins)
    breakdown = cut_lineage(breakdown)
    psi = monitor.psi(breakdown, cfg.psi_threshold)

    info = specs.join(gates, "run_id").join(stats, "run_id")
    first_run = specs.orderBy("started_at", "run_id").limit(1)
    mon = order.join(psi.select("run_id", "psi", "drift_flagged"), "run_id", "left")
    events = (
        event(specs, 1, "register", {"status": F.lit("running"), "model_version": F.col("model_version"),
                                      "started_at": F.col("started_at"), "records_failed": F.lit(0),
                                      "drift_flagged": F.lit(False)})
        .unionByName(
            event(first_run, 6, "register", {"status": F.lit("running"), "model_version": F.col("model_version"),
                                              "started_at": F.col("started_at") + F.lit(RETRY_DELAY)})
        )
        .unionByName(
            event(info, 2, "spark_result", {
                "records_read": F.col("n_read"), "records_scored": F.col("n_scored"),
                "records_failed": F.col("n_failed"), "spark_duration_secs": F.col("spark_duration_secs"),
                **{c: F.col(c) for c in ["score_mean", "score_std", "score_p10", "score_p25", "score_p50",
                                         "score_p75", "score_p90"]},
            })
        )
        .unionByName(
            event(gates, 3, "validation", {"validation_passed": F.col("validation_passed"),
                                            "validation_notes": F.col("validation_notes")})
        )
        .unionByName(event(gates.filter(~F.col("validation_passed")), 4, "failure", {"status": F.lit("failed")}))
        .unionByName(
            event(info.filter("validation_passed"), 4, "write", {
                "status": F.lit("completed"), "completed_at": F.col("completed_at"),
                "total_duration_secs": F.col("total_duration_secs"),
            })
        )
        .unionByName(
            event(mon, 5, "monitor", {
                "psi_vs_previous": F.col("psi"),
                "drift_flagged": F.coalesce(F.col("drift_flagged"), F.lit(False)),
                "status": F.lit("validated"),
            })
        )
    )
    events = cut_lineage(events, "run_events")  # a few rows a run; every run query starts from them
    folded = cut_lineage(store.fold_runs(events), "runs")
    return History(scored, gates, stats, pred, passed, pairs, breakdown, psi, events, folded, store.run_summary(folded))
