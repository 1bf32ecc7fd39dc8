"""The nightly scoring job (E1 -> E2 -> E4 of the reference, as one Spark application).

    raw tables --ETL--> customers --features/score--> staging (Parquet, counts observed in the same job)
    staging --one aggregate--> gates, statistics, PSI bin counts (run_bins)
                                     --fail--> 'failed' events, nothing published, the job raises
                                     --pass--> rejects, predictions/run_id=<id> (replaced if re-run), latest scores, events,
                                               PSI from the stored bin counts of this and the previous run

Every stage after scoring reads the previous stage's written files, never the lineage: the big ETL runs exactly
once, and a lost executor only re-runs tasks of the current stage. Writers keep the scoring parallelism (no
``coalesce``). Tables live under ``warehouse``, which on a cluster is shared storage.
"""

from __future__ import annotations

import datetime as dt
import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewright.config import JobConfig
from scorewright.functions.exprs import psi_bin, ts_lit
from scorewright.operators import etl, features as FE, keyed, monitor, quality, scoring, store
from scorewright.operators.runlog import RunLog
from scorewright.plans import history as H
from scorewright.session import input_bytes, size_partitions
from scorewright.sources import adapter, sinks, tables


@dataclass
class NightlyResult:
    run_id: str
    records_read: int
    records_scored: int
    validation_passed: bool
    validation_notes: str | None
    psi: float | None
    timings: dict[str, float]


def _paths(warehouse: str) -> dict[str, str]:
    return {
        "customers": os.path.join(warehouse, "customers"),
        "staging": os.path.join(warehouse, "staging"),
        "predictions": os.path.join(warehouse, "predictions"),
        "run_events": os.path.join(warehouse, "run_events"),
        "run_bins": os.path.join(warehouse, "run_bins"),
        "rejects": os.path.join(warehouse, "rejects"),
        "latest_scores": os.path.join(warehouse, "latest_scores"),
        "vocabulary": os.path.join(warehouse, "model", "vocabulary"),
    }


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class MissingArtifact(FileNotFoundError):
    """A model artifact that scoring needs is not stored."""


def store_vocabulary(spark: SparkSession, sf_dir: str, warehouse: str, cfg: JobConfig = JobConfig()) -> None:
    """Fits and stores the vocabulary of a scorecard that needs no training job."""
    lab = adapter.labels(spark, sf_dir, cfg.reference_date)
    tx = adapter.transactions(spark, sf_dir, cutoff=cfg.reference_date)
    customers = etl.build_customers(lab, adapter.members(spark, sf_dir), tx, cfg.reference_date)
    FE.vocabulary(FE.engineer(customers)).write.mode("overwrite").parquet(_paths(warehouse)["vocabulary"])


def require_artifacts(spark: SparkSession, paths: list[str]) -> None:
    """Scoring never makes up for an artifact: what is missing is an error."""
    missing = [p for p in paths if not _exists(spark, p)]
    if missing:
        raise MissingArtifact(", ".join(missing))


def _events(spark: SparkSession, run_id: str, attempt: int, *events: tuple[int, str, dict]) -> DataFrame:
    """Events of a run that are decided at the same moment: one commit of the run log."""
    one = spark.range(1).select(F.lit(run_id).alias("run_id"))
    frames = [
        H.event(one, seq, name, {k: (v if hasattr(v, "_jc") else F.lit(v)) for k, v in fields.items()}, attempt)
        for seq, name, fields in events
    ]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def latest_versions(spark: SparkSession, path: str) -> list[int]:
    """Attempt numbers of the whole versions of the latest-scores table, oldest first, from folder names alone."""
    if not _exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folders = [f.getPath() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    names = [f.getName() for f in folders if _exists(spark, os.path.join(f.toString(), "_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("attempt="))


def latest_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of the latest scores, keyed by customer."""
    return keyed.read_keyed(spark, os.path.join(path, f"attempt={latest_versions(spark, path)[-1]}"))


def _refresh_latest(spark: SparkSession, paths: dict[str, str], run_id: str, published: DataFrame, attempt: int) -> None:
    """The latest-scores table after this run, as a new version beside the one it was made from (readers of which go
    on undisturbed). Two versions are kept."""
    versions = [os.path.join(paths["latest_scores"], f"attempt={v}") for v in latest_versions(spark, paths["latest_scores"])]
    history = spark.read.parquet(paths["predictions"])
    new = os.path.join(paths["latest_scores"], f"attempt={attempt}")
    store.next_latest(spark, versions[-1] if versions else None, new, run_id, published, history)
    for old in versions[:-1]:
        keyed.drop_keyed(spark, old)


def _take_back(spark: SparkSession, paths: dict[str, str], run_id: str, attempt: int) -> None:
    """A failed attempt replaces the run's earlier one too, so what that one published goes: the run row says failed,
    and no table holds rows of the run."""
    if not _exists(spark, os.path.join(paths["predictions"], f"run_id={run_id}")):
        return
    nothing = spark.read.parquet(paths["predictions"]).select(*store.PREDICTION_COLUMNS).limit(0)
    _refresh_latest(spark, paths, run_id, nothing, attempt)
    for table in ("predictions", "rejects", "run_bins"):
        _delete(spark, os.path.join(paths[table], f"run_id={run_id}"))


def run_nightly(
    spark: SparkSession,
    sf_dir: str,
    warehouse: str,
    run_id: str,
    card: scoring.Scorecard = scoring.DEFAULT_SCORECARD,
    cfg: JobConfig = JobConfig(),
    started_at: dt.datetime | None = None,
    model_path: str | None = None,
    model_version: str | None = None,
    min_rows: int = 1,
) -> NightlyResult:
    """One night. Scores with the expression scorecard ``card``, or with the saved Spark ML GBT model at
    ``model_path`` (from ``plans.train``), whose version is ``model_version``.

    Refuses to begin without its artifacts and to score fewer than ``min_rows`` customers. Raises
    ``quality.GateFailure`` after the failure is logged when a gate fails. Rows that the stored table's constraints
    refuse go to ``rejects``. Each call is an attempt of its run; a later attempt replaces an earlier one, a failed one
    by taking back what that had published."""
    paths = _paths(warehouse)
    t: dict[str, float] = {}
    require_artifacts(spark, [paths["vocabulary"], *([model_path] if model_path else [])])
    raw = [os.path.join(sf_dir, f"{n}.parquet") for n in ("customer", "orders", "lineitem")]
    size_partitions(spark, input_bytes(spark, raw))  # only where the launcher left them unset
    started_at = started_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)

    # Register this attempt of the run; the log numbers it
    version = model_version or (card.version if model_path is None else "gbt")
    run_log = RunLog(spark, paths["run_events"])
    begun = {"status": "running", "model_version": version, "started_at": ts_lit(started_at), "records_failed": 0, "drift_flagged": False}
    attempt = run_log.register(run_id, lambda n: _events(spark, run_id, n, (1, "register", begun)), again=True)
    log = lambda *events: run_log.append(_events(spark, run_id, attempt, *events))

    # Refuse before any work; each customer is a label row, so the count comes from the file footers alone
    universe = etl.input_precheck(tables.read_table(spark, sf_dir, "customer", ["c_custkey"]), min_rows).first()
    if not universe["passed"]:
        n = universe["n_rows"]
        notes = f"input has {n} rows, at least {min_rows} are needed"
        log((2, "failure", {"status": "failed", "records_read": n, "validation_passed": False, "validation_notes": notes}))
        _take_back(spark, paths, run_id, attempt)
        raise quality.GateFailure(notes)

    # Raw tables -> customers, written once
    t0 = time.perf_counter()
    lab = adapter.labels(spark, sf_dir, cfg.reference_date)
    mem = adapter.members(spark, sf_dir)
    tx = adapter.transactions(spark, sf_dir, cutoff=cfg.reference_date)
    from pyspark.sql import Observation

    read_obs = Observation("customers_read")
    built = etl.build_customers(lab, mem, tx, cfg.reference_date).observe(read_obs, F.count(F.lit(1)).alias("rows"))
    sinks.write_parquet(built, paths["customers"])
    n_read = int(read_obs.get["rows"])  # counted while writing, no extra job
    t["etl"] = time.perf_counter() - t0

    # Features + score -> staging, counts observed in the same job
    t0 = time.perf_counter()
    customers = spark.read.parquet(paths["customers"])
    enc = FE.encoders_from_table(spark.read.parquet(paths["vocabulary"]))
    matrix = FE.feature_matrix(customers, enc)
    if model_path is None:
        scored = scoring.score_scorecard(matrix, card, cfg)
    else:
        from pyspark.ml.classification import GBTClassificationModel

        scored = scoring.score_spark_model(matrix, GBTClassificationModel.load(model_path), cfg=cfg)
    scored = scoring.with_lineage(scored, run_id, version, started_at)
    observed, obs = scoring.observed_counts(scored)
    stage = os.path.join(paths["staging"], f"run_id={run_id}")
    sinks.write_parquet(observed.drop("run_id"), stage)
    counts = obs.get
    n_scored = int(counts["rows"])
    t["score"] = time.perf_counter() - t0

    # V1-V6 + A5 over the staged rows: one aggregate each, pruned to the score columns
    t0 = time.perf_counter()
    # gates (V1-V6), statistics (A5) and the run's PSI bin counts in ONE pass over the staged score column
    staged = spark.read.parquet(stage).select("churn_probability", "churn_label")
    pb = psi_bin("churn_probability", cfg.psi_n_bins)
    bin_aggs = [F.count(F.when(pb == k, 1)).alias(f"_bin_{k}") for k in range(1, cfg.psi_n_bins + 1)]
    bin_aggs.append(F.count(F.when(pb.isNull(), 1)).alias("_bin_null"))
    gate = quality.gate_frame(staged, n_read, cfg.gates, with_stats=True, extra_aggs=bin_aggs).first()
    t["gate"] = time.perf_counter() - t0
    log((2, "spark_result", {"records_read": n_read, "records_scored": n_scored, "records_failed": n_read - n_scored,
                             "spark_duration_secs": round(t["score"], 2), **{k: gate[k] for k in quality.STAT_COLUMNS}}),
        (3, "validation", {"validation_passed": gate["validation_passed"], "validation_notes": gate["validation_notes"]}))
    if not gate["validation_passed"]:
        log((4, "failure", {"status": "failed"}))
        _take_back(spark, paths, run_id, attempt)
        raise quality.GateFailure(gate["validation_notes"])

    # P20 + S4: rows that break the table's constraints are set aside; the others are published under the run's own
    # partition (dynamic overwrite: a re-run replaces it) and merged into the latest scores
    t0 = time.perf_counter()
    good, bad = scoring.split_rejects(spark.read.parquet(stage).withColumn("run_id", F.lit(run_id)))
    sinks.write_parquet(bad.drop("run_id"), os.path.join(paths["rejects"], f"run_id={run_id}"))
    # the bin counts (at most n_bins + 1 rows) are kept, so later drift checks never rescan predictions
    bin_rows = [(run_id, k, int(gate[f"_bin_{k}"])) for k in range(1, cfg.psi_n_bins + 1) if gate[f"_bin_{k}"]]
    if gate["_bin_null"]:
        bin_rows.append((run_id, None, int(gate["_bin_null"])))
    spark.createDataFrame(bin_rows, "run_id string, bin int, count bigint").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_id").parquet(paths["run_bins"])
    store.write_predictions(good, paths["predictions"])
    mine = spark.read.parquet(paths["predictions"]).filter(F.col("run_id") == run_id)
    _refresh_latest(spark, paths, run_id, mine, attempt)
    t["publish"] = time.perf_counter() - t0
    completed = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    log((4, "write", {"status": "completed", "completed_at": ts_lit(completed),
                      "total_duration_secs": round(sum(t.values()), 2)}))

    # PSI against the newest earlier completed/validated run, from the two runs' stored bin counts
    t0 = time.perf_counter()
    runs = run_log.runs()
    prev = monitor.previous_run(runs, run_id).select("run_id").first()
    psi_value, drift = None, False
    if prev is not None:
        counts = spark.read.parquet(paths["run_bins"]).filter(F.col("run_id").isin(prev["run_id"], run_id))
        dist = monitor.psi_distribution(counts.select("run_id", "bin", "count"), cfg.psi_n_bins, cfg.psi_epsilon)
        pairs = spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(prev["run_id"]).alias("ref_run_id"))
        row = monitor.psi(monitor.psi_breakdown(dist, pairs, cfg.psi_n_bins), cfg.psi_threshold).first()
        psi_value, drift = float(row["psi"]), bool(row["drift_flagged"])
    log((5, "monitor", {"psi_vs_previous": F.lit(psi_value).cast("double"), "drift_flagged": drift, "status": "validated"}))
    t["monitor"] = time.perf_counter() - t0
    return NightlyResult(run_id, n_read, n_scored, True, gate["validation_notes"], psi_value, t)
