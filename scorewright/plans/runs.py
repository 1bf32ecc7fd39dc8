"""Run history derived from the driver's tables (predictions, run events, run state).

The driver has no table of past runs, so the history is built the way the nightly job would have built it: several
runs score every customer, each with its own scorecard; a run whose gate fails writes no predictions. The run
metadata (ids, versions, timestamps, timings) are job parameters; every prediction row derives from the tables.

All runs are scored in ONE pass over the feature matrix: each row carries one probability per run and an ``inline``
turns them into rows (a Generate, no union of re-scans, no cross join).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import ID_COL, JobConfig
from scorewright.functions.exprs import decile, risk_tier, round_half_even, ts_lit
from scorewright.operators import features as FE
from scorewright.operators import quality
from scorewright.operators.scoring import DEFAULT_SCORECARD, Scorecard


@dataclass(frozen=True)
class RunSpec:
    run_id: str
    model_version: str
    card: Scorecard
    started_at: dt.datetime
    scored_at: dt.datetime
    completed_at: dt.datetime
    spark_duration_secs: float
    total_duration_secs: float


def _t(day: int, hh: int, mm: int, ss: int = 0) -> dt.datetime:
    return dt.datetime(2000, 8, day, hh, mm, ss)


# The run history parameters (ids, model versions, score shifts, timestamps, timings).
FLAT_CARD = Scorecard(intercept=-0.85, weights={}, version="v1.1.0")
STEEP_CARD = Scorecard(  # so steep that many scores are 0.0 or 1.0
    intercept=8 * DEFAULT_SCORECARD.intercept, weights={f: 8 * w for f, w in DEFAULT_SCORECARD.weights.items()}, version="v1.2.0"
)
RUNS = [
    RunSpec("run-20000801-020000-5f1c2a9e", "v1.0.0", DEFAULT_SCORECARD, _t(1, 2, 0), _t(1, 2, 4), _t(1, 2, 9, 30), 180.5, 330.25),
    RunSpec("run-20000802-020000-8b7d4e10", "v1.0.0", DEFAULT_SCORECARD.shifted(0.15), _t(2, 2, 0), _t(2, 2, 3, 30), _t(2, 2, 8), 150.0, 300.0),
    RunSpec("run-20000803-020000-c3e9f772", "v1.1.0", FLAT_CARD, _t(3, 2, 0), _t(3, 2, 3), _t(3, 2, 5), 120.75, 200.5),
    RunSpec("run-20000804-020000-1d2e3f40", "v1.1.0", DEFAULT_SCORECARD.shifted(0.6, "v1.1.0"), _t(4, 2, 0), _t(4, 2, 2, 45), _t(4, 2, 7, 15), 140.25, 310.0),
    RunSpec("run-20000805-020000-7a6b5c4d", "v1.2.0", STEEP_CARD, _t(5, 2, 0), _t(5, 2, 3, 15), _t(5, 2, 8, 45), 160.0, 320.5),
]

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("started_at", T.TimestampNTZType(), False),
        T.StructField("scored_at", T.TimestampNTZType(), False),
        T.StructField("completed_at", T.TimestampNTZType(), False),
        T.StructField("spark_duration_secs", T.DoubleType(), False),
        T.StructField("total_duration_secs", T.DoubleType(), False),
    ]
)


def run_specs(spark: SparkSession, runs: list[RunSpec] = RUNS) -> DataFrame:
    """The run parameters as a small table (size = number of runs, a job parameter)."""
    rows = [
        (r.run_id, r.model_version, r.started_at, r.scored_at, r.completed_at, r.spark_duration_secs, r.total_duration_secs)
        for r in runs
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def scored_runs(customers: DataFrame, runs: list[RunSpec] = RUNS, cfg: JobConfig = JobConfig()) -> DataFrame:
    """Every run's scored rows with lineage, before any gate (one pass, one Generate)."""
    _, enc = FE.training_frame(customers)
    matrix = FE.feature_matrix(customers, enc)
    per_run = []
    for r in runs:
        p = r.card.probability()
        per_run.append(
            F.struct(
                F.lit(r.run_id).alias("run_id"),
                F.lit(r.model_version).alias("model_version"),
                round_half_even(p, 4).alias("churn_probability"),
                (p >= cfg.label_threshold).alias("churn_label"),
                decile(p).alias("churn_decile"),
                risk_tier(p, cfg.tier_high, cfg.tier_medium).alias("risk_tier"),
                ts_lit(r.scored_at).alias("scored_at"),
            )
        )
    return matrix.select(ID_COL, F.inline(F.array(*per_run)))


def run_gates(scored: DataFrame, customers: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """V1-V6 per run. The input count is a scalar subquery over the customer table (planned once, no join)."""
    n_read = customers.agg(F.count(F.lit(1))).scalar()
    return quality.gate_frame(scored, n_read, cfg.gates, group=["run_id"])


def predictions(scored: DataFrame, gates: DataFrame) -> DataFrame:
    """Rows of the runs whose gate passed (a failed gate stops the write). The gate table has one row per run,
    so the semi join broadcasts a table bounded by the number of runs."""
    passed = gates.filter(F.col("validation_passed")).select("run_id")
    return scored.join(F.broadcast(passed), "run_id", "left_semi")


def new_run_id(prefix: str = "run", now: dt.datetime | None = None) -> str:
    """``prefix-yyyymmdd-HHMMSS-xxxxxxxx`` (UTC time plus 8 hex digits of a random UUID), made on the driver
    once per job and passed to every task as a literal."""
    import uuid

    now = now or dt.datetime.now(dt.timezone.utc)
    return f"{prefix}-{now:%Y%m%d-%H%M%S}-{uuid.uuid4().hex[:8]}"
