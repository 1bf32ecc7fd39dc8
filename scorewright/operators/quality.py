"""Batch-quality gates and score statistics.

All gates of a batch are one aggregate over the scored rows (partial aggregation, one row per group), optionally per
``run_id``. Exact percentiles run over the stored 4-decimal probability, so their per-task state is bounded by the
10 001 possible values, however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorewright.config import GateConfig
from scorewright.functions.exprs import round_half_even

PERCENTILES = [0.10, 0.25, 0.50, 0.75, 0.90]


STAT_COLUMNS = ["score_mean", "score_std", "score_p10", "score_p25", "score_p50", "score_p75", "score_p90"]


def _stats_aggs(p: Column) -> list[Column]:
    # exact decimal sum of the 4-decimal scores over the count: addition order cannot move a rounding tie
    return [
        (F.sum(p.cast("decimal(12,4)")).cast("double") / F.count(p)).alias("_mean"),
        F.stddev_pop(p).alias("_std"),
        F.percentile(p, PERCENTILES).alias("_q"),
    ]


def _stats_select() -> list[Column]:
    return [
        round_half_even("_mean").alias("score_mean"),
        round_half_even("_std").alias("score_std"),
        *[round_half_even(F.col("_q")[i]).alias(STAT_COLUMNS[2 + i]) for i in range(len(PERCENTILES))],
    ]


def score_stats(scored: DataFrame, group: list[str] = (), col: str = "churn_probability") -> DataFrame:
    """A5: mean, population std and p10/p25/p50/p75/p90 (linear interpolation, as numpy), 4 decimals."""
    agg = scored.groupBy(*group).agg(*_stats_aggs(F.col(col)))
    return agg.select(*group, *_stats_select())


def positive_rate(df: DataFrame, col: str, group: list[str] = ()) -> DataFrame:
    """Share of positives (label base rate, or predicted churn rate), 4 decimals."""
    return df.groupBy(*group).agg(round_half_even(F.avg(F.col(col).cast("double"))).alias("positive_rate"))


def _msg(cond: Column, text: Column | str) -> Column:
    return F.when(cond, text if isinstance(text, Column) else F.lit(text))


def gate_frame(
    scored: DataFrame,
    n_read: Column | int,
    cfg: GateConfig = GateConfig(),
    group: list[str] = (),
    with_stats: bool = False,
    extra_aggs: list[Column] = (),
):
    """V1-V6 in one aggregate. ``n_read`` is the input row count (a literal, or a column when grouped by run).
    ``with_stats`` adds the A5 statistics and ``extra_aggs`` any further aggregates (kept under their aliases) to the
    same pass over the rows.

    Output per group: counts, null rate, min/max, sample std, predicted rate, ``errors`` (hard failures), ``warnings``,
    ``validation_passed``, ``validation_notes`` and ``status`` ('failed' on any error, else 'completed').
    A NULL std (all scores NULL, or one row) fails the degenerate gate: an unknown is not a pass.
    """
    p = F.col("churn_probability")
    agg = scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count(p).alias("n_nonnull"),
        F.min(p).alias("score_min"),
        F.max(p).alias("score_max"),
        F.stddev_samp(p).alias("std_samp"),
        F.avg(F.col("churn_label").cast("double")).alias("churn_rate"),
        *(_stats_aggs(p) if with_stats else []),
        *extra_aggs,
    )
    extra_names = [c for c in agg.columns if c not in group][6 + (3 if with_stats else 0):]
    n_read_col = F.lit(n_read) if isinstance(n_read, int) else n_read
    agg = agg.withColumn("n_read", n_read_col.cast("long"))
    null_rate = F.try_divide(F.col("n_scored") - F.col("n_nonnull"), F.col("n_scored"))
    lo, hi = cfg.score_range
    errors = [
        _msg(
            F.col("n_scored") < F.lit(cfg.min_scored_fraction) * F.col("n_read"),
            F.format_string("dropped: %d of %d rows scored", F.col("n_scored"), F.col("n_read")),
        ),
        _msg(null_rate > cfg.max_null_score_pct, "null score rate above limit"),
        _msg((F.col("score_min") < lo) | (F.col("score_max") > hi), "scores out of range"),
        _msg(F.coalesce(F.col("std_samp") < cfg.min_std, F.lit(True)), "degenerate distribution"),
    ]
    if cfg.min_records_expected is not None:
        errors.append(
            _msg(
                F.col("n_scored") < cfg.min_records_expected,
                F.format_string("only %d rows scored, expected %d", F.col("n_scored"), F.lit(cfg.min_records_expected)),
            )
        )
    rlo, rhi = cfg.churn_rate_range
    warnings = [_msg(~F.col("churn_rate").between(rlo, rhi), "predicted churn rate outside expected range")]
    errs = F.filter(F.array(*errors), lambda x: x.isNotNull())
    warns = F.filter(F.array(*warnings), lambda x: x.isNotNull())
    out = agg.select(
        *group,
        "n_read",
        "n_scored",
        (F.col("n_read") - F.col("n_scored")).alias("n_failed"),
        round_half_even(null_rate, 6).alias("null_rate"),
        "score_min",
        "score_max",
        round_half_even("std_samp").alias("score_std_samp"),
        round_half_even("churn_rate").alias("churn_rate"),
        errs.alias("errors"),
        warns.alias("warnings"),
        *(_stats_select() if with_stats else []),
        *extra_names,
    )
    notes = F.concat_ws("; ", F.concat(F.col("errors"), F.col("warnings")))
    return out.select(
        "*",
        (F.size("errors") == 0).alias("validation_passed"),
        F.when(notes == "", None).otherwise(notes).alias("validation_notes"),
        F.when(F.size("errors") == 0, "completed").otherwise("failed").alias("status"),
    )


class GateFailure(ValueError):
    """A batch did not pass its gates; the message holds the notes."""


def enforce(gates: DataFrame) -> None:
    """V6 on the driver: raise before anything is written when a gate failed (reads the one-row gate frame)."""
    rows = gates.select("validation_passed", "validation_notes").collect()
    failed = [r["validation_notes"] for r in rows if not r["validation_passed"]]
    if failed:
        raise GateFailure("; ".join(n or "" for n in failed))
