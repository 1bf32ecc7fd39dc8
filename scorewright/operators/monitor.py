"""Score distribution monitoring.

The only pass over prediction rows is one aggregate: counts per (run, bin), with map-side combine, so its output is
at most (runs x bins) rows whatever the row count. Everything after it (fractions, PSI, breakdowns) works on that
tiny table. Filters on ``run_id`` prune partitions of the stored predictions.

Two binnings, both documented:
    histogram view  ``width_bucket(p, 0, 1, 10)``: p = 1.0 is bin 11, empty bins absent
    PSI             ``least(floor(10 p) + 1, 10)``: all 10 bins present, last bin closed, +1e-6 smoothing
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorewright.config import ID_COL

from scorewright.functions.exprs import hist_bin, psi_band, psi_bin, ratio_half_up


def bin_edges(n_bins: int) -> list[Column]:
    """Lower and upper edge of ``bin`` for any number of bins: one exact division, nothing to round."""
    return [((F.col("bin") - 1 + i).cast("double") / float(n_bins)).alias(n) for i, n in enumerate(("bin_lower", "bin_upper"))]


def histogram(pred: DataFrame, n_bins: int = 10) -> DataFrame:
    """A9 + W2: per run and bin: count, bin edges and the run-relative fraction (4 decimals, exact half-up)."""
    counts = pred.groupBy("run_id", hist_bin("churn_probability", n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    w = Window.partitionBy("run_id")
    return counts.select(
        "run_id",
        "bin",
        *bin_edges(n_bins),
        "count",
        ratio_half_up(F.col("count"), F.sum("count").over(w), 4).alias("fraction"),
    )


def run_distribution(pred: DataFrame, run_id: str, n_bins: int = 10) -> DataFrame:
    """One run's histogram, ordered by bin; the run filter prunes to that run's partition."""
    return histogram(pred.filter(F.col("run_id") == run_id), n_bins).drop("run_id").orderBy("bin")


def tier_totals(pred: DataFrame) -> DataFrame:
    """Rows of each risk tier per run, p = 1.0 included, as the stored tier has it."""
    def tot(tier):
        return F.count(F.when(F.col("risk_tier") == tier, 1)).alias(tier)

    return pred.groupBy("run_id").agg(tot("low"), tot("medium"), tot("high"))


def bin_tier(hist: DataFrame) -> DataFrame:
    """The colour tier of a histogram bin by its midpoint."""
    mid = (F.col("bin_lower") + F.col("bin_upper")) / 2
    return hist.select(
        "*", F.when(mid >= 0.7, "high").when(mid >= 0.4, "medium").otherwise("low").alias("bin_tier")
    )


def side_by_side(hist: DataFrame, run_a: str, run_b: str) -> DataFrame:
    """Two runs' histograms, ordered by run and bin."""
    return hist.filter(F.col("run_id").isin(run_a, run_b)).orderBy("run_id", "bin")


# ---------------------------------------------------------------- PSI


def psi_counts(pred: DataFrame, n_bins: int = 10) -> DataFrame:
    """Per run: count per PSI bin (NULL probabilities form a NULL bin that only counts toward the total)."""
    return pred.groupBy("run_id", psi_bin("churn_probability", n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )


def psi_distribution(counts: DataFrame, n_bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """A10: smoothed fraction per (run, bin) with every bin present: (count + eps) / (n + bins * eps)."""
    totals = counts.groupBy("run_id").agg(F.sum("count").alias("n"))
    grid = totals.select("run_id", "n", F.explode(F.sequence(F.lit(1), F.lit(n_bins))).alias("bin"))
    binned = counts.filter(F.col("bin").isNotNull())
    return grid.join(binned, ["run_id", "bin"], "left").select(
        "run_id",
        "bin",
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
        "n",
        ((F.coalesce(F.col("count"), F.lit(0)) + F.lit(eps)) / (F.col("n") + F.lit(n_bins * eps))).alias("fraction"),
    )


def psi_breakdown(dist: DataFrame, pairs: DataFrame, n_bins: int = 10) -> DataFrame:
    """Per (run, bin) against its reference run: ref, cur, bin PSI and direction. ``pairs`` maps
    ``run_id`` -> ``ref_run_id`` (one row per compared run)."""
    cur = dist.select("run_id", "bin", F.col("fraction").alias("cur"))
    ref = dist.select(F.col("run_id").alias("ref_run_id"), "bin", F.col("fraction").alias("ref"))
    j = pairs.join(cur, "run_id").join(ref, ["ref_run_id", "bin"])
    return j.select(
        "run_id",
        "ref_run_id",
        "bin",
        *bin_edges(n_bins),
        "ref",
        "cur",
        ((F.col("cur") - F.col("ref")) * F.ln(F.col("cur") / F.col("ref"))).alias("psi"),
        F.when(F.col("cur") > F.col("ref"), "+").otherwise("-").alias("direction"),
    )


def psi(breakdown: DataFrame, threshold: float = 0.2) -> DataFrame:
    """A11 + P17 + P22: PSI per compared run, its band, and the strict drift flag (psi > threshold)."""
    s = breakdown.groupBy("run_id", "ref_run_id").agg(F.sum("psi").alias("psi"))
    return s.select(
        "run_id", "ref_run_id", "psi", psi_band("psi").alias("interpretation"), (F.col("psi") > threshold).alias("drift_flagged")
    )


def previous_runs(runs: DataFrame) -> DataFrame:
    """W3 (batch form): for each completed/validated run, the newest such run that started earlier (``lag``)."""
    done = runs.filter(F.col("status").isin("completed", "validated"))
    w = Window.orderBy("started_at", "run_id")  # over runs: one row per run, a bounded table
    return done.select(
        "run_id", "started_at", F.lag("run_id").over(w).alias("ref_run_id")
    )


def previous_run(runs: DataFrame, current_run_id: str) -> DataFrame:
    """W3 (single form): the newest completed/validated run other than the current one that started before it."""
    cur_start = runs.filter(F.col("run_id") == current_run_id).agg(F.max("started_at")).scalar()
    cand = runs.filter(
        F.col("status").isin("completed", "validated")
        & (F.col("run_id") != current_run_id)
        & (F.col("started_at") < cur_start)
    )
    return (
        cand.orderBy(F.col("started_at").desc(), F.col("run_id").desc())
        .limit(1)
        .select("run_id", "started_at")
    )


def psi_history(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last n completed/validated runs with a PSI value, newest first (top-k)."""
    return (
        runs.filter(F.col("status").isin("completed", "validated") & F.col("psi_vs_previous").isNotNull())
        .select("run_id", "started_at", "psi_vs_previous", "drift_flagged", "score_mean", "score_p50", "records_scored")
        .orderBy(F.col("started_at").desc(), F.col("run_id").desc())
        .limit(n)
    )


SAMPLE_ROWS = 200_000  # fixed value: the most rows of a sampled reference


def sampled_reference(pred: DataFrame, run_id: str, fraction: float = 0.2, seed: int = 42, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A uniform sample of a run: the customers whose keyed hash lies in the lowest ``fraction`` of its range, and
    of these the ``rows`` with the least hash. The hash depends on the customer and the seed alone, so the sample is
    the same however the rows are dealt; each task keeps its own least ``rows`` and these are merged. Sampling is the
    feature here; the default PSI uses every row (binning is one cheap aggregate)."""
    key = F.md5(F.concat_ws("|", F.col(ID_COL), F.lit(str(seed))).cast("binary"))
    share = F.conv(F.substring(key, 1, 8), 16, 10).cast("long") < int(fraction * 2**32)
    mine = pred.filter((F.col("run_id") == run_id) & share)
    return mine.withColumn("_key", key).orderBy("_key", ID_COL).limit(rows).drop("_key")
