"""Stored tables and the queries over them.

Storage model:
    predictions  Parquet partitioned by ``run_id`` (one directory per run: run filters prune files; a re-run
                 night replaces only its own directory)
    run_events   append-only log of partial run updates; the run table is a fold of it (no row updates needed)
    latest_scores  one row per customer, bucketed by customer (``keyed``), a new version a night

Latest score per customer is a ``max_by`` aggregate keyed by customer: mergeable, so a customer present in every
run, or a run holding a third of all rows, never concentrates in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import ID_COL
from scorewright.functions.exprs import ratio_half_up
from scorewright.operators import keyed

PREDICTION_COLUMNS = [
    ID_COL,
    "run_id",
    "model_version",
    "churn_probability",
    "churn_label",
    "churn_decile",
    "risk_tier",
    "scored_at",
]

# Fields a run row can carry; each event names the ones it sets (``set_fields``), so an explicit NULL is a value.
RUN_FIELDS = [
    ("model_version", T.StringType()),
    ("started_at", T.TimestampNTZType()),
    ("completed_at", T.TimestampNTZType()),
    ("status", T.StringType()),
    ("records_read", T.LongType()),
    ("records_scored", T.LongType()),
    ("records_failed", T.LongType()),
    ("spark_duration_secs", T.DoubleType()),
    ("total_duration_secs", T.DoubleType()),
    ("score_mean", T.DoubleType()),
    ("score_std", T.DoubleType()),
    ("score_p10", T.DoubleType()),
    ("score_p25", T.DoubleType()),
    ("score_p50", T.DoubleType()),
    ("score_p75", T.DoubleType()),
    ("score_p90", T.DoubleType()),
    ("psi_vs_previous", T.DoubleType()),
    ("drift_flagged", T.BooleanType()),
    ("validation_passed", T.BooleanType()),
    ("validation_notes", T.StringType()),
]
RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("attempt", T.LongType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("event", T.StringType(), False),
        T.StructField("set_fields", T.ArrayType(T.StringType()), False),
    ]
    + [T.StructField(n, t, True) for n, t in RUN_FIELDS]
)


def write_predictions(pred: DataFrame, path: str) -> None:
    """Write a run's rows under its own ``run_id=`` directory, as parallel as the scoring was.

    Dynamic partition overwrite replaces only the run directories present in ``pred``: other runs stay, and a
    retried or re-run night replaces its own partition instead of appending a second copy (idempotent publish).
    Rows are sorted by run and customer within each task (no shuffle), which is the order the partitioned writer asks
    for, so it keeps it: every file's row groups cover narrow id ranges and a point lookup skips all but one row group per file via Parquet min/max statistics (the index stand-in).
    """
    (
        pred.select(*PREDICTION_COLUMNS)
        .sortWithinPartitions("run_id", ID_COL)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def register_runs(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Registrations that do not conflict with an existing run id (``ON CONFLICT DO NOTHING``); within the new
    batch the first registration per run (lowest ``seq``) wins."""
    first = new.groupBy("run_id").agg(F.min_by(F.struct(*new.columns), F.col("seq")).alias("r")).select("r.*")
    return first.join(existing.select("run_id"), "run_id", "left_anti")


def last_attempts(events: DataFrame) -> DataFrame:
    """Events of each run's last attempt. A run that is done again begins a new attempt, which replaces the earlier
    one in every field, also in those that it leaves unset."""
    last = events.groupBy("run_id").agg(F.max("attempt").alias("attempt"))
    return events.join(last, ["run_id", "attempt"], "left_semi")


def effective_events(events: DataFrame) -> DataFrame:
    """Events of the last attempts with S5 applied: only the first registration of an attempt counts."""
    events = last_attempts(events)
    regs = events.filter(F.col("event") == "register")
    kept = register_runs(events.limit(0), regs)
    return events.filter(F.col("event") != "register").unionByName(kept)


def fold_runs(events: DataFrame) -> DataFrame:
    """The run table as the fold of its event log: per field, the value of the last attempt's newest event that
    set it. Events are ordered by (attempt, seq); an attempt writes each seq once.

    ``max_by`` over an ordering that is NULL where the event did not set the field acts as
    ``max_by(v, seq) FILTER (WHERE set)``; a newest explicit NULL wins.
    """
    aggs = [
        F.max_by(F.col(n), F.when(F.array_contains("set_fields", n), F.col("seq"))).alias(n) for n, _ in RUN_FIELDS
    ]
    return effective_events(events).groupBy("run_id").agg(*aggs)


def run_summary(runs: DataFrame) -> DataFrame:
    """The run summary view: selected fields, rate = round(scored / nullif(secs, 0)), wall-clock secs."""
    rate = F.round(F.try_divide(F.col("records_scored").cast("double"), F.col("spark_duration_secs")), 0)
    wall = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("completed_at"))  # wall clock, no time zone
    return runs.select(
        "run_id",
        "model_version",
        "started_at",
        "completed_at",
        "status",
        "records_scored",
        "spark_duration_secs",
        "total_duration_secs",
        "score_mean",
        "score_p50",
        "psi_vs_previous",
        "drift_flagged",
        "validation_passed",
        rate.alias("records_per_second"),
        (wall.cast("double") / F.lit(1e6)).alias("wall_clock_secs"),
    )


def latest_scores(pred: DataFrame) -> DataFrame:
    """W1 from the whole history: newest score per customer (scored_at, then run id to break ties), as one mergeable
    aggregate. Needed once, to rebuild; ``merge_latest`` keeps the result up to date."""
    cols = [c for c in PREDICTION_COLUMNS if c != ID_COL]
    return (
        pred.groupBy(ID_COL)
        .agg(F.max_by(F.struct(*cols), F.struct("scored_at", "run_id")).alias("r"))
        .select(ID_COL, *[F.col(f"r.{c}").alias(c) for c in cols])
    )


def merge_latest(latest: DataFrame, published: DataFrame) -> DataFrame:
    """W1 kept up to date: the stored latest scores with one newly published run merged in. Only the two tables meet,
    one row per customer each, whatever the length of the history."""
    cols = PREDICTION_COLUMNS
    old = latest.select(F.col(ID_COL), F.struct(*cols).alias("old"))
    new = published.select(F.col(ID_COL), F.struct(*cols).alias("new"))
    newer = F.col("old").isNull() | (F.struct("new.scored_at", "new.run_id") >= F.struct("old.scored_at", "old.run_id"))
    both = old.join(new, ID_COL, "full")
    return both.select(F.when(F.col("new").isNotNull() & newer, F.col("new")).otherwise(F.col("old")).alias("r")).select("r.*")


def without_run(latest: DataFrame, run_id: str, history: DataFrame) -> DataFrame:
    """W1 without a run: its rows go, and their customers get their newest score of the other runs in ``history``. This
    is ``latest`` itself where the run has no rows in it; history is read only where it has."""
    stale = latest.filter(F.col("run_id") == run_id).select(ID_COL)
    if stale.isEmpty():
        return latest
    others = latest.filter(F.col("run_id") != run_id).select(*PREDICTION_COLUMNS)
    again = history.filter(F.col("run_id") != run_id).select(*PREDICTION_COLUMNS).join(stale, ID_COL, "left_semi")
    return others.unionByName(latest_scores(again).select(*PREDICTION_COLUMNS))


def replace_run(latest: DataFrame, run_id: str, published: DataFrame, history: DataFrame) -> DataFrame:
    """W1 after a run was done again or taken back: what its earlier attempt left in ``latest`` goes, and ``published``,
    the run's rows now (none if it was taken back), are merged in."""
    return merge_latest(without_run(latest, run_id, history), published)


def next_latest(
    spark: SparkSession, old_path: str | None, new_path: str, run_id: str, published: DataFrame, history: DataFrame
) -> None:
    """W1 as stored: a keyed table at ``new_path`` made from the one at ``old_path`` (None: there is none yet) and the rows
    that a run has now. A new run's rows are brought to the buckets of the stored ones, which stay where they are; only
    a run that had rows before, or a table that outgrew its buckets, moves the stored rows too."""
    published = published.select(*PREDICTION_COLUMNS)
    rows = published.count()  # of files: from their footers
    if old_path is None:
        keyed.write_keyed(published, new_path, keyed.buckets_for(rows))
        return
    old, note = keyed.read_keyed(spark, old_path), keyed.keyed_note(spark, old_path)
    had = note["buckets"] if note else 0
    buckets = max(had, keyed.buckets_for(max(rows, old.count())))
    others = without_run(old, run_id, history)
    moved = others is not old or buckets != had
    keyed.write_keyed(merge_latest(others, published).select(*PREDICTION_COLUMNS), new_path, buckets, moved=moved)


def score_for(latest: DataFrame, customer_id: str) -> DataFrame:
    """Latest score of one customer. The id filter is pushed into the scan of the latest scores, which opens one
    file where these are stored by key."""
    return latest.filter(F.col(ID_COL) == customer_id).select(*PREDICTION_COLUMNS)


def high_risk(pred: DataFrame) -> DataFrame:
    """The high-tier rows (the partial index of the reference becomes a pushed-down filter on the scan)."""
    return pred.filter(F.col("risk_tier") == "high").select(*PREDICTION_COLUMNS)


# ---------------------------------------------------------------- bulk lookup


MAX_REQUEST_IDS = 500  # fixed value: the longest bulk request that is answered


def parse_id_lines(lines: DataFrame, text_col: str, order_cols: list[str]) -> DataFrame:
    """Trim each line and drop blanks; the order columns keep the order of the lines."""
    t = lines.select(*order_cols, F.trim(F.col(text_col)).alias("customer_id"))
    return t.filter(F.col("customer_id") != "")


def parse_id_text(text: DataFrame, text_col: str) -> DataFrame:
    """P21 on pasted texts: split by newline with positions, then as ``parse_id_lines``."""
    lines = text.select(F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    return parse_id_lines(lines, "line", ["pos"])


def checked_request(ids: DataFrame, max_ids: int = MAX_REQUEST_IDS) -> DataFrame:
    """The request, if it has at most ``max_ids`` ids; a longer one is refused as a whole, never cut."""
    n = ids.limit(max_ids + 1).count()
    if n > max_ids:
        raise ValueError(f"a request may hold {max_ids} ids")
    return ids


def dedupe_ids(ids: DataFrame, order_cols: list[str]) -> DataFrame:
    """Each id once, with the order columns of its first occurrence (so request order can be restored)."""
    first = ids.groupBy(ID_COL).agg(F.min(F.struct(*order_cols)).alias("o"))
    return first.select(ID_COL, *[F.col(f"o.{c}").alias(c) for c in order_cols])


def _order(request: DataFrame) -> list[str]:
    return [c for c in request.columns if c != ID_COL]


def bulk_found(request: DataFrame, latest: DataFrame) -> DataFrame:
    """Latest score of each requested id that has one, in request order, with the order columns. ``latest`` has a
    row per customer; the join is planned by the request's measured size."""
    order = _order(request)
    return latest.select(*PREDICTION_COLUMNS).join(request.select(ID_COL, *order), ID_COL).orderBy(*order, ID_COL)


def bulk_not_found(request: DataFrame, latest: DataFrame) -> DataFrame:
    """Requested ids without a score, in request order, with the order columns."""
    return request.join(latest.select(ID_COL), ID_COL, "left_anti").orderBy(*_order(request), ID_COL)


def bulk_summary(request: DataFrame, latest: DataFrame) -> DataFrame:
    """Requested and found counts."""
    found = latest.select(ID_COL, F.lit(1).alias("_found"))
    j = request.select(ID_COL).join(found, ID_COL, "left")
    return j.agg(F.count(F.lit(1)).alias("total_requested"), F.count("_found").alias("total_found"))


# ---------------------------------------------------------------- run listings


def runs_page(summary: DataFrame, page: int = 1, size: int = 50, status: str | None = None) -> DataFrame:
    """Newest first, LIMIT/OFFSET paging, optional status filter."""
    s = summary if status is None else summary.filter(F.col("status") == status)
    return s.orderBy(F.col("started_at").desc(), F.col("run_id")).offset((page - 1) * size).limit(size)


def runs_total(runs: DataFrame, status: str | None = None) -> DataFrame:
    """Total for the paged list, optionally by status."""
    s = runs if status is None else runs.filter(F.col("status") == status)
    return s.agg(F.count(F.lit(1)).alias("total"))


def newest(df: DataFrame, n: int = 1, ts: str = "started_at") -> DataFrame:
    """Top-n newest rows (planned as TakeOrderedAndProject)."""
    return df.orderBy(F.col(ts).desc(), F.col("run_id").desc()).limit(n)


def latest_completed(summary: DataFrame) -> DataFrame:
    """Newest run with status completed or validated."""
    return newest(summary.filter(F.col("status").isin("completed", "validated")))


def health(runs: DataFrame) -> DataFrame:
    """Newest run id and its status."""
    return newest(runs).select(F.col("run_id").alias("latest_run_id"), F.col("status").alias("latest_run_status"))


def _done(c: Column) -> Column:
    return c.isin("completed", "validated")


def pipeline_totals(runs: DataFrame, pred: DataFrame) -> DataFrame:
    """Runs, predictions, latest completed run and its completion time, latest model version, and averages
    over validated runs, as one aggregate per table (no per-field subqueries)."""
    r = runs.agg(
        F.count(F.lit(1)).alias("total_batch_runs"),
        F.max_by(F.when(_done(F.col("status")), F.col("run_id")), F.when(_done(F.col("status")), F.col("started_at")))
        .alias("latest_run_id"),
        F.max_by(
            F.when(_done(F.col("status")), F.col("completed_at")), F.when(_done(F.col("status")), F.col("started_at"))
        ).alias("latest_run_completed_at"),
        F.max_by("model_version", "started_at").alias("latest_model_version"),
        F.avg(F.when(F.col("status") == "validated", F.col("spark_duration_secs"))).alias("avg_spark_duration_secs"),
        F.avg(
            F.when(
                F.col("status") == "validated",
                F.try_divide(F.col("records_scored").cast("double"), F.col("spark_duration_secs")),
            )
        ).alias("avg_records_per_second"),
    )
    total_predictions = pred.agg(F.count(F.lit(1))).scalar()  # scalar subquery, planned once
    return r.select(
        "total_batch_runs",
        total_predictions.alias("total_predictions"),
        "latest_run_id",
        "latest_run_completed_at",
        "latest_model_version",
        F.round("avg_spark_duration_secs", 2).alias("avg_spark_duration_secs"),
        F.round("avg_records_per_second", 0).alias("avg_records_per_second"),
    )


def trend(summary: DataFrame) -> DataFrame:
    """Runs with a mean score, oldest first: run date, mean, median and PSI."""
    return (
        summary.filter(F.col("score_mean").isNotNull())
        .select(
            "run_id",
            F.to_date("started_at").alias("date"),
            F.col("score_mean").alias("mean"),
            F.col("score_p50").alias("p50"),
            F.col("psi_vs_previous").alias("psi"),
            "started_at",
        )
        .orderBy("started_at", "run_id")
        .drop("started_at")
    )


def fraction_half_up(count: Column | str, total: Column | str, digits: int = 4) -> Column:
    return ratio_half_up(count, total, digits)
