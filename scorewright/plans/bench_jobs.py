"""Timed scoring jobs and the queries over their timings.

Each engine scores first-N slices of the customer table (S7) at several sizes into the ``noop`` sink, so the
measured time is the scoring plan alone (scan, features, score), with a warm-up run discarded. Engines:
    spark_expr    the expression scorecard (JVM, codegen)
    spark_pandas  the same scorecard through the ``mapInPandas`` hook (Arrow batches, Python workers)
Timings are measurements, so these queries are checked on rows only.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.operators import etl, features as FE, scoring
from scorewright.session import cut_lineage

SLICE_FRACTIONS = (0.1, 0.5, 1.0)
ENGINES = ("spark_expr", "spark_pandas")
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("engine", T.StringType(), False),
        T.StructField("sample_size", T.LongType(), False),
        T.StructField("duration_secs", T.DoubleType(), False),
        T.StructField("records_per_second", T.DoubleType(), False),
        T.StructField("cpu_cores_used", T.IntegerType(), True),
        T.StructField("benchmarked_at", T.TimestampNTZType(), False),
    ]
)


def _score(engine: str, matrix: DataFrame) -> DataFrame:
    if engine == "spark_expr":
        return scoring.score_scorecard(matrix)
    return scoring.score_pandas_model(matrix, scoring.PandasScorecard())


def timed_scoring(spark: SparkSession, sf_dir: str, run_id: str, warmup_rows: int = 100) -> DataFrame:
    from scorewright.plans.registry import customers

    base = cut_lineage(customers(spark, sf_dir), "timed_customers")  # the times are of scoring, not of the ETL
    _, enc = FE.training_frame(base)
    n_total = base.count()
    cores = spark.sparkContext.defaultParallelism
    rows = []
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)
    for engine in ENGINES:
        warm = FE.feature_matrix(etl.first_n(base, warmup_rows), enc)
        _score(engine, warm).write.format("noop").mode("overwrite").save()
        for frac in SLICE_FRACTIONS:
            n = max(1, int(n_total * frac))
            sliced = FE.feature_matrix(cut_lineage(etl.first_n(base, n), "slice"), enc)
            t0 = time.perf_counter()
            _score(engine, sliced).write.format("noop").mode("overwrite").save()
            secs = time.perf_counter() - t0
            rows.append((run_id, engine, n, round(secs, 4), round(n / secs, 2) if secs > 0 else 0.0, cores, now))
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def engine_pivot(metrics: DataFrame) -> DataFrame:
    """Sample size x engine, records per second."""
    return metrics.groupBy("sample_size").pivot("engine", list(ENGINES)).agg(F.first("records_per_second")).orderBy(
        "sample_size"
    )


def speedup(metrics: DataFrame, base: str = "spark_pandas", fast: str = "spark_expr") -> DataFrame:
    """Rate ratio of two engines at the largest sample size."""
    top = metrics.agg(F.max("sample_size").alias("max_size"))
    at_max = metrics.join(top, metrics.sample_size == top.max_size)
    return at_max.agg(
        F.max(F.when(F.col("engine") == fast, F.col("records_per_second"))).alias("fast_rps"),
        F.max(F.when(F.col("engine") == base, F.col("records_per_second"))).alias("base_rps"),
    ).select(F.round(F.try_divide(F.col("fast_rps"), F.col("base_rps")), 2).alias(f"{fast}_vs_{base}_speedup"))


def latest_set(metrics: DataFrame, run_id: str | None = None) -> DataFrame:
    """Rows of one timing run (given, or the newest by timestamp), ordered by engine and size."""
    if run_id is None:
        newest = metrics.orderBy(F.col("benchmarked_at").desc()).limit(1).select("run_id")
        sel = metrics.join(newest, "run_id", "left_semi")
    else:
        sel = metrics.filter(F.col("run_id") == run_id)
    return sel.orderBy("engine", "sample_size")


__all__ = ["timed_scoring", "engine_pivot", "speedup", "latest_set"]
