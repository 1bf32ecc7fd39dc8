"""The training job: customers -> fitted vocabulary + GBT model + evaluation report, saved as model artifacts.

    raw tables --ETL--> customers (written) --engineer/encode--> training matrix (vocabulary fitted here)
    --md5 split--> train / val / test --GBTClassifier (class weights, validation split)--> model
    --transform every split--> AUC, AP, thresholded metrics per split --> report (JSON) + importances

Artifacts under ``<warehouse>/model``: ``vocabulary`` (Parquet table), ``gbt`` (Spark ML model directory),
``report`` (one JSON row per split), ``importances`` (top 15). The nightly job reads the vocabulary and, when asked
to, the model; nothing is pickled and nothing passes through the driver except the model's small tree ensemble.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from scorewright.config import FEATURE_COLUMNS, ID_COL, TARGET_COL, JobConfig
from scorewright.operators import etl, features as FE, model as M
from scorewright.session import cut_lineage
from scorewright.sources import adapter


def model_paths(warehouse: str) -> dict[str, str]:
    base = os.path.join(warehouse, "model")
    return {k: os.path.join(base, k) for k in ("vocabulary", "gbt", "report", "importances")}


def run_training(
    spark: SparkSession,
    sf_dir: str,
    warehouse: str,
    cfg: JobConfig = JobConfig(),
) -> dict:
    """Trains and stores the artifacts. Trees, step, depth and a bound on the rows of the fit are ``cfg``'s."""
    paths = model_paths(warehouse)
    t0 = time.perf_counter()
    lab = adapter.labels(spark, sf_dir, cfg.reference_date)
    mem = adapter.members(spark, sf_dir)
    tx = adapter.transactions(spark, sf_dir, cutoff=cfg.reference_date)
    customers = cut_lineage(etl.build_customers(lab, mem, tx, cfg.reference_date), "training_customers")

    FE.vocabulary(FE.engineer(customers)).write.mode("overwrite").parquet(paths["vocabulary"])
    enc = FE.encoders_from_table(spark.read.parquet(paths["vocabulary"]))
    train_frame = FE.feature_matrix(customers, enc, keep=(ID_COL, TARGET_COL))
    split = cut_lineage(M.assign_split(train_frame, cfg), "training_split")

    gbt = M.train_gbt(split.filter(F.col("split") != "test"), cfg)
    fit_secs = round(time.perf_counter() - t0, 2)
    gbt.write().overwrite().save(paths["gbt"])

    from pyspark.ml.functions import vector_to_array

    scored = gbt.transform(M.assemble(split)).select(
        ID_COL, TARGET_COL, "split", vector_to_array("probability")[1].alias("p")
    )
    best = gbt.getNumTrees  # with early stopping the fit keeps the trees up to the best iteration
    report = M.evaluation(scored).select(
        F.lit(cfg.model_version).alias("model_version"),
        F.lit(best).alias("best_iteration"),
        F.lit(len(FEATURE_COLUMNS)).alias("n_features"),
        F.lit(FEATURE_COLUMNS).alias("feature_columns"),
        F.lit(fit_secs).alias("training_secs"),
        "*",
    )
    report.write.mode("overwrite").json(paths["report"])
    rows = [(i + 1, f, float(v)) for i, (f, v) in enumerate(M.importances(gbt))]
    spark.createDataFrame(rows, "rank int, feature string, importance double").write.mode("overwrite").parquet(
        paths["importances"]
    )
    return {
        "training_time_s": round(time.perf_counter() - t0, 2),
        "n_trees": gbt.getNumTrees,
        "metrics": {r["split"]: r.asDict() for r in spark.read.json(paths["report"]).collect()},
    }
