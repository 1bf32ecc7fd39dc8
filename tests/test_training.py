"""M5: trees and stopping rounds of the fit."""

from dataclasses import replace

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import functions as F

from scorewright.config import FEATURE_COLUMNS, ID_COL, TARGET_COL, JobConfig
from scorewright.operators import model as M
from scorewright.plans import registry as R


def _frame(spark, n=600):
    """The first feature tells the label apart, four times in five."""
    u = F.pmod(F.xxhash64("id"), F.lit(10))
    x = (F.col("id") % 7).cast("double")
    y = ((x > 3) != (u < 2)).cast("int")
    return spark.range(n).select(
        F.col("id").cast("string").alias(ID_COL), y.alias(TARGET_COL), F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"),
        x.alias(FEATURE_COLUMNS[0]), *[F.lit(0.0).alias(c) for c in FEATURE_COLUMNS[1:]],
    )


def test_registered_queries_train_with_the_job_s_parameters(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(R, "_memo", lambda spark, sf_dir, what, build: build())
    monkeypatch.setattr(R, "split_frame", lambda spark, sf_dir: _frame(spark, 10))
    monkeypatch.setattr(M, "train_gbt", lambda frame, cfg=JobConfig(): seen.append(cfg))
    R.gbt_model(spark, "unread")
    assert seen == [JobConfig()] and seen[0].n_trees == 500 and seen[0].learning_rate == 0.05


def test_small_gains_do_not_end_the_fit(spark):
    """Each round gains less than a thousandth of the loss."""
    assert M.train_gbt(_frame(spark), JobConfig(n_trees=8, learning_rate=0.0005, max_depth=2)).getNumTrees == 8


def test_the_fit_ends_after_rounds_without_gain(spark, tmp_path):
    cfg = JobConfig(n_trees=40, learning_rate=1.0, max_depth=2, stopping_rounds=3)
    noise = _frame(spark).withColumn(TARGET_COL, F.pmod(F.xxhash64("customer_id"), F.lit(2)).cast("int"))
    noise = noise.withColumn(FEATURE_COLUMNS[0], F.col("customer_id").cast("double"))
    whole = M.train_gbt(noise, replace(cfg, stopping_rounds=40))
    kept = M.train_gbt(noise, cfg)
    assert 1 <= kept.getNumTrees < 40 and kept.getNumTrees <= whole.getNumTrees
    kept.write().save(str(tmp_path / "m"))
    assert GBTClassificationModel.load(str(tmp_path / "m")).getNumTrees == kept.getNumTrees


def test_best_round():
    assert M.best_round([3.0, 2.0, 2.5, 2.4, 1.0], 2) == (2, True)
    assert M.best_round([3.0, 2.0, 2.5, 1.9, 2.0], 2) == (4, False)
    assert M.best_round([3.0, 2.0, 1.0], 1) == (3, False)


def test_no_table_of_node_ids_is_kept_beside_the_rows(spark, monkeypatch):
    """The trees are those of a fit that keeps one, which costs a pass over it at every level."""
    from pyspark.ml.classification import GBTClassifier

    fit, kept, trees = GBTClassifier.fit, [], []

    def both(self, rows):
        kept.append(self.getCacheNodeIds())
        for cached in (True, False):
            model = fit(self.copy().setCacheNodeIds(cached), rows)
            trees.append(model.toDebugString.split("\n", 1)[1])
        return model

    monkeypatch.setattr(GBTClassifier, "fit", both)
    M.train_gbt(_frame(spark), JobConfig(n_trees=8, learning_rate=0.1, max_depth=3))
    assert kept == [False]
    assert trees[0] == trees[1] and trees[0].count("Tree ") == 8
