"""Training and evaluation.

Split: rows are ordered within their label by an md5 of (id, label, seed) and cut at exact quotas, whose keys are
found from counts of the hash; the rows are neither sorted nor shuffled.

Metrics come from one pass: rows are aggregated per (split, unrounded score) with the label and confusion counts, and
running totals over ranges of scores give AUC and average precision; no window holds a whole split. AUC counts ties
as half (Mann-Whitney, equal to the ROC trapezoid); average precision is the step sum over thresholds (not Spark's
trapezoid ``areaUnderPR``).
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import FEATURE_COLUMNS, ID_COL, TARGET_COL, JobConfig
from scorewright.functions.exprs import round_half_even
from scorewright.operators.ranks import running_totals
from scorewright.session import cut_lineage

NULL_SENTINEL = -1e9  # GBTClassifier rejects NaN; no feature takes this value, so a split can set NULLs apart


def split_key(id_col: str = ID_COL, label_col: str = TARGET_COL, seed: int = 42) -> Column:
    """id|label|seed, the text whose hash orders the rows."""
    return F.concat_ws("|", F.col(id_col).cast("string"), F.col(label_col).cast("string"), F.lit(str(seed)))


def split_bucket(id_col: str = ID_COL, label_col: str = TARGET_COL, seed: int = 42) -> Column:
    """Uniform [0, 1) value from md5(id|label|seed): the first 8 hex digits as an integer over 2^32."""
    return F.conv(F.substring(F.md5(split_key(id_col, label_col, seed)), 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def quotas(counts: dict, cfg: JobConfig = JobConfig()) -> dict:
    """Class -> (train, val, test) rows, from class -> rows. The held-out part is rounded up, then the test part of it;
    each part is dealt to the classes by largest remainder (ties: the smaller class), so the three parts and every
    class's share of them are fixed numbers. Fractions are taken as the decimals they are written as."""
    n = sum(counts.values())
    order = sorted(counts, key=lambda c: (c is not None, c))

    def deal(rows: dict, draws: int) -> dict:
        total = max(sum(rows.values()), 1)
        got = {c: rows[c] * draws // total for c in order}
        rest = draws - sum(got.values())
        for c in sorted(order, key=lambda c: -(rows[c] * draws % total))[:rest]:
            got[c] += 1
        return got

    held = 1 - Fraction(str(cfg.train_fraction))
    n_held = math.ceil(held * n)
    n_test = math.ceil(n_held * (held - Fraction(str(cfg.val_fraction))) / held)
    train = deal(counts, n - n_held)
    left = {c: counts[c] - train[c] for c in order}
    val = deal(left, n_held - n_test)
    return {c: (train[c], val[c], left[c] - val[c]) for c in order}


def order_statistics(keyed: DataFrame, wanted: dict) -> dict:
    """(group, rank) -> the key of that rank (from 1) within its group, where ``keyed`` has the columns ``g`` and ``key``
    (hex text) and ``wanted`` maps each group to its ranks.

    Counts of the keys' first four digits (at most 65 536 rows a group) name the one cell that holds a rank; only these
    cells' distinct keys, a 65 536th of all for a hash, are put in order. Rows with one key are counted before the shuffle, so a
    key of any number of rows is one row. The driver gets a row a rank."""
    spark = keyed.sparkSession
    ranks = [(g, int(r)) for g, rs in wanted.items() for r in sorted(set(rs)) if r > 0]
    if not ranks:
        return {}
    asked = spark.createDataFrame(ranks, T.StructType([T.StructField("g", keyed.schema["g"].dataType), T.StructField("r", T.LongType())]))
    cell = F.substring("key", 1, 4)
    upto = Window.partitionBy("g").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    cells = keyed.groupBy("g", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    cells = cells.withColumn("upto", F.sum("n").over(upto))
    a, c = asked.alias("a"), cells.alias("c")
    at = F.col("a.g").eqNullSafe(F.col("c.g")) & (F.col("a.r") <= F.col("upto")) & (F.col("a.r") > F.col("upto") - F.col("n"))
    found = a.join(c, at).select("a.g", "r", "cell", (F.col("r") - F.col("upto") + F.col("n")).alias("within")).collect()
    hit = F.lit(False)
    for f in found:
        hit = hit | (F.col("g").eqNullSafe(F.lit(f["g"])) & (cell == f["cell"]))
    keys = keyed.filter(hit).groupBy("g", cell.alias("cell"), "key").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("g", "cell").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    keys = keys.withColumn("upto", F.sum("n").over(running))
    first = F.lit(False)
    for f in found:
        here = F.col("g").eqNullSafe(F.lit(f["g"])) & (F.col("cell") == f["cell"])
        first = first | (here & F.lit(f["within"]).between(F.col("upto") - F.col("n") + 1, F.col("upto")))
    rows = keys.filter(first).collect()
    out = {}
    for f in found:
        for k in rows:
            if (k["g"], k["cell"]) == (f["g"], f["cell"]) and k["upto"] - k["n"] < f["within"] <= k["upto"]:
                out[f["g"], f["r"]] = k["key"]
    return out


def assign_split(df: DataFrame, cfg: JobConfig = JobConfig()) -> DataFrame:
    """M4: 'train' / 'val' / 'test' per row, of exactly the sizes that ``quotas`` gives.

    Within a class the rows of least md5(id|label|seed) are the training rows, the next ones the validation rows. The two
    cuts of a class are order statistics of the hash, so the rows themselves meet no shuffle: one pass counts, one reads
    the cells of the cuts, and the split is a projection. Rows of one id and label stay together (sizes then differ by
    at most their number); a NULL label is a class of its own, rows without id have one hash."""
    key = F.md5(split_key(seed=cfg.seed))
    keyed = df.select(F.col(TARGET_COL).alias("g"), key.alias("key"))
    counts = {r["g"]: r["n"] for r in keyed.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a class
    parts = quotas(counts, cfg)
    cuts = order_statistics(keyed, {c: (t, t + v) for c, (t, v, _) in parts.items()})
    split = F.lit(None).cast("string")
    for c, (t, v, _) in parts.items():
        mine = F.lit("test")
        for rank, name in ((t + v, "val"), (t, "train")):
            if rank:
                mine = F.when(key <= cuts[c, rank], name).otherwise(mine)
        split = F.when(F.col(TARGET_COL).eqNullSafe(F.lit(c)), mine).otherwise(split)
    return df.withColumn("split", split)


def class_weights(train: DataFrame, label_col: str = TARGET_COL) -> DataFrame:
    """Balanced weights n / (k * n_class) from the training rows (one row per class)."""
    counts = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_class"))
    w = Window.partitionBy()  # over the k class rows only
    return counts.select(
        label_col,
        "n_class",
        (F.sum("n_class").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_class"))).alias("weight"),
    )


def assemble(matrix: DataFrame, out: str = "features", feature_cols: list[str] = FEATURE_COLUMNS) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    filled = matrix.select(
        *[c for c in matrix.columns if c not in feature_cols],
        *[F.coalesce(F.col(c).cast("double"), F.lit(NULL_SENTINEL)).alias(c) for c in feature_cols],
    )
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out).transform(filled)


def best_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """The round of least loss (from 1) up to where ``patience`` rounds brought no gain, and whether that came."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def first_trees(model, n: int):
    """``model`` with its first ``n`` trees alone."""
    from pyspark import SparkContext
    from pyspark.ml.classification import GBTClassificationModel

    whole, jvm = model._java_obj, SparkContext._active_spark_context._jvm
    cut = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        whole.uid(), whole.trees()[0:n], whole.treeWeights()[0:n], whole.numFeatures(), whole.numClasses()
    )
    return GBTClassificationModel(whole.copyValues(cut, whole.extractParamMap()))


def train_gbt(train_val: DataFrame, cfg: JobConfig = JobConfig()):
    """M5: GBT on train rows with balanced class weights; the model has the trees up to the round of least log loss
    (weighted by class as well) on the validation rows, after which ``cfg.stopping_rounds`` rounds brought no gain.

    Spark's own stop has no patience: it ends at the first round that gains less than a tolerance, with a small step
    the second. So a first fit has rounds enough to see the stop; where it does not come, a second has all. Without
    validation rows all trees stay.

    Trees, step and depth are ``cfg``'s; so is a bound on the rows of the fit, which draws them by the split's hash. The
    assembled rows are written once: every level of every tree scans them."""
    from pyspark.ml.classification import GBTClassifier

    if cfg.max_training_rows is not None:
        n = max(train_val.count(), 1)
        train_val = train_val.filter(split_bucket(seed=cfg.seed + 1) < cfg.max_training_rows / n)
    weights = class_weights(train_val.filter(F.col("split") == "train"))
    data = assemble(train_val).join(F.broadcast(weights.select(TARGET_COL, "weight")), TARGET_COL)  # a row a class
    data = data.select("features", "weight", (F.col("split") == "val").alias("is_val"), F.col(TARGET_COL).cast("double").alias("label"))
    data = cut_lineage(data, "training_input")
    train, val = data.filter(~F.col("is_val")), data.filter("is_val")
    gbt = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=cfg.n_trees,
        maxDepth=cfg.max_depth,
        stepSize=cfg.learning_rate,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=cfg.seed,
        maxMemoryInMB=1024,
        cacheNodeIds=False,  # a walk down at most max_depth nodes is cheaper than ids written and joined at each level
        checkpointInterval=10,
    )
    if val.isEmpty():
        return gbt.fit(train)
    for n in sorted({min(2 * cfg.stopping_rounds, cfg.n_trees), cfg.n_trees}):
        model = gbt.setMaxIter(n).fit(train)
        best, stopped = best_round(model.evaluateEachIteration(val), cfg.stopping_rounds)
        if stopped:
            break
    return first_trees(model, best)


def importances(model, feature_cols: list[str] = FEATURE_COLUMNS, top: int = 15) -> list[tuple[str, float]]:
    """Top feature importances (from the fitted model, a small driver-side vector)."""
    vals = model.featureImportances.toArray().tolist()
    pairs = sorted(zip(feature_cols, vals), key=lambda kv: -kv[1])
    return pairs[:top]


# ---------------------------------------------------------------- metrics over score groups


def _confusion(y: Column, yhat: Column) -> list[Column]:
    """Label and prediction counts of a group."""
    return [
        F.sum(y).cast("long").alias("pos"),
        F.sum(1 - y).cast("long").alias("neg"),
        F.sum(y * yhat).cast("long").alias("tp"),
        F.sum((1 - y) * yhat).cast("long").alias("fp"),
    ]


def _thresholded() -> list[Column]:
    """Accuracy, F1, precision, recall, actual and predicted positive rate from pos, neg, tp and fp."""
    n, hits = F.col("pos") + F.col("neg"), F.col("tp") + F.col("fp")
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    values = {
        "accuracy": (F.col("tp") + F.col("neg") - F.col("fp")) / n,
        "f1": share(2 * F.col("tp"), F.col("pos") + hits),
        "precision": share(F.col("tp"), hits),
        "recall": share(F.col("tp"), F.col("pos")),
        "churn_rate_actual": F.col("pos") / n,
        "churn_rate_predicted": hits / n,
    }
    return [n.alias("n_samples"), *(round_half_even(v, 4).alias(k) for k, v in values.items())]


def evaluation(
    scored: DataFrame,
    score_col: str = "p",
    label_col: str = TARGET_COL,
    threshold: float = 0.5,
    pred_col: str | None = None,
    group: tuple[str, ...] = ("split",),
) -> DataFrame:
    """Per-group report: sizes, AUC, AP and the thresholded metrics, from one aggregate over the scored rows.

    ``pred_col`` holds the predicted label; without one it is ``score_col >= threshold``."""
    yhat = F.col(pred_col).cast("int") if pred_col else (F.col(score_col) >= threshold).cast("int")
    g = scored.groupBy(*group, F.col(score_col).alias("score")).agg(*_confusion(F.col(label_col).cast("int"), yhat))
    c = running_totals(g, list(group), [F.col("score").desc_nulls_last()], {"pos": "pos_from", "neg": "neg_from"})
    pairs = F.col("neg") * (F.col("pos_from") - F.col("pos") * 0.5)  # positives above a negative, ties as half
    steps = F.col("pos") * F.col("pos_from") / (F.col("pos_from") + F.col("neg_from"))
    sums = [F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp")]
    total = c.groupBy(*group).agg(*sums, F.sum(pairs).alias("pairs"), F.sum(steps).alias("steps"))
    return total.select(
        *group,
        *_thresholded(),
        round_half_even(F.try_divide(F.col("pairs"), F.col("pos") * F.col("neg")), 4).alias("auc_roc"),
        round_half_even(F.try_divide(F.col("steps"), F.col("pos")), 4).alias("avg_precision"),
    )


def auc_roc(scored: DataFrame, score_col: str = "p", label_col: str = TARGET_COL, group=("split",)) -> DataFrame:
    """M6: AUC-ROC per group = P(score_pos > score_neg) + 0.5 P(tie)."""
    return evaluation(scored, score_col, label_col, group=tuple(group)).select(*group, "auc_roc")


def average_precision(scored: DataFrame, score_col: str = "p", label_col: str = TARGET_COL, group=("split",)) -> DataFrame:
    """M7: sum over thresholds (descending distinct scores) of (recall step) * precision."""
    return evaluation(scored, score_col, label_col, group=tuple(group)).select(*group, "avg_precision")


def split_metrics(scored: DataFrame, pred_col: str = "pred", label_col: str = TARGET_COL, group=("split",)) -> DataFrame:
    """M8: accuracy, F1, precision, recall, actual and predicted positive rates per group (confusion counts)."""
    c = scored.groupBy(*group).agg(*_confusion(F.col(label_col).cast("int"), F.col(pred_col).cast("int")))
    return c.select(*group, *_thresholded())
