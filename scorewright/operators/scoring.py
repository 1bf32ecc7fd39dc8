"""Scoring (M9, M10, M12, M13, P13-P16, P20, A6).

The default model is a logistic scorecard written as column expressions: the whole score is one projection inside
whole-stage codegen, with no Python and no shuffle. A Spark ML ``GBTClassifier`` model scores through
``PipelineModel``-style ``transform`` (JVM). Foreign models (any object with ``predict_proba``) go through the one
Python hook, ``mapInPandas`` over Arrow batches with the model shipped once per executor as a broadcast variable.
No step repartitions or coalesces: scoring keeps the input's parallelism.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import FEATURE_COLUMNS, ID_COL
from scorewright.functions.exprs import decile, risk_tier, round_half_even, ts_lit

SCORED_SCHEMA = T.StructType(
    [
        T.StructField(ID_COL, T.StringType(), False),
        T.StructField("churn_probability", T.DoubleType(), True),
        T.StructField("churn_label", T.BooleanType(), True),
        T.StructField("churn_decile", T.IntegerType(), True),
        T.StructField("risk_tier", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class Scorecard:
    """Logistic scorecard: p = 1 / (1 + exp(-(intercept + sum(w_f * x_f)))); a NULL feature contributes 0."""

    intercept: float
    weights: dict[str, float] = field(default_factory=dict)
    version: str = "v1.0.0"

    def shifted(self, delta: float, version: str | None = None) -> "Scorecard":
        return Scorecard(self.intercept + delta, dict(self.weights), version or self.version)

    def logit(self) -> Column:
        z = F.lit(float(self.intercept))
        for f, w in self.weights.items():
            z = z + F.lit(float(w)) * F.coalesce(F.col(f).cast("double"), F.lit(0.0))
        return z

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.logit()))


# The production scorecard's coefficients (model version v1.0.0).
DEFAULT_SCORECARD = Scorecard(
    intercept=-1.0,
    weights={
        "cancel_rate": 2.0,
        "autorenew_rate": -2.5,
        "is_expired": 0.6,
        "never_autorenew": 0.8,
        "has_cancelled": 0.3,
        "last_is_cancel": 0.4,
        "last_is_auto_renew": -0.4,
        "days_to_expire": -0.0015,
        "n_transactions": -0.05,
        "discount_rate": 4.0,
    },
    version="v1.0.0",
)


def derive_outputs(df: DataFrame, prob: Column | str = "p", cfg=None) -> DataFrame:
    """Stored probability rounded to 4 decimals; label, decile and tier from the unrounded p."""
    p = F.col(prob) if isinstance(prob, str) else prob
    high = cfg.tier_high if cfg else 0.70
    medium = cfg.tier_medium if cfg else 0.40
    threshold = cfg.label_threshold if cfg else 0.5
    return df.select(
        F.col(ID_COL),
        round_half_even(p, 4).alias("churn_probability"),
        (p >= threshold).alias("churn_label"),
        decile(p).alias("churn_decile"),
        risk_tier(p, high, medium).alias("risk_tier"),
    )


def score_scorecard(matrix: DataFrame, card: Scorecard = DEFAULT_SCORECARD, cfg=None) -> DataFrame:
    """Score a feature matrix with the expression scorecard: a single projection."""
    return derive_outputs(matrix.select(ID_COL, card.probability().alias("p")), "p", cfg)


def score_spark_model(matrix: DataFrame, model, features_col: str = "features", cfg=None) -> DataFrame:
    """Score with a fitted Spark ML model whose ``transform`` adds a ``probability`` vector (JVM path)."""
    from pyspark.ml.functions import vector_to_array

    from scorewright.operators.model import assemble

    out = model.transform(assemble(matrix, features_col))
    return derive_outputs(out.select(ID_COL, vector_to_array("probability")[1].alias("p")), "p", cfg)


def score_pandas_model(
    matrix: DataFrame, model, feature_cols: list[str] = FEATURE_COLUMNS, cfg=None
) -> DataFrame:
    """M9 hook: a foreign model with ``predict_proba`` on pandas frames, run per Arrow batch via ``mapInPandas``.

    The model is broadcast once (read on the executor inside the function), never captured per task. Python yields
    the probability alone: label, decile and tier have one definition, ``derive_outputs``.
    """
    import numpy as np
    import pandas as pd
    from pyspark import cloudpickle

    shared = matrix.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    key = uuid.uuid4().hex  # of the deserialised model on each worker
    inputs = list(feature_cols)

    def probabilities(frames):
        """Ids and the probability of the positive class; the JVM derives the rest."""
        scorer = _load_model(key, shared)
        for frame in frames:
            p = np.zeros(0) if frame.empty else np.asarray(scorer.predict_proba(frame[inputs].astype("float32")))[:, 1]
            yield pd.DataFrame({ID_COL: frame[ID_COL], "p": p.astype("float64")})

    scored = matrix.select(ID_COL, *inputs).mapInPandas(probabilities, f"{ID_COL} string, p double")
    return derive_outputs(scored, "p", cfg)


_MODELS: dict = {}


def _load_model(key, bc):
    """Deserialise a broadcast model once per Python worker process, not once per batch or task."""
    m = _MODELS.get(key)
    if m is None:
        from pyspark import cloudpickle

        m = cloudpickle.loads(bc.value)
        _MODELS[key] = m
    return m


class PandasScorecard:
    """The expression scorecard as a foreign (numpy) model, for the M9 hook and the M12 agreement check."""

    def __init__(self, card: Scorecard = DEFAULT_SCORECARD, feature_cols: list[str] = FEATURE_COLUMNS):
        self.card = card
        self.feature_cols = list(feature_cols)

    def predict_proba(self, x):
        import numpy as np

        z = np.full(len(x), float(self.card.intercept))
        for f, w in self.card.weights.items():
            col = x[f].to_numpy(dtype="float64")
            z = z + float(w) * np.nan_to_num(col, nan=0.0)
        p = 1.0 / (1.0 + np.exp(-z))
        return np.column_stack([1 - p, p])


def with_lineage(scored: DataFrame, run_id: str, model_version: str, scored_at: dt.datetime) -> DataFrame:
    """Stamp run id, model version and the scoring time (passed in, so every row of a run carries the same)."""
    return scored.select(
        "*",
        F.lit(run_id).alias("run_id"),
        F.lit(model_version).alias("model_version"),
        ts_lit(scored_at).alias("scored_at"),
    )


def constraint_violation(prefix: str = "") -> Column:
    """P20: the stored table's row constraints, negated (probability in [0,1], decile 1..10, tier in the set)."""
    p = F.col(prefix + "churn_probability")
    d = F.col(prefix + "churn_decile")
    t = F.col(prefix + "risk_tier")
    ok = (
        p.isNotNull()
        & p.between(0, 1)
        & d.isNotNull()
        & d.between(1, 10)
        & t.isin("low", "medium", "high")
        & F.col(prefix + "churn_label").isNotNull()
    )
    return ~F.coalesce(ok, F.lit(False))


def split_rejects(pred: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy the constraints, and the rejects (to a reject table rather than failing the whole write)."""
    bad = constraint_violation()
    return pred.filter(~bad), pred.filter(bad)


def observed_counts(df: DataFrame, name: str = "scoring"):
    """Row counts gathered by ``observe`` during the job that writes ``df`` (no extra scan)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count("churn_probability").alias("scored"),
    ), obs
