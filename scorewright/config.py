"""Job parameters. A plain dataclass: the scheduler passes values, nothing is read from the environment."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the reference for equal results.
NUMERIC_FEATURES = [
    "bd",
    "registration_days",
    "n_transactions",
    "total_paid",
    "avg_plan_price",
    "avg_plan_days",
    "total_discount",
    "n_auto_renew",
    "n_cancels",
    "membership_tenure_days",
    "days_to_expire",
]
CATEGORICAL_FEATURES = [
    "city",
    "gender",
    "registered_via",
    "payment_method_id",
    "last_is_auto_renew",
    "last_is_cancel",
]
ENGINEERED_FEATURES = [
    "discount_rate",
    "paid_per_txn",
    "cancel_rate",
    "autorenew_rate",
    "is_expired",
    "never_autorenew",
    "has_cancelled",
]
# Trained column order: raw numeric, categorical, then engineered (24 columns).
FEATURE_COLUMNS = NUMERIC_FEATURES + CATEGORICAL_FEATURES + ENGINEERED_FEATURES
ID_COL = "customer_id"
TARGET_COL = "is_churn"
TX_COLUMNS = [
    "n_transactions",
    "total_paid",
    "avg_plan_price",
    "avg_plan_days",
    "n_auto_renew",
    "n_cancels",
    "payment_method_id",
    "last_is_auto_renew",
    "last_is_cancel",
    "total_discount",
    "membership_tenure_days",
    "days_to_expire",
]
# Fixed values (continued): score derivation, drift bands and gate thresholds.
LABEL_THRESHOLD = 0.5
TIER_HIGH = 0.70
TIER_MEDIUM = 0.40
PSI_STABLE_BELOW = 0.10
PSI_MODERATE_BELOW = 0.20
PSI_THRESHOLD = 0.2
PSI_N_BINS = 10
PSI_EPSILON = 1e-6
GBT_TREES = 500
GBT_LEARNING_RATE = 0.05
GBT_STOPPING_ROUNDS = 50
GATE_MIN_SCORED_FRACTION = 0.9
GATE_MAX_NULL_SCORE_PCT = 0.001
GATE_MIN_STD = 0.01
GATE_CHURN_RATE_RANGE = (0.05, 0.60)


@dataclass(frozen=True)
class GateConfig:
    """Batch-quality thresholds (relative count gate of the pandas path; absolute one is optional)."""

    min_scored_fraction: float = GATE_MIN_SCORED_FRACTION
    min_records_expected: int | None = None
    max_null_score_pct: float = GATE_MAX_NULL_SCORE_PCT
    score_range: tuple[float, float] = (0.0, 1.0)
    min_std: float = GATE_MIN_STD
    churn_rate_range: tuple[float, float] = GATE_CHURN_RATE_RANGE


@dataclass(frozen=True)
class JobConfig:
    reference_date: dt.date = dt.date(2000, 8, 1)
    model_version: str = "v1.0.0"
    psi_n_bins: int = PSI_N_BINS
    psi_threshold: float = PSI_THRESHOLD
    psi_epsilon: float = PSI_EPSILON
    label_threshold: float = LABEL_THRESHOLD
    tier_high: float = TIER_HIGH
    tier_medium: float = TIER_MEDIUM
    seed: int = 42
    train_fraction: float = 0.70
    val_fraction: float = 0.15
    n_trees: int = GBT_TREES
    learning_rate: float = GBT_LEARNING_RATE
    stopping_rounds: int = GBT_STOPPING_ROUNDS  # so many rounds without gain on the validation rows end the fit
    max_depth: int = 5
    max_training_rows: int | None = None  # about so many labelled rows are drawn for the fit; None: all
    gates: GateConfig = field(default_factory=GateConfig)
