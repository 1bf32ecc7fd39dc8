"""Batch-quality gates (V1-V6) and score statistics."""

import numpy as np
import pytest

from scorewright.config import GateConfig
from scorewright.operators import quality


def _scored(spark, probs):
    probs = [None if p is None else float(p) for p in probs]
    rows = [(p, None if p is None else p >= 0.5) for p in probs]
    return spark.createDataFrame(rows, "churn_probability double, churn_label boolean")


def _gate(spark, probs, n_read):
    return quality.gate_frame(_scored(spark, probs), n_read).first()


def _spread(n):
    return [i / (n - 1) for i in range(n)]


def test_a_batch_within_all_limits_has_no_notes(spark):
    g = _gate(spark, _spread(50), 50)
    assert (g["validation_passed"], g["status"], g["validation_notes"], g["n_failed"]) == (True, "completed", None, 0)
    quality.enforce(quality.gate_frame(_scored(spark, _spread(50)), 50))


@pytest.mark.parametrize("width, passes", [(0.0, False), (0.018, False), (0.03, True)])
def test_scores_must_spread(spark, width, passes):
    """Two values ``width`` apart, half of the rows each: the sample deviation is about width / 2, the limit 0.01."""
    probs = [0.5, 0.5 + width] * 40
    assert _gate(spark, probs, 80)["validation_passed"] is passes
    if not passes:
        with pytest.raises(quality.GateFailure, match="degenerate"):
            quality.enforce(quality.gate_frame(_scored(spark, probs), 80))


@pytest.mark.parametrize("scored, passes", [(90, True), (89, False)])
def test_nine_in_ten_rows_must_be_scored(spark, scored, passes):
    g = _gate(spark, _spread(scored), 100)
    assert g["validation_passed"] is passes and g["n_failed"] == 100 - scored
    assert passes or g["validation_notes"].startswith(f"dropped: {scored} of 100")


def test_absolute_count_and_narrow_rate_as_configured(spark):
    cfg = GateConfig(min_records_expected=60, churn_rate_range=(0.05, 0.50))
    g = quality.gate_frame(_scored(spark, _spread(50)), 50, cfg).first()
    assert not g["validation_passed"] and "only 50 rows scored, expected 60" in g["validation_notes"]
    g = quality.gate_frame(_scored(spark, [0.4] * 24 + [0.9] * 36), 60, cfg).first()
    assert g["validation_passed"] and "churn rate" in g["validation_notes"]


def test_null_scores_fail_and_range_is_checked(spark):
    g = _gate(spark, [None] * 10, 10)
    assert not g["validation_passed"]
    assert "null score rate" in g["validation_notes"] and "degenerate" in g["validation_notes"]
    g = _gate(spark, [0.1, 0.9, 1.2, 0.5] * 10, 40)
    assert "scores out of range" in g["validation_notes"]


def test_churn_rate_outside_range_only_warns(spark):
    rng = np.random.default_rng(1)
    g = _gate(spark, rng.uniform(0.6, 1.0, 200), 200)
    assert g["validation_passed"] and "predicted churn rate" in g["validation_notes"]


def test_score_stats_match_numpy(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.uniform(0, 1, 997), 4)
    s = quality.score_stats(_scored(spark, p)).first()
    assert s["score_mean"] == round(float(np.round(p.mean(), 4)), 4)
    assert abs(s["score_std"] - np.round(p.std(), 4)) < 1e-9
    for q, name in [(10, "p10"), (25, "p25"), (50, "p50"), (75, "p75"), (90, "p90")]:
        assert abs(s[f"score_{name}"] - np.round(np.percentile(p, q), 4)) < 1e-9


def test_positive_rate(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "is_churn int")
    assert quality.positive_rate(df, "is_churn").first()[0] == 0.25
