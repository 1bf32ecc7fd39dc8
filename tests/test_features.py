"""Feature layer: flags, dirty age, encoders, train/serve parity, score derivation."""

import math

from pyspark.sql import functions as F

from scorewright.operators import features as FE, scoring

ROWS = [
    ("k1", 100, 40, 7, 700.5, 100.0, 31.0, 70.25, 2, 0, 210, 0, 5, "female", 3, 2, 0, 0, 1),
    ("k2", 101, 41, 0, 0.0, 0.0, 0.0, 0.0, 0, 0, 0, -1, 22, "None", 4, 11, 0, 0, 0),
    ("k3", 0, None, 3, -9.0, 5.0, 1.0, 3.0, 3, 3, 12, 400, 5, None, 3, 2, 1, 1, 1),
    ("k4", -1, 7, 1, 12.0, 12.0, 30.0, 1.0, 1, 1, 1, None, None, "nan", None, None, None, None, 0),
]
SCHEMA = (
    "customer_id string, bd int, registration_days int, n_transactions int, total_paid double, "
    "avg_plan_price double, avg_plan_days double, total_discount double, n_auto_renew int, n_cancels int, "
    "membership_tenure_days int, days_to_expire int, city int, gender string, registered_via int, "
    "payment_method_id int, last_is_auto_renew int, last_is_cancel int, is_churn int"
)


def _raw(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def test_ages_beyond_their_bounds_are_unknown(spark):
    assert {r["customer_id"]: r["bd"] for r in FE.engineer(_raw(spark)).collect()} == {"k1": 100, "k2": None, "k3": 0, "k4": None}


def test_ratios_and_flags_at_their_boundaries(spark):
    eng = {r["customer_id"]: r for r in FE.engineer(_raw(spark)).collect()}
    for name, raw in zip(("k1", "k2", "k3", "k4"), ROWS):
        n, paid, discount, renewed, cancelled, expire = raw[3], raw[4], raw[7], raw[8], raw[9], raw[11]
        got = eng[name]
        assert got["discount_rate"] == round(discount / (abs(paid) + 1), 4) and got["paid_per_txn"] == round(paid / (n + 1), 4)
        assert got["cancel_rate"] == round(cancelled / (n + 1), 4) and got["autorenew_rate"] == round(renewed / (n + 1), 4)
        assert (got["is_expired"], got["never_autorenew"], got["has_cancelled"]) == (int(expire is not None and expire < 0), int(renewed == 0), int(cancelled > 0))


def test_both_sides_build_one_matrix(spark):
    r = FE.parity(_raw(spark)).first()
    assert (r["n_rows"], r["train_only"], r["serve_only"]) == (len(ROWS), 0, 0)
    _, enc = FE.training_frame(_raw(spark))
    m = FE.feature_matrix(_raw(spark), enc, keep=("customer_id", "is_churn"))
    assert m.columns == ["customer_id", "is_churn", *FE.FEATURE_COLUMNS]
    assert {f.dataType.typeName() for f in m.schema.fields[2:]} == {"float"}


def test_codes_follow_text_order_and_unseen_values_are_the_first(spark):
    _, enc = FE.training_frame(_raw(spark))
    assert enc.maps["city"] == {"22": 0, "5": 1, "unknown": 2} and enc.maps["gender"] == {"female": 0, "unknown": 1}
    strange = [("n", *ROWS[0][1:12], 6, "x", 3, 999, *ROWS[0][16:])]
    m = FE.apply_encoders(FE.engineer(_raw(spark, strange)), enc).first()
    assert (m["city"], m["gender"], m["registered_via"], m["payment_method_id"]) == (0, 0, 0, 0)


def test_vocabulary_ranks_many_values(spark):
    values = spark.range(5000).select((F.col("id") * 7 % 5000).cast("string").alias("city"))
    got = [(r["value"], r["code"]) for r in FE.vocabulary(values, ["city"]).orderBy("code").collect()]
    assert got == [(v, i) for i, v in enumerate(sorted(map(str, range(5000))))]


def test_encoders_join_path_equals_map_path(spark):
    _, enc = FE.training_frame(_raw(spark))
    by_map = FE.apply_encoders(FE.engineer(_raw(spark)), enc).orderBy("customer_id").collect()
    joined = FE.encoders_from_table(enc.table, inline_max=0)
    assert joined.maps == {}
    by_join = FE.apply_encoders(FE.engineer(_raw(spark)), joined).orderBy("customer_id").collect()
    assert by_map == by_join


def test_score_derivation_from_probabilities(spark):
    df = spark.createDataFrame(
        [("a", 0.05), ("b", 0.85), ("c", 0.0), ("d", 0.3), ("e", 0.4), ("f", 0.49996), ("g", 0.7), ("h", 1.0),
         ("i", None)],
        "customer_id string, p double",
    )
    out = {r["customer_id"]: r for r in scoring.derive_outputs(df, "p").collect()}
    assert (out["a"]["churn_label"], out["a"]["risk_tier"], out["a"]["churn_decile"]) == (False, "low", 1)
    assert (out["b"]["churn_label"], out["b"]["risk_tier"], out["b"]["churn_decile"]) == (True, "high", 9)
    assert out["c"]["churn_decile"] == 1 and out["h"]["churn_decile"] == 10
    assert out["e"]["risk_tier"] == "medium" and out["g"]["risk_tier"] == "high"
    # stored p is rounded, label uses the unrounded p: 0.49996 stores as 0.5 with label false
    assert out["f"]["churn_probability"] == 0.5 and out["f"]["churn_label"] is False
    assert out["i"]["churn_decile"] is None and out["i"]["churn_probability"] is None


def test_rounding_matches_numpy_half_even(spark):
    import numpy as np

    vals = [0.00005, 0.00015, 0.12345, 2.675, 1.00005, 0.5, 0.33335]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    from scorewright.functions.exprs import round_half_even

    got = [r[0] for r in df.select(round_half_even("x", 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in vals]


def test_pandas_hook_equals_expression_scorecard(spark):
    train, enc = FE.training_frame(_raw(spark))
    m = FE.feature_matrix(_raw(spark), enc)
    a = scoring.score_scorecard(m).orderBy("customer_id").collect()
    b = scoring.score_pandas_model(m, scoring.PandasScorecard()).orderBy("customer_id").collect()
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x["customer_id"] == y["customer_id"] and x["risk_tier"] == y["risk_tier"]
        assert math.isclose(x["churn_probability"], y["churn_probability"], abs_tol=1e-4)


def test_pandas_hook_with_stub_model(spark):
    import numpy as np

    class Stub:
        def predict_proba(self, x):
            p = np.where(np.arange(len(x)) % 2 == 0, 0.05, 0.85)
            return np.column_stack([1 - p, p])

    train, enc = FE.training_frame(_raw(spark))
    m = FE.feature_matrix(_raw(spark), enc).coalesce(1)  # one Arrow batch, so the stub sees all rows
    out = scoring.score_pandas_model(m, Stub()).collect()
    assert sorted(r["risk_tier"] for r in out) == ["high", "high", "low", "low"]


def test_mixed_inline_and_join_lookup(spark):
    _, enc = FE.training_frame(_raw(spark))
    want = FE.apply_encoders(FE.engineer(_raw(spark)), enc).orderBy("customer_id").collect()
    some = FE.encoders_from_table(enc.table, inline_max=2)  # decided per feature
    assert 0 < len(some.maps) < len(enc.maps)
    got = FE.apply_encoders(FE.engineer(_raw(spark)), some).orderBy("customer_id").collect()
    assert got == want


def test_scoring_plan_is_one_codegen_projection(spark, tmp_path):
    path = str(tmp_path / "customers")
    _raw(spark).write.parquet(path)
    c = spark.read.parquet(path)
    _, enc = FE.training_frame(c)
    plan = scoring.score_scorecard(FE.feature_matrix(c, enc))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan
