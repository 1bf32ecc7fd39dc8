"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per inventory operator.

Every query reads the driver's tables (through the adapter) over their whole extent; the run history, request
lists and written tables are derived from them by Spark. Double outputs that come from sums of doubles are rounded
half-to-even so both engines agree regardless of addition order.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import CATEGORICAL_FEATURES, ID_COL, TARGET_COL, JobConfig
from scorewright.functions.exprs import category_text, round_half_even
from scorewright.operators import daily, etl, features as FE, keyed, model as M, monitor, multiset, quality, scoring, store
from scorewright.operators.runlog import RunLog
from scorewright.plans import history as H, runs as RN
from scorewright.session import checkpoint_dir, cut_lineage
from scorewright.sources import adapter, sinks, tables

CFG = JobConfig()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LOOKUP_CUSTOMER = "42"  # W8 parameter
PAGE, PAGE_SIZE = 2, 2  # W5 parameters
HIST_RUN_A, HIST_RUN_B = RN.RUNS[0].run_id, RN.RUNS[3].run_id
NEWEST_RUN = RN.RUNS[4].run_id


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column half-to-even (comparison-stable output)."""
    return df.select(
        *[
            round_half_even(c.name, digits).alias(c.name) if isinstance(c.dataType, T.DoubleType) else F.col(c.name)
            for c in df.schema.fields
        ]
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint dir (shared storage on a cluster)."""
    return os.path.join(checkpoint_dir(spark), "warehouse", f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- shared plans


def raw_tables(spark: SparkSession, sf_dir: str, cfg: JobConfig = CFG):
    lab = adapter.labels(spark, sf_dir, cfg.reference_date)
    mem = adapter.members(spark, sf_dir)
    tx = adapter.transactions(spark, sf_dir, cutoff=cfg.reference_date)
    return lab, mem, tx


def customers(spark: SparkSession, sf_dir: str, cfg: JobConfig = CFG) -> DataFrame:
    lab, mem, tx = raw_tables(spark, sf_dir, cfg)
    return etl.build_customers(lab, mem, tx, cfg.reference_date)


# Derived tables written once per (session, sf dir) and read by every later query, like the stored tables the
# nightly job leaves behind. Keyed by the live session, so a new session rebuilds them.
_DERIVED: dict = {}


def _memo(spark: SparkSession, sf_dir: str, what: str, build):
    key = (id(spark), spark.sparkContext.applicationId, os.path.abspath(sf_dir), what)
    hit = _DERIVED.get(key)
    if hit is not None:
        return hit
    value = build()
    _DERIVED[key] = value
    return value


def matrix_and_encoders(spark, sf_dir):
    """Customers (written once, so fitting the vocabulary and scoring do not both re-run the ETL), fitted encoders
    and the feature matrix."""

    def build():
        c = cut_lineage(customers(spark, sf_dir), "customers")
        _, enc = FE.training_frame(c)
        return c, enc, FE.feature_matrix(c, enc)

    return _memo(spark, sf_dir, "matrix", build)


def history(spark, sf_dir) -> H.History:
    return _memo(
        spark, sf_dir, "history",
        lambda: H.build(matrix_and_encoders(spark, sf_dir)[0], customers_materialized=True),
    )


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pasted id list derived from orders: one line per order, in order (date, order key). Open orders give blank
    lines, low-priority orders paste the order key by mistake (mostly not a customer), the rest paste the customer
    key, all with stray spaces."""
    o = tables.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                                    "o_orderpriority"])
    text = (
        F.when(F.col("o_orderstatus") == "O", F.lit("   "))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit(" "), F.col("o_orderkey").cast("string")))
        .otherwise(F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit(" ")))
    )
    return o.select(F.col("o_orderdate").alias("line_date"), F.col("o_orderkey").alias("line_key"), text.alias("line"))


def request_ids(spark, sf_dir) -> DataFrame:
    parsed = store.parse_id_lines(request_lines(spark, sf_dir), "line", ["line_date", "line_key"])
    return store.dedupe_ids(parsed, ["line_date", "line_key"])


# ---------------------------------------------------------------- S: sources and sinks


@query("s1_csv_transactions")
def q_s1(spark, sf_dir):
    """Transactions exported in the raw CSV layout and read back with the declared schema and a checked header."""
    path = scratch(spark, "transactions_csv")
    sinks.write_raw_csv(adapter.transactions(spark, sf_dir), path, "transactions")
    return tables.read_csv(spark, path, "transactions")


@query("e1_customers_from_csv")
def q_e1_csv(spark, sf_dir):
    """E1 from the three raw CSV files: header checked, id renamed, no transaction id to break ties with."""
    folder = scratch(spark, "raw_csv")
    for name, df in zip(tables.CSV_SCHEMAS, (adapter.labels(spark, sf_dir, CFG.reference_date),
                                             adapter.members(spark, sf_dir), adapter.transactions(spark, sf_dir))):
        sinks.write_raw_csv(df, os.path.join(folder, name), name)
    return rounded(etl.build_customers(*tables.raw_files(spark, folder), CFG.reference_date))


@query("s3_parquet_roundtrip")
def q_s3(spark, sf_dir):
    """S3 then S2: the customer table written as snappy Parquet (no coalesce) and scanned back."""
    path = scratch(spark, "customers")
    sinks.write_parquet(customers(spark, sf_dir), path)
    return rounded(spark.read.parquet(path))


@query("s2b_pruned_scan")
def q_s2b(spark, sf_dir):
    """Scored output written, then only the probability column read back (ReadSchema has one column)."""
    _, _, m = matrix_and_encoders(spark, sf_dir)
    path = scratch(spark, "scored")
    sinks.write_parquet(scoring.score_scorecard(m), path)
    return spark.read.parquet(path).select("churn_probability")


@query("s4_predictions")
def q_s4(spark, sf_dir):
    return history(spark, sf_dir).predictions


@query("s4_predictions_partitioned_write")
def q_s4w(spark, sf_dir):
    """S4 as stored: appended under run_id partitions, read back with a run filter (partition pruning)."""
    path = scratch(spark, "predictions")
    store.write_predictions(history(spark, sf_dir).predictions, path)
    return spark.read.parquet(path).filter(F.col("run_id") == HIST_RUN_B).select(*store.PREDICTION_COLUMNS)


REGISTERED_BEFORE = "1995-01-01"  # S5 parameter


@query("s5_register_runs")
def q_s5(spark, sf_dir):
    """Every order registers the run of its day. Days before REGISTERED_BEFORE are registered already; of a day's
    other registrations that of the lowest order key counts."""
    o = tables.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus"])
    day = F.col("o_orderdate").cast("date")
    regs = o.select(F.concat(F.lit("run-"), F.date_format(day, "yyyyMMdd")).alias("run_id"),
                    F.col("o_orderkey").cast("long").alias("seq"), F.col("o_orderstatus").alias("status"), day.alias("day"))
    existing = regs.filter(F.col("day") < F.lit(REGISTERED_BEFORE).cast("date")).select("run_id").distinct()
    return store.register_runs(existing, regs.select("run_id", "seq", "status"))


@query("s6_run_state")
def q_s6(spark, sf_dir):
    return rounded(history(spark, sf_dir).runs)


@query("s6_run_state_after_rerun")
def q_s6_rerun(spark, sf_dir):
    """S6 when a good run is done again with the flat card of another: the second attempt replaces the first."""
    ev = history(spark, sf_dir).events
    again = ev.filter((F.col("run_id") == RN.RUNS[2].run_id)).withColumn("run_id", F.lit(RN.RUNS[1].run_id))
    return rounded(store.fold_runs(ev.unionByName(again.withColumn("attempt", F.lit(2).cast("long")))))


@query("s6_run_state_from_log")
def q_s6_log(spark, sf_dir):
    """S6 from the stored log: a commit a step of the runs, a snapshot after four folders, folded from it and the tail."""
    ev = history(spark, sf_dir).events
    log = RunLog(spark, scratch(spark, "run_log"), compact_after=4)
    for step in ev.select("seq").distinct().orderBy("seq").collect():
        log.append(ev.filter(F.col("seq") == step["seq"]))
    return rounded(log.runs())


@query("s7_first_n_customers")
def q_s7(spark, sf_dir):
    lab, mem, tx = raw_tables(spark, sf_dir)
    return rounded(etl.build_customers(lab, mem, tx, CFG.reference_date, limit=500))


@query("s10_input_precheck")
def q_s10(spark, sf_dir):
    return etl.input_precheck(matrix_and_encoders(spark, sf_dir)[0], 1000)


# ---------------------------------------------------------------- P, A: ETL


@query("p1_registration_dates")
def q_p1(spark, sf_dir):
    m = adapter.members(spark, sf_dir)
    reg = etl.prepare_members(m, CFG.reference_date)
    from scorewright.functions.exprs import parse_yyyymmdd

    return m.select(ID_COL, "registration_init_time", parse_yyyymmdd("registration_init_time").alias("registration_date")).join(
        reg.select(ID_COL, "registration_days"), ID_COL
    )


@query("p2_cutoff_transactions")
def q_p2(spark, sf_dir):
    tx = adapter.transactions(spark, sf_dir, cutoff=CFG.reference_date)
    return tx.filter(F.col("transaction_date") <= F.lit(CFG.reference_date)).select(
        ID_COL, "transaction_id", "transaction_date", "membership_expire_date"
    )


@query("a4_transaction_features")
def q_a4(spark, sf_dir):
    tx = adapter.transactions(spark, sf_dir, cutoff=CFG.reference_date)
    return rounded(etl.aggregate_transactions(tx, CFG.reference_date))


@query("a4_features_by_day")
def q_a4_days(spark, sf_dir):
    """A4 as a night makes it from states kept by day: the states of all days, those rolled up to the evening before, and
    one day merged into them."""
    path, night = scratch(spark, "day_states"), CFG.reference_date
    daily.write_days(daily.day_states(adapter.transactions(spark, sf_dir)), path)
    days, before = spark.read.parquet(path), night - dt.timedelta(days=1)
    rolled = cut_lineage(daily.roll(daily.days_between(days, None, before)), "rolled")
    return rounded(daily.features(daily.roll(rolled, daily.days_between(days, before, night)), night))


@query("e1_customers")
def q_e1(spark, sf_dir):
    return rounded(customers(spark, sf_dir))


@query("a8_label_base_rate")
def q_a8(spark, sf_dir):
    return quality.positive_rate(adapter.labels(spark, sf_dir, CFG.reference_date), TARGET_COL)


# ---------------------------------------------------------------- features


@query("p8_p10_engineered")
def q_p8(spark, sf_dir):
    eng = FE.engineer(customers(spark, sf_dir))
    return rounded(
        eng.select(ID_COL, "bd", "discount_rate", "paid_per_txn", "cancel_rate", "autorenew_rate", "is_expired",
                   "never_autorenew", "has_cancelled")
    )


@query("p11_category_text")
def q_p11(spark, sf_dir):
    c = customers(spark, sf_dir)
    return c.select(ID_COL, *[category_text(x).alias(x) for x in CATEGORICAL_FEATURES])


@query("m1_vocabulary")
def q_m1(spark, sf_dir):
    return FE.vocabulary(FE.engineer(customers(spark, sf_dir)))


@query("m2_encoded_categoricals")
def q_m2(spark, sf_dir):
    c = customers(spark, sf_dir)
    eng = FE.engineer(c)
    enc = FE.fit_encoders(eng)
    return FE.apply_encoders(eng, enc).select(ID_COL, *CATEGORICAL_FEATURES)


@query("m3_feature_matrix")
def q_m3(spark, sf_dir):
    return matrix_and_encoders(spark, sf_dir)[2]


@query("m11_train_serve_parity")
def q_m11(spark, sf_dir):
    return FE.parity(customers(spark, sf_dir))


@query("m11_parity_by_hash")
def q_m11_hash(spark, sf_dir):
    """M11 by sums of row hashes: whether the training and the scoring matrix hold the same rows equally often."""
    train, serve = FE.parity_sides(matrix_and_encoders(spark, sf_dir)[0])
    t, s = multiset.fingerprint(train), multiset.fingerprint(serve.select(*train.columns))
    same = (F.col("t.n") == F.col("s.n")) & (F.col("t.h1") == F.col("s.h1")) & (F.col("t.h2") == F.col("s.h2"))
    one = t.withColumn("k", F.lit(1)).alias("t").join(s.withColumn("k", F.lit(1)).alias("s"), "k")  # a row a side
    return one.select(F.col("t.n").alias("n_rows"), same.alias("equal"))


@query("m11_latest_differences")
def q_m11_diff(spark, sf_dir):
    """Rows in which the latest scores differ before and after the newest run was taken back, found by ranges of row
    hashes."""
    h = history(spark, sf_dir)
    newest = store.latest_completed(h.summary).first()["run_id"]
    after = store.replace_run(h.latest, newest, h.predictions.limit(0), h.predictions)
    return multiset.differences(h.latest, after, store.PREDICTION_COLUMNS)


# ---------------------------------------------------------------- scoring


@query("m10_scored")
def q_m10(spark, sf_dir):
    return scoring.score_scorecard(matrix_and_encoders(spark, sf_dir)[2])


@query("m12_pandas_hook_scores")
def q_m12(spark, sf_dir):
    """M9 hook + M12: the numpy scorecard through mapInPandas; must equal the expression scorecard."""
    return scoring.score_pandas_model(matrix_and_encoders(spark, sf_dir)[2], scoring.PandasScorecard())


@query("p16_lineage")
def q_p16(spark, sf_dir):
    r = RN.RUNS[0]
    scored = scoring.score_scorecard(matrix_and_encoders(spark, sf_dir)[2], r.card)
    return scoring.with_lineage(scored, r.run_id, r.model_version, r.scored_at)


@query("p20_constraint_rejects")
def q_p20(spark, sf_dir):
    """P20: of each run's rows, some of which are spoilt (a probability beyond 1, no probability, a decile 0, an unknown
    tier, by the last digit of the customer), those that the stored table's constraints refuse."""
    digit = F.substring(ID_COL, -1, 1)
    spoilt = history(spark, sf_dir).scored.select(
        "run_id",
        F.when(digit == "1", F.col("churn_probability") + 1.5).when(digit != "2", F.col("churn_probability")).alias("churn_probability"),
        "churn_label",
        F.when(digit == "3", F.lit(0)).otherwise(F.col("churn_decile")).alias("churn_decile"),
        F.when(digit == "4", F.lit("none")).otherwise(F.col("risk_tier")).alias("risk_tier"),
    )
    kept, rejected = scoring.split_rejects(spoilt)
    both = kept.select("run_id", F.lit(0).alias("bad")).unionByName(rejected.select("run_id", F.lit(1).alias("bad")))
    return both.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("bad").alias("n_rejected"))


@query("a6_row_counts")
def q_a6(spark, sf_dir):
    return history(spark, sf_dir).gates.select("run_id", "n_read", "n_scored", "n_failed")


@query("a8_predicted_rate")
def q_a8p(spark, sf_dir):
    return quality.positive_rate(history(spark, sf_dir).predictions, "churn_label", ["run_id"])


@query("a5_score_stats")
def q_a5(spark, sf_dir):
    return history(spark, sf_dir).stats


@query("v1_v6_gates")
def q_v(spark, sf_dir):
    return history(spark, sf_dir).gates.drop("errors", "warnings")


# ---------------------------------------------------------------- store queries


@query("w14_run_summary")
def q_w14(spark, sf_dir):
    return rounded(history(spark, sf_dir).summary)


@query("w1_latest_scores")
def q_w1(spark, sf_dir):
    return history(spark, sf_dir).latest


@query("w1_latest_after_rerun")
def q_w1_rerun(spark, sf_dir):
    """W1 kept up to date when the newest run is done again and no longer scores its high-tier customers: these fall back to
    their newest score of another run."""
    pred = history(spark, sf_dir).predictions
    again = pred.filter((F.col("run_id") == NEWEST_RUN) & (F.col("risk_tier") != "high"))
    return store.replace_run(store.latest_scores(pred), NEWEST_RUN, again, pred)


@query("w1_latest_after_withdrawal")
def q_w1_back(spark, sf_dir):
    """W1 kept up to date when the newest run is taken back as a whole."""
    pred = history(spark, sf_dir).predictions
    return store.replace_run(store.latest_scores(pred), NEWEST_RUN, pred.limit(0), pred)


@query("w8_score_by_customer")
def q_w8(spark, sf_dir):
    return store.score_for(history(spark, sf_dir).latest, LOOKUP_CUSTOMER)


def keyed_latest(spark, sf_dir) -> DataFrame:
    """The latest scores kept by key, a version a run as the nights pass; then the newest run is done again without its
    high-tier customers, and done well again."""

    def build():
        h = history(spark, sf_dir)
        runs = [r["run_id"] for r in h.runs.filter("validation_passed").orderBy("started_at", "run_id").select("run_id").collect()]
        mine = {r: h.predictions.filter(F.col("run_id") == r) for r in runs}
        steps = [*mine.items(), (runs[-1], mine[runs[-1]].filter(F.col("risk_tier") != "high")), (runs[-1], mine[runs[-1]])]
        path = None
        for run_id, published in steps:
            old, path = path, scratch(spark, "latest_keyed")
            store.next_latest(spark, old, path, run_id, published, h.predictions)
        return path

    return keyed.read_keyed(spark, _memo(spark, sf_dir, "keyed_latest", build))


@query("w1_latest_keyed")
def q_w1_keyed(spark, sf_dir):
    """W1 as the nightly job stores it: bucketed by customer, each run merged into the version before."""
    return keyed_latest(spark, sf_dir)


@query("w8_keyed_lookup")
def q_w8_keyed(spark, sf_dir):
    """W8 from the stored table: the one file of the customer's bucket is opened."""
    return store.score_for(keyed_latest(spark, sf_dir), LOOKUP_CUSTOMER)


@query("w15_high_risk")
def q_w15(spark, sf_dir):
    return store.high_risk(history(spark, sf_dir).predictions)


@query("p21_parse_request_ids")
def q_p21(spark, sf_dir):
    return store.parse_id_lines(request_lines(spark, sf_dir), "line", ["line_date", "line_key"])


@query("w11_dedupe_request_ids")
def q_w11(spark, sf_dir):
    return request_ids(spark, sf_dir)


@query("j3_bulk_found")
def q_j3(spark, sf_dir):
    return store.bulk_found(request_ids(spark, sf_dir), history(spark, sf_dir).latest)


@query("j4_bulk_not_found")
def q_j4(spark, sf_dir):
    return store.bulk_not_found(request_ids(spark, sf_dir), history(spark, sf_dir).latest)


@query("j8_bulk_summary")
def q_j8(spark, sf_dir):
    return store.bulk_summary(request_ids(spark, sf_dir), history(spark, sf_dir).latest)


@query("w5_runs_page")
def q_w5(spark, sf_dir):
    return rounded(store.runs_page(history(spark, sf_dir).summary, PAGE, PAGE_SIZE))


@query("a16_runs_total_validated")
def q_a16(spark, sf_dir):
    return store.runs_total(history(spark, sf_dir).runs, "validated")


@query("w6_latest_completed_run")
def q_w6(spark, sf_dir):
    return rounded(store.latest_completed(history(spark, sf_dir).summary))


@query("w7_run_by_id")
def q_w7(spark, sf_dir):
    return rounded(history(spark, sf_dir).summary.filter(F.col("run_id") == RN.RUNS[2].run_id))


@query("w13_health")
def q_w13(spark, sf_dir):
    return store.health(history(spark, sf_dir).runs)


@query("a7_pipeline_totals")
def q_a7(spark, sf_dir):
    h = history(spark, sf_dir)
    return store.pipeline_totals(h.runs, h.predictions)


@query("w12_score_trend")
def q_w12(spark, sf_dir):
    return store.trend(history(spark, sf_dir).summary)


# ---------------------------------------------------------------- monitor


@query("a9_score_histogram")
def q_a9(spark, sf_dir):
    return monitor.histogram(history(spark, sf_dir).predictions, CFG.psi_n_bins)


@query("w9_run_distribution")
def q_w9(spark, sf_dir):
    return monitor.run_distribution(history(spark, sf_dir).predictions, HIST_RUN_B, CFG.psi_n_bins)


@query("a13_tier_totals")
def q_a13(spark, sf_dir):
    return monitor.tier_totals(history(spark, sf_dir).predictions)


@query("p23_bin_tiers")
def q_p23(spark, sf_dir):
    return monitor.bin_tier(monitor.histogram(history(spark, sf_dir).predictions, CFG.psi_n_bins))


@query("j7_two_run_histograms")
def q_j7(spark, sf_dir):
    hist = monitor.histogram(history(spark, sf_dir).predictions, CFG.psi_n_bins)
    return monitor.side_by_side(hist, HIST_RUN_A, HIST_RUN_B)


@query("a10_psi_distribution")
def q_a10(spark, sf_dir):
    pred = history(spark, sf_dir).predictions
    d = monitor.psi_distribution(monitor.psi_counts(pred, CFG.psi_n_bins), CFG.psi_n_bins, CFG.psi_epsilon)
    return d.select("run_id", "bin", "count", "n", round_half_even("fraction", 8).alias("fraction"))


@query("a12_psi_breakdown")
def q_a12(spark, sf_dir):
    return rounded(history(spark, sf_dir).psi_breakdown, 6)


@query("a11_psi")
def q_a11(spark, sf_dir):
    return rounded(history(spark, sf_dir).psi, 6)


@query("w3_previous_run")
def q_w3(spark, sf_dir):
    return monitor.previous_run(history(spark, sf_dir).runs, RN.RUNS[3].run_id)


@query("w4_psi_history")
def q_w4(spark, sf_dir):
    return rounded(monitor.psi_history(history(spark, sf_dir).runs, 10), 6)


@query("x1_sampled_reference")
def q_x1(spark, sf_dir):
    return monitor.sampled_reference(history(spark, sf_dir).predictions, HIST_RUN_A, 0.2, CFG.seed)


# ---------------------------------------------------------------- model


def split_frame(spark, sf_dir):
    c, enc, _ = matrix_and_encoders(spark, sf_dir)
    return M.assign_split(FE.feature_matrix(c, enc, keep=(ID_COL, TARGET_COL)), CFG)


@query("m4_stratified_split")
def q_m4(spark, sf_dir):
    return split_frame(spark, sf_dir).select(ID_COL, TARGET_COL, "split")


@query("m5b_class_weights")
def q_m5b(spark, sf_dir):
    return rounded(M.class_weights(split_frame(spark, sf_dir).filter(F.col("split") == "train")), 6)


def scorecard_eval_frame(spark, sf_dir):
    """Label, split and the scorecard's logit ``z``, which orders as the probability does and is the same number in
    every engine."""
    card = scoring.DEFAULT_SCORECARD
    return split_frame(spark, sf_dir).select(ID_COL, TARGET_COL, "split", card.logit().alias("z"), card.probability().alias("p"))


@query("m6_auc_roc")
def q_m6(spark, sf_dir):
    return M.auc_roc(scorecard_eval_frame(spark, sf_dir), "z")


@query("m7_average_precision")
def q_m7(spark, sf_dir):
    return M.average_precision(scorecard_eval_frame(spark, sf_dir), "z")


@query("m8_split_metrics")
def q_m8(spark, sf_dir):
    s = scorecard_eval_frame(spark, sf_dir).withColumn("pred", F.col("p") >= CFG.label_threshold)
    return M.split_metrics(s)


def gbt_model(spark, sf_dir):
    """The split frame and a GBT trained on its train/val rows (trained once per session and sf dir)."""

    def build():
        s = split_frame(spark, sf_dir)
        return s, M.train_gbt(s.filter(F.col("split") != "test"), CFG)

    return _memo(spark, sf_dir, "gbt", build)


def gbt_scored(frame: DataFrame, model) -> DataFrame:
    """Label, split and the model's probability."""
    from pyspark.ml.functions import vector_to_array

    return model.transform(M.assemble(frame)).select(ID_COL, TARGET_COL, "split", vector_to_array("probability")[1].alias("p"))


@query("m5_gbt_evaluation")
def q_m5(spark, sf_dir):
    """M5: GBT trained with class weights and a validation split; evaluated per split (rows-only check)."""
    s, mdl = gbt_model(spark, sf_dir)
    return M.evaluation(gbt_scored(s, mdl))


@query("m9_gbt_scores")
def q_m9(spark, sf_dir):
    s, mdl = gbt_model(spark, sf_dir)
    return scoring.score_spark_model(s.drop(TARGET_COL, "split"), mdl)


@query("w16_feature_importances")
def q_w16(spark, sf_dir):
    _, mdl = gbt_model(spark, sf_dir)
    rows = [(i + 1, f, float(v)) for i, (f, v) in enumerate(M.importances(mdl, top=15))]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


@query("s9_training_report")
def q_s9(spark, sf_dir):
    """Evaluation report written as JSON (one row per split) and read back."""
    s, mdl = gbt_model(spark, sf_dir)
    scored = gbt_scored(s, mdl)
    report = M.evaluation(scored).select(F.lit(CFG.model_version).alias("model_version"), "*")
    path = scratch(spark, "training_report")
    report.write.mode("overwrite").json(path)
    return spark.read.schema(report.schema).json(path)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers -> features -> scorecard -> scored batch."""
    return q_m10(spark, sf_dir)

