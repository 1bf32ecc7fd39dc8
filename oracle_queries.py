"""DuckDB oracle SQL for every registered query, written independently of the Spark code.

Each query is a chain of CTEs over the driver's pre-registered views. Fragments are composed per query so every
oracle string is plain SQL that DuckDB runs as is. Doubles are rounded half-to-even (``round_even``) where the Spark
side rounds with ``rint``, so order-dependent float noise never reaches the comparison.
"""

from __future__ import annotations

REF = "DATE '2000-08-01'"

# name -> SQL body; order matters (later CTEs may use earlier ones).
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


cte(
    "members",
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(c_nationkey AS INTEGER) AS city,
           CAST(floor(c_acctbal / 80) AS INTEGER) AS bd, c_mktsegment AS gender,
           CAST(c_custkey % 5 AS INTEGER) AS registered_via,
           CASE WHEN c_custkey % 97 = 0 THEN 20000230
                ELSE CAST(strftime(DATE '1990-01-01' + CAST((c_custkey * 37) % 3650 AS INTEGER), '%Y%m%d') AS INTEGER)
           END AS registration_init_time
    FROM customer WHERE c_custkey % 10 <> 9""",
)
cte(
    "lines",
    """
    SELECT l_orderkey,
           sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS list_price,
           sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS paid,
           sum(CAST(l_quantity AS INTEGER)) AS qty
    FROM lineitem GROUP BY l_orderkey""",
)
cte(
    "transactions",
    """
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderkey AS transaction_id,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
           CAST(coalesce(list_price, 0) AS DECIMAL(18,2)) AS plan_list_price,
           CAST(coalesce(qty, 0) AS INTEGER) AS payment_plan_days,
           CAST(coalesce(round(paid, 2), 0) AS DECIMAL(18,2)) AS actual_amount_paid,
           CAST(o_orderstatus = 'P' AS INTEGER) AS is_auto_renew,
           CAST(o_orderstatus = 'F' AS INTEGER) AS is_cancel,
           CAST(o_orderdate AS DATE) AS transaction_date,
           CAST(o_orderdate AS DATE) + CAST(coalesce(qty, 0) AS INTEGER) AS membership_expire_date
    FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey""",
)
cte(
    "labels",
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
           CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                             AND CAST(o.o_orderdate AS DATE) > {REF}) THEN 0 ELSE 1 END AS is_churn
    FROM customer c""",
)
cte("tx_f", f"SELECT * FROM transactions WHERE transaction_date <= {REF}")
cte(
    "tx_last",
    """
    SELECT customer_id, payment_method_id, is_auto_renew AS last_is_auto_renew, is_cancel AS last_is_cancel
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                                       ORDER BY transaction_date DESC, transaction_id DESC) AS rn FROM tx_f)
    WHERE rn = 1""",
)
cte(
    "tx_agg",
    f"""
    SELECT a.customer_id, n_transactions, total_paid, avg_plan_price, avg_plan_days, n_auto_renew, n_cancels,
           l.payment_method_id, l.last_is_auto_renew, l.last_is_cancel, total_discount,
           CAST(date_diff('day', first_txn, last_expire) AS INTEGER) AS membership_tenure_days,
           CAST(date_diff('day', {REF}, last_expire) AS INTEGER) AS days_to_expire
    FROM (SELECT customer_id, CAST(count(*) AS INTEGER) AS n_transactions,
                 CAST(sum(actual_amount_paid) AS DOUBLE) AS total_paid,
                 CAST(sum(plan_list_price) AS DOUBLE) / count(*) AS avg_plan_price,
                 CAST(sum(payment_plan_days) AS DOUBLE) / count(*) AS avg_plan_days,
                 CAST(sum(is_auto_renew) AS INTEGER) AS n_auto_renew,
                 CAST(sum(is_cancel) AS INTEGER) AS n_cancels,
                 CAST(sum(plan_list_price - actual_amount_paid) AS DOUBLE) AS total_discount,
                 min(transaction_date) AS first_txn, max(membership_expire_date) AS last_expire
          FROM tx_f GROUP BY customer_id) a
    JOIN tx_last l ON a.customer_id = l.customer_id""",
)
cte(
    "customers",
    f"""
    SELECT lb.customer_id, m.bd,
           CAST(date_diff('day', try_strptime(CAST(m.registration_init_time AS VARCHAR), '%Y%m%d')::DATE, {REF})
                AS INTEGER) AS registration_days,
           coalesce(t.n_transactions, 0) AS n_transactions, coalesce(t.total_paid, 0) AS total_paid,
           coalesce(t.avg_plan_price, 0) AS avg_plan_price, coalesce(t.avg_plan_days, 0) AS avg_plan_days,
           coalesce(t.total_discount, 0) AS total_discount, coalesce(t.n_auto_renew, 0) AS n_auto_renew,
           coalesce(t.n_cancels, 0) AS n_cancels, coalesce(t.membership_tenure_days, 0) AS membership_tenure_days,
           coalesce(t.days_to_expire, 0) AS days_to_expire,
           m.city, m.gender, m.registered_via,
           coalesce(t.payment_method_id, 0) AS payment_method_id,
           coalesce(t.last_is_auto_renew, 0) AS last_is_auto_renew,
           coalesce(t.last_is_cancel, 0) AS last_is_cancel,
           lb.is_churn
    FROM labels lb LEFT JOIN members m ON lb.customer_id = m.customer_id
                   LEFT JOIN tx_agg t ON lb.customer_id = t.customer_id""",
)


def r4(x: str) -> str:
    return f"round_even({x} * 10000, 0) / 10000"


def rn(x: str, d: int) -> str:
    return f"round_even({x} * {10**d}, 0) / {10**d}"


def cat(x: str) -> str:
    return f"CASE WHEN CAST({x} AS VARCHAR) IN ('nan', 'None') THEN 'unknown' ELSE coalesce(CAST({x} AS VARCHAR), 'unknown') END"


def flt(v: float) -> str:
    """A float literal DuckDB reads as DOUBLE with exactly Python's value."""
    return f"{float(v)!r}e0" if "e" not in repr(float(v)) else repr(float(v))


def ts(v) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


# ---------------------------------------------------------------- features

cte(
    "eng",
    f"""
    SELECT customer_id, CASE WHEN bd BETWEEN 0 AND 100 THEN bd END AS bd, registration_days, n_transactions,
           total_paid, avg_plan_price, avg_plan_days, total_discount, n_auto_renew, n_cancels,
           membership_tenure_days, days_to_expire, city, gender, registered_via, payment_method_id,
           last_is_auto_renew, last_is_cancel, is_churn,
           {r4('total_discount / (abs(total_paid) + 1)')} AS discount_rate,
           {r4('total_paid / (n_transactions + 1)')} AS paid_per_txn,
           {r4('CAST(n_cancels AS DOUBLE) / (n_transactions + 1)')} AS cancel_rate,
           {r4('CAST(n_auto_renew AS DOUBLE) / (n_transactions + 1)')} AS autorenew_rate,
           CAST(coalesce(days_to_expire < 0, false) AS INTEGER) AS is_expired,
           CAST(coalesce(n_auto_renew = 0, false) AS INTEGER) AS never_autorenew,
           CAST(coalesce(n_cancels > 0, false) AS INTEGER) AS has_cancelled
    FROM customers""",
)
CATS = ["city", "gender", "registered_via", "payment_method_id", "last_is_auto_renew", "last_is_cancel"]
cte("cat_long", "\n    UNION ALL ".join(f"SELECT '{c}' AS feature, {cat(c)} AS value FROM eng" for c in CATS))
cte(
    "vocab",
    """
    SELECT feature, value, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT feature, value FROM cat_long)""",
)
cte(
    "encoded",
    "SELECT e.*, "
    + ", ".join(f"coalesce(v_{c}.code, 0) AS {c}_code" for c in CATS)
    + " FROM eng e "
    + " ".join(f"LEFT JOIN vocab v_{c} ON v_{c}.feature = '{c}' AND v_{c}.value = {cat('e.' + c)}" for c in CATS),
)
NUMERIC = ["bd", "registration_days", "n_transactions", "total_paid", "avg_plan_price", "avg_plan_days",
           "total_discount", "n_auto_renew", "n_cancels", "membership_tenure_days", "days_to_expire"]
ENGINEERED = ["discount_rate", "paid_per_txn", "cancel_rate", "autorenew_rate", "is_expired", "never_autorenew",
              "has_cancelled"]
FEATURES = NUMERIC + CATS + ENGINEERED
cte(
    "matrix",
    "SELECT customer_id, "
    + ", ".join(
        f"CAST({c + '_code' if c in CATS else c} AS FLOAT) AS {c}" for c in FEATURES
    )
    + " FROM encoded",
)


# ---------------------------------------------------------------- scoring and runs


def logit(card) -> str:
    z = flt(card.intercept)
    for f, w in card.weights.items():
        z = f"({z} + {flt(w)} * coalesce(CAST({f} AS DOUBLE), 0.0e0))"
    return z


def prob(card) -> str:
    return f"(1.0e0 / (1.0e0 + exp(-({logit(card)}))))"


def outputs(p: str) -> str:
    return (
        f"{r4(p)} AS churn_probability, {p} >= 0.5 AS churn_label, "
        f"CASE WHEN {p} IS NOT NULL THEN CAST(least(greatest(ceil({p} * 10), 1), 10) AS INTEGER) END AS churn_decile, "
        f"CASE WHEN {p} >= 0.7 THEN 'high' WHEN {p} >= 0.4 THEN 'medium' ELSE 'low' END AS risk_tier"
    )


def _runs():
    from scorewright.plans.runs import RUNS

    return RUNS


def _card():
    from scorewright.operators.scoring import DEFAULT_SCORECARD

    return DEFAULT_SCORECARD


cte("scored_p", f"SELECT customer_id, {prob(_card())} AS p FROM matrix")
cte("scored", f"SELECT customer_id, {outputs('p')} FROM scored_p")
cte(
    "scored_runs",
    "\n    UNION ALL ".join(
        f"SELECT customer_id, '{r.run_id}' AS run_id, '{r.model_version}' AS model_version, {outputs('p')}, "
        f"{ts(r.scored_at)} AS scored_at FROM (SELECT customer_id, {prob(r.card)} AS p FROM matrix)"
        for r in _runs()
    ),
)
cte(
    "specs",
    "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{r.run_id}', '{r.model_version}', {ts(r.started_at)}, {ts(r.scored_at)}, {ts(r.completed_at)}, "
        f"{flt(r.spark_duration_secs)}, {flt(r.total_duration_secs)})"
        for r in _runs()
    )
    + ") t(run_id, model_version, started_at, scored_at, completed_at, spark_duration_secs, total_duration_secs)",
)
cte(
    "gate_agg",
    """
    SELECT run_id, count(*) AS n_scored, count(churn_probability) AS n_nonnull, min(churn_probability) AS score_min,
           max(churn_probability) AS score_max, stddev_samp(churn_probability) AS std_samp,
           avg(CAST(churn_label AS DOUBLE)) AS churn_rate, (SELECT count(*) FROM customers) AS n_read
    FROM scored_runs GROUP BY run_id""",
)
cte(
    "gate_msgs",
    """
    SELECT *,
      CASE WHEN n_scored < 0.9e0 * n_read THEN printf('dropped: %d of %d rows scored', n_scored, n_read) END AS e1,
      CASE WHEN CAST(n_scored - n_nonnull AS DOUBLE) / n_scored > 0.001e0 THEN 'null score rate above limit' END AS e2,
      CASE WHEN score_min < 0.0 OR score_max > 1.0 THEN 'scores out of range' END AS e3,
      CASE WHEN coalesce(std_samp < 0.01e0, true) THEN 'degenerate distribution' END AS e4,
      CASE WHEN NOT (churn_rate BETWEEN 0.05e0 AND 0.6e0) THEN 'predicted churn rate outside expected range' END AS w1
    FROM gate_agg""",
)
cte(
    "gates",
    f"""
    SELECT run_id, n_read, n_scored, n_read - n_scored AS n_failed,
           {rn('CAST(n_scored - n_nonnull AS DOUBLE) / n_scored', 6)} AS null_rate, score_min, score_max,
           {r4('std_samp')} AS score_std_samp, {r4('churn_rate')} AS churn_rate,
           (e1 IS NULL AND e2 IS NULL AND e3 IS NULL AND e4 IS NULL) AS validation_passed,
           nullif(concat_ws('; ', e1, e2, e3, e4, w1), '') AS validation_notes,
           CASE WHEN e1 IS NULL AND e2 IS NULL AND e3 IS NULL AND e4 IS NULL THEN 'completed' ELSE 'failed' END AS status
    FROM gate_msgs""",
)
cte(
    "stats",
    f"""
    SELECT run_id, {r4('CAST(sum(CAST(churn_probability AS DECIMAL(12,4))) AS DOUBLE) / count(churn_probability)')} AS score_mean,
           {r4('stddev_pop(churn_probability)')} AS score_std,
           {r4('quantile_cont(churn_probability, 0.1)')} AS score_p10,
           {r4('quantile_cont(churn_probability, 0.25)')} AS score_p25,
           {r4('quantile_cont(churn_probability, 0.5)')} AS score_p50,
           {r4('quantile_cont(churn_probability, 0.75)')} AS score_p75,
           {r4('quantile_cont(churn_probability, 0.9)')} AS score_p90
    FROM scored_runs GROUP BY run_id""",
)
cte(
    "predictions",
    "SELECT * FROM scored_runs WHERE run_id IN (SELECT run_id FROM gates WHERE validation_passed)",
)
cte(
    "psi_counts",
    """
    SELECT run_id, CASE WHEN churn_probability IS NOT NULL
                        THEN least(CAST(floor(churn_probability * 10) AS INTEGER) + 1, 10) END AS bin, count(*) AS cnt
    FROM predictions GROUP BY ALL""",
)
cte(
    "psi_dist",
    f"""
    SELECT t.run_id, b.bin, coalesce(c.cnt, 0) AS count, t.n,
           (coalesce(c.cnt, 0) + {flt(1e-6)}) / (t.n + {flt(10 * 1e-6)}) AS fraction
    FROM (SELECT run_id, CAST(sum(cnt) AS BIGINT) AS n FROM psi_counts GROUP BY run_id) t
    CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 11)) b
    LEFT JOIN psi_counts c ON c.run_id = t.run_id AND c.bin = b.bin""",
)
cte(
    "ordered",
    """
    SELECT s.run_id, lag(s.run_id) OVER (ORDER BY s.started_at, s.run_id) AS ref_run_id
    FROM specs s JOIN gates g ON s.run_id = g.run_id WHERE g.validation_passed""",
)
cte(
    "psi_bd",
    """
    SELECT o.run_id, o.ref_run_id, c.bin, CAST(round((c.bin - 1) * 0.1, 1) AS DOUBLE) AS bin_lower,
           CAST(round(c.bin * 0.1, 1) AS DOUBLE) AS bin_upper, r.fraction AS ref, c.fraction AS cur,
           (c.fraction - r.fraction) * ln(c.fraction / r.fraction) AS psi,
           CASE WHEN c.fraction > r.fraction THEN '+' ELSE '-' END AS direction
    FROM ordered o JOIN psi_dist c ON c.run_id = o.run_id JOIN psi_dist r ON r.run_id = o.ref_run_id AND r.bin = c.bin
    WHERE o.ref_run_id IS NOT NULL""",
)
cte(
    "psi",
    """
    SELECT run_id, ref_run_id, sum(psi) AS psi,
           CASE WHEN sum(psi) < 0.1 THEN 'stable' WHEN sum(psi) < 0.2 THEN 'moderate_change'
                ELSE 'significant_shift' END AS interpretation,
           sum(psi) > 0.2 AS drift_flagged
    FROM psi_bd GROUP BY run_id, ref_run_id""",
)
cte(
    "runs",
    """
    SELECT s.run_id, s.model_version, s.started_at,
           CASE WHEN g.validation_passed THEN s.completed_at END AS completed_at,
           CASE WHEN g.validation_passed THEN 'validated' ELSE 'failed' END AS status,
           g.n_read AS records_read, g.n_scored AS records_scored, g.n_failed AS records_failed,
           s.spark_duration_secs,
           CASE WHEN g.validation_passed THEN s.total_duration_secs END AS total_duration_secs,
           st.score_mean, st.score_std, st.score_p10, st.score_p25, st.score_p50, st.score_p75, st.score_p90,
           p.psi AS psi_vs_previous, coalesce(p.drift_flagged, false) AS drift_flagged,
           g.validation_passed, g.validation_notes
    FROM specs s JOIN gates g ON s.run_id = g.run_id JOIN stats st ON s.run_id = st.run_id
    LEFT JOIN psi p ON s.run_id = p.run_id""",
)
cte(
    "summary",
    """
    SELECT run_id, model_version, started_at, completed_at, status, records_scored, spark_duration_secs,
           total_duration_secs, score_mean, score_p50, psi_vs_previous, drift_flagged, validation_passed,
           round(records_scored / nullif(spark_duration_secs, 0), 0) AS records_per_second,
           CAST(epoch_us(completed_at) - epoch_us(started_at) AS DOUBLE) / 1e6 AS wall_clock_secs
    FROM runs""",
)
cte(
    "latest",
    """
    SELECT customer_id, run_id, model_version, churn_probability, churn_label, churn_decile, risk_tier, scored_at
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY scored_at DESC, run_id DESC) AS rn
          FROM predictions) WHERE rn = 1""",
)
cte(
    "hist",
    """
    SELECT run_id, bin, CAST(round((bin - 1) * 0.1, 1) AS DOUBLE) AS bin_lower, CAST(round(bin * 0.1, 1) AS DOUBLE) AS bin_upper,
           cnt AS count, CAST((cnt * 20000 + tot) // (2 * tot) AS DOUBLE) / 10000 AS fraction
    FROM (SELECT run_id, bin, cnt, sum(cnt) OVER (PARTITION BY run_id) AS tot
          FROM (SELECT run_id,
                       CAST(CASE WHEN churn_probability IS NULL THEN NULL WHEN churn_probability < 0 THEN 0
                                 WHEN churn_probability >= 1 THEN 11
                                 ELSE floor(churn_probability * 10) + 1 END AS INTEGER) AS bin,
                       count(*) AS cnt
                FROM predictions GROUP BY ALL))""",
)


cte(
    "req_lines",
    """
    SELECT o_orderdate AS line_date, o_orderkey AS line_key,
           CASE WHEN o_orderstatus = 'O' THEN '   '
                WHEN o_orderpriority = '5-LOW' THEN ' ' || CAST(o_orderkey AS VARCHAR)
                ELSE '  ' || CAST(o_custkey AS VARCHAR) || ' ' END AS line
    FROM orders""",
)
cte(
    "req_parsed",
    """
    SELECT line_date, line_key, trim(line) AS customer_id FROM req_lines WHERE trim(line) <> ''""",
)
cte(
    "req_ids",
    """
    SELECT customer_id, line_date, line_key
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY line_date, line_key) AS rn FROM req_parsed)
    WHERE rn = 1""",
)


cte(
    "split_sizes",  # 70 / 15 / 15: what is held out is rounded up, then the half of it that is the test part
    """
    SELECT is_churn, n_class, n, n - (n * 3 + 9) // 10 AS n_train, ((n * 3 + 9) // 10) // 2 AS n_val
    FROM (SELECT is_churn, count(*) AS n_class, CAST(sum(count(*)) OVER () AS BIGINT) AS n FROM customers GROUP BY is_churn)""",
)
cte(
    "split_train",
    """
    SELECT *, n_class * n_train // n + CAST(row_number() OVER (ORDER BY (n_class * n_train) % n DESC, is_churn)
              <= n_train - sum(n_class * n_train // n) OVER () AS BIGINT) AS c_train
    FROM split_sizes""",
)
cte(
    "split_cuts",
    """
    SELECT is_churn, c_train, (n_class - c_train) * n_val // (n - n_train)
           + CAST(row_number() OVER (ORDER BY ((n_class - c_train) * n_val) % (n - n_train) DESC, is_churn)
                  <= n_val - sum((n_class - c_train) * n_val // (n - n_train)) OVER () AS BIGINT) AS c_val
    FROM split_train""",
)
cte(
    "split",
    f"""
    SELECT m.*, r.is_churn, CASE WHEN place <= c_train THEN 'train' WHEN place <= c_train + c_val THEN 'val' ELSE 'test' END AS split
    FROM (SELECT customer_id, is_churn, row_number() OVER (PARTITION BY is_churn ORDER BY
              md5(customer_id || '|' || CAST(is_churn AS VARCHAR) || '|42')) AS place FROM customers) r
    JOIN split_cuts s ON r.is_churn = s.is_churn JOIN matrix m ON m.customer_id = r.customer_id""",
)
cte("ev", f"SELECT customer_id, is_churn, split, {logit(_card())} AS z, {prob(_card())} AS p FROM split")
cte("sg", "SELECT split, z AS score, sum(is_churn) AS pos, sum(1 - is_churn) AS neg FROM ev GROUP BY ALL")


def with_ctes(select: str, upto: str) -> str:
    names = list(CTES)
    keep = names[: names.index(upto) + 1]
    body = ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in keep)
    return f"WITH {body}\n{select}"


ORACLE: dict[str, str] = {}


def oracle(name: str, upto: str, select: str) -> None:
    ORACLE[name] = with_ctes(select, upto)


def all_r(cols: list[str], doubles: set[str], d: int = 4) -> str:
    return ", ".join(f"{rn(c, d)} AS {c}" if c in doubles else c for c in cols)


CUSTOMER_COLS = ["customer_id"] + NUMERIC + CATS + ["is_churn"]
CUSTOMER_DOUBLES = {"total_paid", "avg_plan_price", "avg_plan_days", "total_discount"}
PRED_COLS = "customer_id, run_id, model_version, churn_probability, churn_label, churn_decile, risk_tier, scored_at"
SUMMARY_COLS = ["run_id", "model_version", "started_at", "completed_at", "status", "records_scored",
                "spark_duration_secs", "total_duration_secs", "score_mean", "score_p50", "psi_vs_previous",
                "drift_flagged", "validation_passed", "records_per_second", "wall_clock_secs"]
SUMMARY_DOUBLES = {"spark_duration_secs", "total_duration_secs", "score_mean", "score_p50", "psi_vs_previous",
                   "records_per_second", "wall_clock_secs"}
RUN_COLS = ["run_id", "model_version", "started_at", "completed_at", "status", "records_read", "records_scored",
            "records_failed", "spark_duration_secs", "total_duration_secs", "score_mean", "score_std", "score_p10",
            "score_p25", "score_p50", "score_p75", "score_p90", "psi_vs_previous", "drift_flagged",
            "validation_passed", "validation_notes"]
RUN_DOUBLES = {c for c in RUN_COLS if c.startswith("score_") or c.endswith("_secs") or c == "psi_vs_previous"}
RUNS_ = _runs()

# sources and ETL
oracle(
    "s1_csv_transactions",
    "transactions",
    """SELECT customer_id, payment_method_id, plan_list_price, payment_plan_days, actual_amount_paid,
       is_auto_renew, is_cancel, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS transaction_date,
       CAST(strftime(membership_expire_date, '%Y%m%d') AS INTEGER) AS membership_expire_date FROM transactions""",
)
oracle("s3_parquet_roundtrip", "customers", f"SELECT {all_r(CUSTOMER_COLS, CUSTOMER_DOUBLES)} FROM customers")
oracle("s2b_pruned_scan", "scored", "SELECT churn_probability FROM scored")
oracle("s4_predictions", "predictions", f"SELECT {PRED_COLS} FROM predictions")
oracle(
    "s4_predictions_partitioned_write", "predictions",
    f"SELECT {PRED_COLS} FROM predictions WHERE run_id = '{RUNS_[3].run_id}'",
)
ORACLE["s5_register_runs"] = """
SELECT run_id, seq, status FROM (
  SELECT 'run-' || strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS run_id, CAST(o_orderkey AS BIGINT) AS seq, o_orderstatus AS status,
         row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS rn
  FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-01') WHERE rn = 1"""
oracle("s6_run_state", "runs", f"SELECT {all_r(RUN_COLS, RUN_DOUBLES)} FROM runs")
oracle("s6_run_state_from_log", "runs", f"SELECT {all_r(RUN_COLS, RUN_DOUBLES)} FROM runs")
oracle(
    "s6_run_state_after_rerun", "runs",
    f"""SELECT {all_r(RUN_COLS, RUN_DOUBLES)} FROM (SELECT * FROM runs WHERE run_id <> '{RUNS_[1].run_id}' UNION ALL
       SELECT * REPLACE ('{RUNS_[1].run_id}' AS run_id) FROM runs WHERE run_id = '{RUNS_[2].run_id}')""",
)
ORACLE["s7_first_n_customers"] = with_ctes(
    f"SELECT {all_r(CUSTOMER_COLS, CUSTOMER_DOUBLES)} FROM customers", "customers"
).replace("FROM labels lb LEFT JOIN", "FROM (SELECT * FROM labels ORDER BY customer_id LIMIT 500) lb LEFT JOIN")
oracle(
    "s10_input_precheck", "customers",
    "SELECT count(*) AS n_rows, 1000 AS min_rows, count(*) >= 1000 AS passed FROM customers",
)
oracle(
    "p1_registration_dates", "members",
    f"""SELECT customer_id, registration_init_time,
       CAST(try_strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d') AS DATE) AS registration_date,
       CAST(date_diff('day', CAST(try_strptime(CAST(registration_init_time AS VARCHAR), '%Y%m%d') AS DATE), {REF})
            AS INTEGER) AS registration_days FROM members""",
)
oracle(
    "p2_cutoff_transactions", "tx_f",
    "SELECT customer_id, transaction_id, transaction_date, membership_expire_date FROM tx_f",
)
oracle(
    "a4_transaction_features",
    "tx_agg",
    f"""SELECT customer_id, n_transactions, {r4('total_paid')} AS total_paid, {r4('avg_plan_price')} AS avg_plan_price,
       {r4('avg_plan_days')} AS avg_plan_days, n_auto_renew, n_cancels, payment_method_id, last_is_auto_renew,
       last_is_cancel, {r4('total_discount')} AS total_discount, membership_tenure_days, days_to_expire FROM tx_agg""",
)
ORACLE["a4_features_by_day"] = ORACLE["a4_transaction_features"]
ORACLE["e1_customers_from_csv"] = with_ctes(
    f"SELECT {all_r(CUSTOMER_COLS, CUSTOMER_DOUBLES)} FROM customers", "customers"
).replace("ORDER BY transaction_date DESC, transaction_id DESC", "ORDER BY transaction_date DESC, payment_method_id DESC, is_auto_renew DESC, is_cancel DESC")
oracle("e1_customers", "customers", f"SELECT {all_r(CUSTOMER_COLS, CUSTOMER_DOUBLES)} FROM customers")
oracle(
    "a8_label_base_rate", "customers",
    f"SELECT {r4('avg(CAST(is_churn AS DOUBLE))')} AS positive_rate FROM customers",
)

# features
oracle(
    "p8_p10_engineered", "eng",
    f"""SELECT customer_id, bd, {r4('discount_rate')} AS discount_rate, {r4('paid_per_txn')} AS paid_per_txn,
       {r4('cancel_rate')} AS cancel_rate, {r4('autorenew_rate')} AS autorenew_rate, is_expired, never_autorenew,
       has_cancelled FROM eng""",
)
oracle("p11_category_text", "customers", "SELECT customer_id, " + ", ".join(f"{cat(c)} AS {c}" for c in CATS) + " FROM customers")
oracle("m1_vocabulary", "vocab", "SELECT feature, value, code FROM vocab")
oracle(
    "m2_encoded_categoricals", "encoded",
    "SELECT customer_id, " + ", ".join(f"{c}_code AS {c}" for c in CATS) + " FROM encoded",
)
oracle("m3_feature_matrix", "matrix", "SELECT * FROM matrix")
def _serve_code(c: str) -> str:
    """A category's code counted anew: how many values of its feature sort before it, 0 for an unseen one."""
    value = cat("e." + c)
    return (f"CASE WHEN {value} IN (SELECT value FROM cat_long WHERE feature = '{c}') THEN "
            f"(SELECT count(DISTINCT value) FROM cat_long WHERE feature = '{c}' AND value < {value}) ELSE 0 END")


cte(
    "served",
    "SELECT customer_id, " + ", ".join(f"CAST({_serve_code(c) if c in CATS else 'e.' + c} AS FLOAT) AS {c}" for c in FEATURES) + " FROM eng e",
)
oracle(
    "m11_train_serve_parity", "served",
    """SELECT (SELECT count(*) FROM matrix) AS n_rows,
       (SELECT count(*) FROM (SELECT * FROM matrix EXCEPT ALL SELECT * FROM served)) AS train_only,
       (SELECT count(*) FROM (SELECT * FROM served EXCEPT ALL SELECT * FROM matrix)) AS serve_only""",
)

oracle(
    "m11_parity_by_hash", "served",
    """SELECT (SELECT count(*) FROM matrix) AS n_rows,
       NOT EXISTS (SELECT * FROM matrix EXCEPT ALL SELECT * FROM served)
       AND NOT EXISTS (SELECT * FROM served EXCEPT ALL SELECT * FROM matrix) AS equal""",
)

# scoring and gates
oracle("m10_scored", "scored", "SELECT * FROM scored")
oracle("m12_pandas_hook_scores", "scored", "SELECT * FROM scored")
oracle(
    "p16_lineage", "scored",
    f"SELECT *, '{RUNS_[0].run_id}' AS run_id, '{RUNS_[0].model_version}' AS model_version, "
    f"{ts(RUNS_[0].scored_at)} AS scored_at FROM scored",
)
for _name, _gone in (("w1_latest_after_rerun", "AND risk_tier = 'high'"), ("w1_latest_after_withdrawal", "")):
    oracle(
        _name, "predictions",
        f"""SELECT {PRED_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY scored_at DESC, run_id DESC) AS rn
            FROM predictions WHERE NOT (run_id = '{RUNS_[4].run_id}' {_gone})) WHERE rn = 1""",
    )
oracle(
    "x1_sampled_reference", "predictions",
    f"""SELECT {PRED_COLS} FROM predictions WHERE run_id = '{RUNS_[0].run_id}'
        AND CAST('0x' || left(md5(customer_id || '|42'), 8) AS BIGINT) < CAST(floor(0.2 * 4294967296) AS BIGINT)
        ORDER BY md5(customer_id || '|42'), customer_id LIMIT 200000""",
)
oracle(
    "p20_constraint_rejects", "scored_runs",
    """SELECT run_id, count(*) AS n_rows,
       count(*) FILTER (WHERE right(customer_id, 1) IN ('1', '2', '3', '4')) AS n_rejected
       FROM scored_runs GROUP BY run_id""",
)
oracle("a6_row_counts", "gates", "SELECT run_id, n_read, n_scored, n_failed FROM gates")
oracle("a5_score_stats", "stats", "SELECT * FROM stats")
oracle(
    "a8_predicted_rate", "predictions",
    f"SELECT run_id, {r4('avg(CAST(churn_label AS DOUBLE))')} AS positive_rate FROM predictions GROUP BY run_id",
)
oracle("v1_v6_gates", "gates", "SELECT * FROM gates")

# store
oracle("w14_run_summary", "summary", f"SELECT {all_r(SUMMARY_COLS, SUMMARY_DOUBLES)} FROM summary")
oracle("w1_latest_scores", "latest", "SELECT * FROM latest")
oracle(
    "m11_latest_differences", "latest",
    f"""SELECT {PRED_COLS}, CAST(sum(a) AS BIGINT) AS n_a, CAST(sum(b) AS BIGINT) AS n_b
       FROM (SELECT {PRED_COLS}, 1 AS a, 0 AS b FROM latest UNION ALL
             SELECT {PRED_COLS}, 0, 1 FROM (
                 SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY scored_at DESC, run_id DESC) AS place FROM predictions
                 WHERE run_id <> (SELECT max_by(run_id, scored_at) FROM predictions)) WHERE place = 1)
       GROUP BY {PRED_COLS} HAVING sum(a) <> sum(b)""",
)
oracle("w1_latest_keyed", "latest", "SELECT * FROM latest")
oracle("w8_keyed_lookup", "latest", "SELECT * FROM latest WHERE customer_id = '42'")
oracle("w8_score_by_customer", "latest", "SELECT * FROM latest WHERE customer_id = '42'")
oracle("w15_high_risk", "predictions", f"SELECT {PRED_COLS} FROM predictions WHERE risk_tier = 'high'")
oracle("p21_parse_request_ids", "req_parsed", "SELECT line_date, line_key, customer_id FROM req_parsed")
oracle("w11_dedupe_request_ids", "req_ids", "SELECT * FROM req_ids")
oracle("j3_bulk_found", "req_ids", "SELECT l.*, r.line_date, r.line_key FROM latest l JOIN req_ids r ON l.customer_id = r.customer_id")
oracle(
    "j4_bulk_not_found", "req_ids",
    "SELECT r.* FROM req_ids r WHERE r.customer_id NOT IN (SELECT customer_id FROM latest)",
)
oracle(
    "j8_bulk_summary", "req_ids",
    """SELECT count(*) AS total_requested, count(l.churn_probability) AS total_found
       FROM req_ids r LEFT JOIN latest l ON l.customer_id = r.customer_id""",
)
oracle(
    "w5_runs_page", "summary",
    f"SELECT {all_r(SUMMARY_COLS, SUMMARY_DOUBLES)} FROM summary ORDER BY started_at DESC, run_id LIMIT 2 OFFSET 2",
)
oracle("a16_runs_total_validated", "runs", "SELECT count(*) AS total FROM runs WHERE status = 'validated'")
oracle(
    "w6_latest_completed_run", "summary",
    f"""SELECT {all_r(SUMMARY_COLS, SUMMARY_DOUBLES)} FROM summary WHERE status IN ('completed', 'validated')
       ORDER BY started_at DESC, run_id DESC LIMIT 1""",
)
oracle(
    "w7_run_by_id", "summary",
    f"SELECT {all_r(SUMMARY_COLS, SUMMARY_DOUBLES)} FROM summary WHERE run_id = '{RUNS_[2].run_id}'",
)
oracle(
    "w13_health", "runs",
    "SELECT run_id AS latest_run_id, status AS latest_run_status FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1",
)
oracle(
    "a7_pipeline_totals", "runs",
    """SELECT (SELECT count(*) FROM runs) AS total_batch_runs,
       (SELECT count(*) FROM predictions) AS total_predictions,
       (SELECT run_id FROM runs WHERE status IN ('completed', 'validated') ORDER BY started_at DESC LIMIT 1) AS latest_run_id,
       (SELECT completed_at FROM runs WHERE status IN ('completed', 'validated') ORDER BY started_at DESC LIMIT 1)
           AS latest_run_completed_at,
       (SELECT model_version FROM runs ORDER BY started_at DESC LIMIT 1) AS latest_model_version,
       round((SELECT avg(spark_duration_secs) FROM runs WHERE status = 'validated'), 2) AS avg_spark_duration_secs,
       round((SELECT avg(records_scored / nullif(spark_duration_secs, 0)) FROM runs WHERE status = 'validated'), 0)
           AS avg_records_per_second""",
)
oracle(
    "w12_score_trend", "summary",
    "SELECT run_id, CAST(started_at AS DATE) AS date, score_mean AS mean, score_p50 AS p50, psi_vs_previous AS psi FROM summary WHERE score_mean IS NOT NULL",
)

# monitor
oracle("a9_score_histogram", "hist", "SELECT * FROM hist")
oracle(
    "w9_run_distribution", "hist",
    f"SELECT bin, bin_lower, bin_upper, count, fraction FROM hist WHERE run_id = '{RUNS_[3].run_id}'",
)
oracle(
    "a13_tier_totals", "predictions",
    """SELECT run_id, count(*) FILTER (WHERE risk_tier = 'low') AS low, count(*) FILTER (WHERE risk_tier = 'medium') AS medium,
       count(*) FILTER (WHERE risk_tier = 'high') AS high FROM predictions GROUP BY run_id""",
)
oracle(
    "p23_bin_tiers", "hist",
    """SELECT *, CASE WHEN (bin_lower + bin_upper) / 2 >= 0.7 THEN 'high'
                     WHEN (bin_lower + bin_upper) / 2 >= 0.4 THEN 'medium' ELSE 'low' END AS bin_tier FROM hist""",
)
oracle(
    "j7_two_run_histograms", "hist",
    f"SELECT * FROM hist WHERE run_id IN ('{RUNS_[0].run_id}', '{RUNS_[3].run_id}')",
)
oracle("a10_psi_distribution", "psi_dist", f"SELECT run_id, bin, count, n, {rn('fraction', 8)} AS fraction FROM psi_dist")
oracle(
    "a12_psi_breakdown", "psi_bd",
    f"""SELECT run_id, ref_run_id, bin, {rn('bin_lower', 6)} AS bin_lower, {rn('bin_upper', 6)} AS bin_upper,
       {rn('ref', 6)} AS ref, {rn('cur', 6)} AS cur, {rn('psi', 6)} AS psi, direction FROM psi_bd""",
)
oracle(
    "a11_psi", "psi",
    f"SELECT run_id, ref_run_id, {rn('psi', 6)} AS psi, interpretation, drift_flagged FROM psi",
)
oracle(
    "w3_previous_run", "runs",
    f"""SELECT run_id, started_at FROM runs WHERE status IN ('completed', 'validated') AND run_id <> '{RUNS_[3].run_id}'
       AND started_at < (SELECT started_at FROM runs WHERE run_id = '{RUNS_[3].run_id}')
       ORDER BY started_at DESC, run_id DESC LIMIT 1""",
)
oracle(
    "w4_psi_history", "runs",
    f"""SELECT run_id, started_at, {rn('psi_vs_previous', 6)} AS psi_vs_previous, drift_flagged,
       {rn('score_mean', 6)} AS score_mean, {rn('score_p50', 6)} AS score_p50, records_scored FROM runs
       WHERE status IN ('completed', 'validated') AND psi_vs_previous IS NOT NULL
       ORDER BY started_at DESC LIMIT 10""",
)

# model
oracle("m4_stratified_split", "split", "SELECT customer_id, is_churn, split FROM split")
oracle(
    "m5b_class_weights", "split",
    f"""SELECT is_churn, n_class, {rn('CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class)', 6)} AS weight
       FROM (SELECT is_churn, count(*) AS n_class FROM split WHERE split = 'train' GROUP BY is_churn)""",
)
oracle(
    "m6_auc_roc", "sg",
    f"""SELECT split, {r4('sum(pos * (neg_below + neg * 0.5)) / (sum(pos) * sum(neg))')} AS auc_roc
       FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
             FROM sg) GROUP BY split""",
)
oracle(
    "m7_average_precision", "sg",
    f"""SELECT split, {r4('sum((pos / n_pos) * (tp / (tp + fp)))')} AS avg_precision
       FROM (SELECT *, sum(pos) OVER (PARTITION BY split ORDER BY score DESC
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
                       sum(neg) OVER (PARTITION BY split ORDER BY score DESC
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
                       sum(pos) OVER (PARTITION BY split) AS n_pos FROM sg) GROUP BY split""",
)
oracle(
    "m8_split_metrics", "ev",
    f"""SELECT split, n_samples, {r4('CAST(tp + tn AS DOUBLE) / n_samples')} AS accuracy,
       {r4('coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)')} AS f1,
       {r4('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)')} AS precision,
       {r4('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)')} AS recall,
       {r4('CAST(tp + fn AS DOUBLE) / n_samples')} AS churn_rate_actual,
       {r4('CAST(tp + fp AS DOUBLE) / n_samples')} AS churn_rate_predicted
       FROM (SELECT split, count(*) AS n_samples,
                    sum(is_churn * CAST(p >= 0.5 AS INTEGER)) AS tp,
                    sum((1 - is_churn) * CAST(p >= 0.5 AS INTEGER)) AS fp,
                    sum(is_churn * (1 - CAST(p >= 0.5 AS INTEGER))) AS fn,
                    sum((1 - is_churn) * (1 - CAST(p >= 0.5 AS INTEGER))) AS tn FROM ev GROUP BY split)""",
)
