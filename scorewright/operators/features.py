"""Feature engineering and category encoding.

One definition serves training and scoring, so the two matrices cannot drift apart. Everything is a projection
except fitting the vocabulary, which is one small aggregate.

Encoders: the vocabulary is the sorted distinct text of each categorical column, coded 0..k-1 (M1). It is a fitted
model artifact like a ``StringIndexerModel``: bounded by the number of distinct categories, not by rows. Applying it
(M2) is decided per column: one with at most ``INLINE_MAX`` values is a lookup inside the projection (integer columns
look up by their integer value, so no per-row text cast), and only such a column's values come to the driver. Spark
scans a literal map linearly, so a larger vocabulary is applied by a join, planned as a broadcast or a shuffle by
measured size (AQE). Both give the same codes. Unseen values get code 0 (the first class), not a new index.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewright.config import CATEGORICAL_FEATURES, FEATURE_COLUMNS, ID_COL, TARGET_COL
from scorewright.functions.exprs import category_text, flag, round_half_even
from scorewright.operators.ranks import running_totals
from scorewright.session import cut_lineage

INLINE_MAX = 64


def engineer(df: DataFrame) -> DataFrame:
    """Dirty age to NULL, ratio features (4 decimals, half-to-even like numpy), 0/1 flags."""
    cols = {c: F.col(c) for c in df.columns}
    if "bd" in cols:
        cols["bd"] = F.when(F.col("bd").between(0, 100), F.col("bd")).alias("bd")
    n1 = F.col("n_transactions") + 1
    extra = {
        "discount_rate": round_half_even(F.col("total_discount") / (F.abs(F.col("total_paid")) + 1)),
        "paid_per_txn": round_half_even(F.col("total_paid") / n1),
        "cancel_rate": round_half_even(F.col("n_cancels") / n1),
        "autorenew_rate": round_half_even(F.col("n_auto_renew") / n1),
        "is_expired": flag(F.col("days_to_expire") < 0),
        "never_autorenew": flag(F.col("n_auto_renew") == 0),
        "has_cancelled": flag(F.col("n_cancels") > 0),
    }
    out = [cols[c].alias(c) for c in df.columns if c not in extra]
    out += [v.alias(k) for k, v in extra.items()]
    return df.select(*out)


@dataclass(frozen=True)
class Encoders:
    """Fitted vocabulary. ``table`` has (feature, value, code); ``maps`` holds the features that are looked up inline."""

    table: DataFrame
    maps: dict[str, dict[str, int]]


def vocabulary(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """M1: (feature, value, code) with code = rank of the text among the sorted distinct values, from 0.

    The distinct step is an aggregate with map-side combine; the ranks are running counts over ranges of values, so a
    feature of any number of values is ranked by many tasks.
    """
    present = [c for c in columns if c in df.columns]
    long = df.select(*[category_text(c).alias(c) for c in present]).unpivot([], present, "feature", "value")
    distinct = long.select("feature", "value").distinct().withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(distinct, ["feature"], [F.col("value")], {"one": "rank"})
    return ranked.select("feature", "value", (F.col("rank") - 1).cast("int").alias("code"))


def fit_encoders(df: DataFrame, columns: list[str] = CATEGORICAL_FEATURES) -> Encoders:
    return encoders_from_table(vocabulary(df, columns))


def encoders_from_table(table: DataFrame, inline_max: int = INLINE_MAX) -> Encoders:
    """Encoders from a stored (feature, value, code) vocabulary, e.g. the one saved at training time. The driver gets
    the number of values of each feature and the values of those that have at most ``inline_max``."""
    sizes = {r["feature"]: r["count"] for r in table.groupBy("feature").count().collect()}
    maps: dict[str, dict[str, int]] = {f: {} for f, n in sizes.items() if n <= inline_max}
    if maps:
        for r in table.filter(F.col("feature").isin(*maps)).collect():
            maps[r["feature"]][r["value"]] = r["code"]
    return Encoders(table=table, maps=maps)


def _inline_lookup(column: str, mapping: dict[str, int], dtype: T.DataType) -> Column:
    unknown = mapping.get("unknown", 0)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # an integer's text is its canonical decimal form, so the lookup can use the integer itself
        keys = {}
        for k, v in mapping.items():
            if k.lstrip("-").isdigit() and str(int(k)) == k:
                keys[int(k)] = v
        items = []
        for k in sorted(keys):
            items += [F.lit(k).cast(dtype), F.lit(keys[k])]
        m = F.create_map(*items) if items else F.create_map().cast(f"map<{dtype.simpleString()},int>")
        col = F.col(column)
        return F.when(col.isNull(), F.lit(unknown)).otherwise(
            F.coalesce(F.try_element_at(m, col), F.lit(0))
        ).alias(column)
    items = []
    for k in sorted(mapping):
        items += [F.lit(k), F.lit(mapping[k])]
    m = F.create_map(*items) if items else F.create_map().cast("map<string,int>")
    return F.coalesce(F.try_element_at(m, category_text(column)), F.lit(0)).alias(column)


def _join_lookup(df: DataFrame, table: DataFrame, c: str) -> DataFrame:
    v = table.filter(F.col("feature") == c).select(F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}"))
    return (
        df.withColumn(f"__t_{c}", category_text(c))
        .join(v, F.col(f"__t_{c}") == F.col(f"__v_{c}"), "left")
        .withColumn(c, F.coalesce(F.col(f"__c_{c}"), F.lit(0)))
        .drop(f"__c_{c}", f"__t_{c}", f"__v_{c}")
    )


def apply_encoders(df: DataFrame, enc: Encoders, columns: list[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Category to its code, unseen to 0."""
    present = [c for c in columns if c in df.columns]
    maps = enc.maps
    inline = {c for c in present if c in maps}
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(
        *[_inline_lookup(c, maps.get(c, {}), types[c]) if c in inline else F.col(c) for c in df.columns]
    )
    for c in present:
        if c not in inline:
            out = _join_lookup(out, enc.table, c)
    return out.select(*df.columns)


def align(df: DataFrame, feature_cols: list[str] = FEATURE_COLUMNS, keep: list[str] = (ID_COL,)) -> DataFrame:
    """Trained column order, absent columns NULL, non-numeric text NULL, float32."""
    out = [F.col(k) for k in keep if k in df.columns]
    for c in feature_cols:
        src = F.col(c) if c in df.columns else F.lit(None)
        out.append(src.try_cast("float").alias(c))
    return df.select(*out)


def training_frame(customers: DataFrame) -> tuple[DataFrame, Encoders]:
    """Training path: engineer, fit encoders on these rows, encode; keeps the label."""
    eng = engineer(customers)
    enc = fit_encoders(eng)
    enc_df = apply_encoders(eng, enc)
    return align(enc_df, keep=(ID_COL, TARGET_COL)), enc


def feature_matrix(
    customers: DataFrame, enc: Encoders, feature_cols: list[str] = FEATURE_COLUMNS, keep: list[str] = (ID_COL,)
) -> DataFrame:
    """M3, the scoring path: engineer -> encode with fitted encoders -> align. No Python on the data path. ``keep``
    names columns that pass through, such as the label for an evaluation."""
    return align(apply_encoders(engineer(customers), enc), feature_cols, keep)


def parity_sides(customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training matrix and the scoring matrix of the same customers.

    The training side fits the vocabulary, stores it and looks codes up inline; the scoring side reads the stored
    vocabulary, gets the customers in another partitioning and applies every code by a join."""
    stored = cut_lineage(vocabulary(engineer(customers)), "vocabulary")
    train = feature_matrix(customers, encoders_from_table(stored))
    scattered = customers.drop(TARGET_COL).repartition(7, "n_transactions")
    return train, feature_matrix(scattered, encoders_from_table(stored, inline_max=0))


def parity(customers: DataFrame) -> DataFrame:
    """Rows in the training matrix missing from the scoring matrix and the reverse (both must be 0)."""
    train, serve = parity_sides(customers)
    # EXCEPT ALL both ways in one shuffle: count each distinct row on both sides, then sum the surpluses.
    cols = train.columns
    tagged = train.select("*", F.lit(1).alias("t"), F.lit(0).alias("s")).unionByName(
        serve.select("*", F.lit(0).alias("t"), F.lit(1).alias("s"))
    )
    per_row = tagged.groupBy(*cols).agg(F.sum("t").alias("t"), F.sum("s").alias("s"))
    return per_row.agg(
        F.sum("t").alias("n_rows"),
        F.coalesce(F.sum(F.greatest(F.col("t") - F.col("s"), F.lit(0))), F.lit(0)).alias("train_only"),
        F.coalesce(F.sum(F.greatest(F.col("s") - F.col("t"), F.lit(0))), F.lit(0)).alias("serve_only"),
    )
