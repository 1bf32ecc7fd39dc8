"""Latest scores kept by key: plans without a shuffle of the stored rows, lookups of one file, re-runs."""

import glob
import os
import tempfile

from pyspark.sql import functions as F

from scorewright.operators import keyed, store


def scores(spark, run_id, lo, hi, day):
    p = (F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10_000.0).alias("churn_probability")
    ids = spark.range(lo, hi).select(F.col("id").cast("string").alias("customer_id"), F.lit(run_id).alias("run_id"), F.lit("v").alias("model_version"), p)
    rest = [F.lit(True).alias("churn_label"), F.lit(1).alias("churn_decile"), F.lit("low").alias("risk_tier")]
    return ids.select("*", *rest, F.lit(f"2020-01-{day:02} 00:00:00").cast("timestamp_ntz").alias("scored_at"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def folder():
    return tempfile.mkdtemp(prefix="scorewright-test-keyed-")


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_merge_shuffles_the_new_run_alone(spark):
    wh = folder()
    r0, r1 = scores(spark, "R0", 0, 5000, 1), scores(spark, "R1", 3000, 6000, 2)
    store.next_latest(spark, None, wh + "/1", "R0", r0, r0)
    old = keyed.read_keyed(spark, wh + "/1")
    p = plan(store.merge_latest(old, r1))
    assert p.count("Exchange") == 1 and "Bucketed: true" in p and p.index("FileScan") < p.index("Exchange")
    store.next_latest(spark, wh + "/1", wh + "/2", "R1", r1, r0.unionByName(r1))
    assert len(glob.glob(wh + "/2/part-*")) == keyed.MIN_BUCKETS  # a file a bucket, though nothing was moved
    assert same(keyed.read_keyed(spark, wh + "/2"), store.latest_scores(r0.unionByName(r1)).select(*store.PREDICTION_COLUMNS))


def test_lookup_opens_the_file_of_its_bucket(spark):
    wh = folder()
    r0 = scores(spark, "R0", 0, 4000, 1)
    store.next_latest(spark, None, wh + "/1", "R0", r0, r0)
    table = keyed.read_keyed(spark, wh + "/1")
    mine = table.filter(F.col("customer_id") == "42").select(F.input_file_name()).first()[0]
    for f in glob.glob(wh + "/1/part-*"):
        if os.path.basename(f) != os.path.basename(mine):
            with open(f, "wb") as out:
                out.write(b"not a parquet file")
            if os.path.exists(crc := os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")):
                os.remove(crc)
    assert store.score_for(table, "42").first()["customer_id"] == "42"
    import pyarrow.parquet as pq

    column = pq.ParquetFile(mine.split(":", 1)[1].replace("//", "/")).metadata.row_group(0).column(0)
    assert column.path_in_schema == "customer_id" and column.statistics.has_min_max


def test_another_session_reads_the_same_table(spark):
    wh = folder()
    r0 = scores(spark, "R0", 0, 1000, 1)
    store.next_latest(spark, None, wh + "/1", "R0", r0, r0)
    other = spark.newSession()
    other.sql(f"DROP TABLE {keyed._name(wh + '/1')}")  # as where the catalog lives in the session
    again = keyed.read_keyed(other, wh + "/1")
    assert again.count() == 1000
    joined = plan(again.hint("merge").join(again.select("customer_id").hint("merge"), "customer_id"))
    assert "Exchange" not in joined and "Bucketed: true" in joined
    assert same(other.read.parquet(wh + "/1"), again)  # plain Parquet to others
    keyed.drop_keyed(other, wh + "/1")
    assert not os.path.exists(wh + "/1")


def test_reruns_withdrawals_and_growth(spark, monkeypatch):
    wh = folder()
    r0, r1 = scores(spark, "R0", 0, 300, 1), scores(spark, "R1", 100, 400, 2)
    both = r0.unionByName(r1)
    store.next_latest(spark, None, wh + "/1", "R0", r0, r0)
    store.next_latest(spark, wh + "/1", wh + "/2", "R1", r1, both)
    less = r1.filter("customer_id < '2'")
    store.next_latest(spark, wh + "/2", wh + "/3", "R1", less, r0.unionByName(less))
    want = store.latest_scores(r0.unionByName(less)).select(*store.PREDICTION_COLUMNS)
    assert same(keyed.read_keyed(spark, wh + "/3"), want)
    store.next_latest(spark, wh + "/3", wh + "/4", "R1", r1.limit(0), r0)
    assert same(keyed.read_keyed(spark, wh + "/4"), r0)
    monkeypatch.setattr(keyed, "ROWS_PER_BUCKET", 20)
    store.next_latest(spark, wh + "/4", wh + "/5", "R1", r1, both)
    assert keyed.keyed_note(spark, wh + "/5")["buckets"] == 16 == len(glob.glob(wh + "/5/part-*"))
    assert same(keyed.read_keyed(spark, wh + "/5"), store.latest_scores(both).select(*store.PREDICTION_COLUMNS))
    r0.write.parquet(wh + "/plain")  # a table of before, without buckets
    store.next_latest(spark, wh + "/plain", wh + "/6", "R1", r1, both)
    assert same(keyed.read_keyed(spark, wh + "/6"), store.latest_scores(both).select(*store.PREDICTION_COLUMNS))


def test_empty_table(spark):
    wh = folder()
    none = scores(spark, "R0", 0, 0, 1)
    store.next_latest(spark, None, wh + "/1", "R0", none, none)
    r1 = scores(spark, "R1", 0, 50, 2)
    store.next_latest(spark, wh + "/1", wh + "/2", "R1", r1, r1)
    assert same(keyed.read_keyed(spark, wh + "/2"), r1)
