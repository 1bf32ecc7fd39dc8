"""Tables compared by sums of row hashes: against EXCEPT ALL, with planted changes."""

import pytest
from pyspark.sql import functions as F

from scorewright.operators import multiset


def rows(spark):
    made = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 7 != 0, F.col("id") / 8).alias("x"),
        (F.col("id") % 2 == 0).alias("a.b"),
    )
    return made.withColumn("x", F.when(F.col("k") == "same", 0.0).otherwise(F.col("x")))  # a third is one row, repeated


def found(a, b):
    return sorted(str(tuple(r)) for r in multiset.differences(a, b).collect())


def test_equal_tables_in_any_order(spark):
    a = rows(spark)
    b = a.orderBy(F.rand(3)).repartition(5).withColumn("x", F.when(F.col("x") == 0, -0.0).otherwise(F.col("x")))
    assert multiset.fingerprint(a).first() == multiset.fingerprint(b).first() and found(a, b) == []
    plan = multiset.fingerprint(a)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange SinglePartition" in plan  # a row a task
    none = a.limit(0)
    assert tuple(multiset.fingerprint(none).first()) == (0, 0, 0) and found(none, none) == []


def test_any_planted_change_is_found(spark):
    a = rows(spark)
    gone, once_more = a.filter("k <> '1000'"), a.unionByName(a.filter("k = '1001'"))
    null = a.withColumn("x", F.when(F.col("k") != "1003", F.col("x")))
    one_copy_less = a.filter("k <> 'same'").unionByName(a.filter("k = 'same'").withColumn("i", F.monotonically_increasing_id()).filter("i > 0").drop("i"))
    for b in (gone, once_more, null, one_copy_less, a.limit(0)):
        want = sorted(
            str(tuple(r))
            for r in a.withColumn("s", F.lit(1)).unionByName(b.withColumn("s", F.lit(0))).groupBy(*(F.col(f"`{c}`") for c in a.columns))
            .agg(F.sum("s").alias("n_a"), F.sum(1 - F.col("s")).alias("n_b")).filter("n_a <> n_b").collect()
        )
        assert found(a, b) == want and want


def test_values_do_not_run_together(spark):
    a = spark.createDataFrame([("ab", "c"), (None, "-")], "p string, q string")
    b = spark.createDataFrame([("a", "bc"), ("-", None)], "p string, q string")
    assert multiset.fingerprint(a).first() != multiset.fingerprint(b).first() and len(found(a, b)) == 4
    with pytest.raises(TypeError, match="nested"):
        multiset.fingerprint(a.select(F.array("p").alias("l")))
