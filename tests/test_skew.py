import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.skew import bucketed, drop_tables, heavy_keys, salted_join
from ledgerline.session import fresh_path
from conftest import rows


def sides(spark):
    """A third of the rows have one key, some have none."""
    large = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 400).alias("k"), F.col("id").alias("x"))
    other = spark.createDataFrame([(i, f"n{i}") for i in range(0, 400, 2)] + [(7, "a"), (7, "b")],
                                  "k long, name string")
    return large, other


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_and_bounded_tasks_without_aqe(spark, how):
    large, other = sides(spark)
    keep = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled",
                                           "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = salted_join(large, other, "k", how, rows_per_task=100)
        assert rows(got) == rows(large.join(other, "k", how))
        per_task = [r["count"] for r in got.filter("k = 7").groupBy(
            F.spark_partition_id().alias("p")).count().collect()]
        plain = [r["count"] for r in large.join(other, "k", how).filter("k = 7").groupBy(
            F.spark_partition_id().alias("p")).count().collect()]
        assert len(plain) == 1 and len(per_task) >= 4 and max(per_task) < 0.6 * sum(per_task)
    finally:
        for c, v in keep.items():
            spark.conf.set(c, v)


def test_heavy_keys_are_found_by_the_sketch(spark):
    large, _ = sides(spark)
    got = {r["k"]: r["salts"] for r in heavy_keys(large, "k", 100).collect()}
    assert got == {7: 11}
    assert heavy_keys(large.limit(0), "k").count() == 0
    with pytest.raises(ValueError):
        salted_join(large, large, "k", "right")


def test_empty_sides(spark):
    large, other = sides(spark)
    assert salted_join(large.limit(0), other, "k").count() == 0
    assert salted_join(large, other.limit(0), "k", "left", 100).count() == 3000


def test_bucketed_tables_join_without_an_exchange(spark):
    large, other = sides(spark)
    names = [f"t_{uuid.uuid4().hex[:8]}" for _ in range(3)]
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b, c = (bucketed(df, n, fresh_path(spark, n), "k", 4)
                   for df, n in zip((large, other, large), names))
        joined = a.join(b, "k").join(c.withColumnRenamed("x", "y"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert rows(a.join(b, "k")) == rows(large.join(other, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
        drop_tables(spark, names)
