"""Joins with a hot key."""

import pytest
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.operators import gates
from tallyspark.operators.lookup import hot_keys, lookup
from tallyspark.session import materialized


@pytest.fixture(scope="module")
def rows(spark):
    """A third of 3,000 rows have one text, some have none."""
    text = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("t"), F.col("id") % 200))
    return materialized(spark.range(3000).select("id", text.alias("t")), "rows")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_hot_path_gives_the_plain_join(spark, rows, how):
    table = spark.range(150).select(F.concat(F.lit("t"), "id").alias("t"), F.col("id").alias("v")).unionByName(spark.createDataFrame([("hot", -1), ("absent", -2)], "t string, v long"))
    want = sorted(rows.join(table, "t", how).collect(), key=str)
    split = lookup(rows, table, "t", how, hot_rows=500, most=20)
    assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(split.select(*rows.join(table, "t", how).columns).collect(), key=str) == want
    for most in (20, 100_000):  # without hot keys, and by broadcast alone
        assert len(lookup(rows, table, "t", how, most=most).collect()) == len(want)


def test_the_hot_text_is_in_no_shuffled_task(spark, rows):
    table = spark.range(150).select(F.concat(F.lit("t"), "id").alias("t"), F.col("id").alias("v"))
    assert [r.t for r in hot_keys(rows, "t", 500, 20).collect()] == ["hot"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup(rows, table, "t", "left", hot_rows=500, most=20)
        sizes = joined.filter("t <> 'hot'").groupBy(F.spark_partition_id()).count().collect()
        plain = rows.join(table, "t", "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in plain) >= 1000 > max(r["count"] for r in sizes)


def test_number_of_hot_keys_is_bounded(spark, rows):
    assert hot_keys(rows, "t", hot_rows=1, most=5).count() <= 5


def test_a_family_outside_the_taxonomy_stops_the_job(spark):
    good = spark.createDataFrame([("UNMAPPED",), (lookups.TAXONOMY_V2[2006],), (None,)], "canonical_family string")
    assert gates.checked_families(good).count() == 3
    bad = good.unionByName(spark.createDataFrame([("Pets",)], "canonical_family string"))
    with pytest.raises(Exception, match="Pets"):
        gates.checked_families(bad).collect()
