"""Incremental load: find new keys, shape their rows, reconcile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import values
from tallyspark.operators.clean import incremental_production
from tallyspark.sources.sinks import first_per_key


def detect_new(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows whose key the target lacks.  Rows without a key go to :func:`keyless`."""
    keyed = source.withColumn("_key", values.to_number(F.col("voucher_id"), "bigint"))
    known = target.select(F.col("voucher_id").alias("_key"))
    return keyed.filter("_key is not null").join(known, "_key", "left_anti").drop("_key")


def keyless(source: DataFrame) -> DataFrame:
    """Rows that no keyed table can take."""
    return source.filter(values.to_number(F.col("voucher_id"), "bigint").isNull())


def transform_new(new_rows: DataFrame, as_of: Column) -> DataFrame:
    return incremental_production(new_rows, as_of)


def rows_to_insert(source: DataFrame, target: DataFrame, as_of: Column) -> DataFrame:
    """New rows, shaped, one per key (the smallest source id wins)."""
    shaped = transform_new(detect_new(source, target), as_of)
    return first_per_key(shaped, ["voucher_id"], [F.col("source_id")])


def reconcile(detected: DataFrame, target: DataFrame) -> DataFrame:
    """Detected keys, how many of them the target now has, its size, and PASS or CHECK."""
    keys = detected.select(values.to_number(F.col("voucher_id"), "bigint").alias("voucher_id"))
    marks = keys.select("voucher_id", F.lit(1).alias("d"), F.lit(0).alias("t")).unionByName(
        target.select("voucher_id", F.lit(0).alias("d"), F.lit(1).alias("t"))
    )
    per_key = marks.groupBy("voucher_id").agg(F.sum("d").alias("d"), F.sum("t").alias("t"))
    found = F.sum(F.when((F.col("d") > 0) & (F.col("t") > 0), F.col("t")).otherwise(0))
    return per_key.agg(
        F.coalesce(F.sum("d"), F.lit(0)).alias("detected"),
        F.coalesce(found, F.lit(0)).alias("found"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_count"),
    ).withColumn("status", F.when(F.col("detected") == F.col("found"), "PASS").otherwise("CHECK"))
