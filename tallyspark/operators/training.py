"""Trusted labels -> training set; splits and caps by hash, so reruns pick the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.functions import text, values
from tallyspark.operators.taxonomy import id_to_family
from tallyspark.sources.readers import first_existing
from tallyspark.sources.sinks import first_per_key

COLUMNS = [
    "vch_desc", "vch_type", "canonical_id", "canonical_family", "label_source",
    "label_confidence", "validation_status",
]
# Mapping method -> (label source, confidence), best first.
TRUSTED = {
    "APPROVED_MAPPING": ("approved_mapping", "very_high"),
    "RULE": ("deterministic_rule", "high"),
}
SHOPPING_ID = 2006
SHOPPING_STATUS = "STRONG_SHOPPING"
CAP_BUCKETS = 256


def hash_unit(key: Column, seed: int = 42) -> Column:
    """A reproducible number in [0, 1) per key."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def hash_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark each row ``is_test``; a row-local decision that needs no shuffle."""
    return df.withColumn("is_test", hash_unit(F.col(key), seed) < test_share)


def stratified_split(
    df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Mark ``is_test`` so that each class gives its rounded share of rows.

    Meant for the capped training set, whose classes are small.
    """
    per_class = Window.partitionBy(label)
    order = per_class.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key))), key)
    wanted = F.round(F.count(F.lit(1)).over(per_class) * test_share)
    return df.withColumn("is_test", F.row_number().over(order) <= wanted)


def capped(
    df: DataFrame, label: str, key: str, cap: int = lookups.MAX_PER_CLASS, seed: int = 42
) -> DataFrame:
    """At most ``cap`` rows per class: those with the smallest hashes.

    A class is first thinned inside hash buckets, which keeps every possible
    winner, so no task ever sorts a whole class.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key)))
    keyed = df.withColumn("_h", digest).withColumn(
        "_b", F.pmod(F.xxhash64("_h"), F.lit(CAP_BUCKETS))
    )
    in_bucket = Window.partitionBy(label, "_b").orderBy("_h", key)
    in_class = Window.partitionBy(label).orderBy("_h", key)
    return (
        keyed.withColumn("_r", F.row_number().over(in_bucket))
        .filter(F.col("_r") <= cap)
        .withColumn("_r", F.row_number().over(in_class))
        .filter(F.col("_r") <= cap)
        .drop("_h", "_b", "_r")
    )


def trusted_rows(categorized: DataFrame) -> DataFrame:
    """Rows of reviewed methods whose id and family agree and whose text is not empty."""
    method = F.upper(text.strip(F.col("mapping_method")))
    source = text.map_values(method, {m: s for m, (s, _) in TRUSTED.items()})
    confidence = text.map_values(method, {m: c for m, (_, c) in TRUSTED.items()})
    family = text.family_alias(F.col("canonical_family"), lookups.TRAINING_ALIASES)
    cid = values.to_number(F.col("canonical_id"), "int")
    return (
        categorized.filter(method.isin(*TRUSTED))
        .select(
            "voucher_id",
            "vch_desc",
            "vch_type",
            cid.alias("canonical_id"),
            family.alias("canonical_family"),
            source.alias("label_source"),
            confidence.alias("label_confidence"),
            source.alias("validation_status"),
            text.normalize_training(F.col("vch_desc")).alias("normalized_desc"),
        )
        .filter(
            (id_to_family(F.col("canonical_id")) == F.col("canonical_family"))
            & (F.col("normalized_desc") != "")
        )
    )


def validated_rows(validation: DataFrame) -> DataFrame:
    """Human-validated shopping rows as labels of the fixed class."""
    status = first_existing(
        validation.columns, ["shopping_validation", "validation_status", "shopping_decision"]
    )
    desc = first_existing(validation.columns, ["vch_desc", "ml_description", "description"])
    if status is None or desc is None:
        raise ValueError("validation table lacks a status or description column")
    key = F.col("voucher_id") if "voucher_id" in validation.columns else F.lit(None)
    return validation.filter(
        F.upper(text.strip(F.coalesce(F.col(status), F.lit("")))) == SHOPPING_STATUS
    ).select(
        key.cast("long").alias("voucher_id"),
        F.col(desc).cast("string").alias("vch_desc"),
        F.lit("expense").alias("vch_type"),
        F.lit(SHOPPING_ID).alias("canonical_id"),
        F.lit(lookups.TAXONOMY_V2[SHOPPING_ID]).alias("canonical_family"),
        F.lit("human_validated_shopping").alias("label_source"),
        F.lit("very_high").alias("label_confidence"),
        F.lit(SHOPPING_STATUS).alias("validation_status"),
        text.normalize_training(F.col(desc)).alias("normalized_desc"),
    )


def source_rank(source: Column) -> Column:
    return (
        F.when(source == "approved_mapping", 0).when(source == "deterministic_rule", 1).otherwise(2)
    )


def labelled_union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def distinct_labels(union: DataFrame) -> DataFrame:
    """One row per (text, id), best source first, with ``ids`` = how many ids the text carries."""
    first = first_per_key(
        union,
        ["normalized_desc", "canonical_id"],
        [source_rank(F.col("label_source")), F.col("voucher_id")],
    )
    # After the dedupe a text has at most one row per class.
    return first.withColumn(
        "ids", F.count(F.lit(1)).over(Window.partitionBy("normalized_desc"))
    )


def training_set(union: DataFrame, cap: int = lookups.MAX_PER_CLASS, seed: int = 42) -> DataFrame:
    """Deduplicated labels without conflicting texts, capped per class."""
    clean = distinct_labels(union).filter(F.col("ids") == 1)
    return capped(clean, "canonical_id", "normalized_desc", cap, seed).select(
        *COLUMNS, "normalized_desc"
    )


def training_summary(
    categorized: DataFrame, union: DataFrame, training: DataFrame, cap: int = lookups.MAX_PER_CLASS
) -> DataFrame:
    """``(metric, value)`` rows: inputs, exclusions, result sizes per class and per source."""
    method = F.upper(text.strip(F.col("mapping_method")))
    inputs = categorized.agg(
        F.count(F.lit(1)).alias("source_transactions"),
        F.count_if(method == "APPROVED_MAPPING").alias("approved_mapping_records"),
        F.count_if(method == "RULE").alias("rule_mapping_records"),
        F.count_if(method == "ML").alias("ml_generated_records_excluded"),
    )
    shopping = union.agg(
        F.count_if(F.col("label_source") == "human_validated_shopping").alias("strong_shopping_labels")
    )
    conflicts = (
        union.groupBy("normalized_desc")
        .agg(F.count_distinct("canonical_id").alias("ids"))
        .agg(F.count_if(F.col("ids") > 1).alias("conflicting_descriptions_removed"))
    )
    size = training.agg(
        F.count(F.lit(1)).alias("final_training_records"),
        F.lit(cap).alias("max_records_per_category"),
    )
    from tallyspark.operators.quality import long_form

    fixed = [long_form(df, df.columns, "metric", "value") for df in (inputs, shopping, conflicts, size)]
    labels = training.groupBy("canonical_id", "canonical_family").agg(
        F.count(F.lit(1)).alias("value")
    )
    sources = training.groupBy("label_source").agg(F.count(F.lit(1)).alias("value"))
    return labelled_union(
        [
            *fixed,
            labels.select(
                F.concat_ws("_", F.lit("label"), "canonical_id", "canonical_family").alias("metric"),
                "value",
            ),
            sources.select(F.concat_ws("_", F.lit("source"), "label_source").alias("metric"), "value"),
        ]
    )
