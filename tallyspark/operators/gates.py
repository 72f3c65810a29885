"""Schema, key and domain gates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.operators.lookup import lookup
from tallyspark.operators.quality import key_checks
from tallyspark.session import materialized


class GateError(ValueError):
    """A gate that must stop the job."""


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required names the schema lacks, in the given order; runs no job."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise GateError(f"Missing required columns: {', '.join(missing)}")
    return df


def column_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``(column_name, present, null_rows)`` of the required columns, in one scan."""
    present = [c for c in required if c in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.lit(True).alias("present"), F.col(c).alias("null_rows"))
        for c in present
    ] + [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(False).alias("present"),
            F.lit(None).cast("long").alias("null_rows"),
        )
        for c in missing_columns(df, required)
    ]
    return counts.select(F.inline(F.array(*pairs)))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """``(duplicate_keys, null_keys)``; the 2nd and later occurrences are duplicates.

    Missing keys repeat each other too, so all but one of them are duplicates.
    """
    return key_checks(df, key).select(
        F.col("duplicate_rows").alias("duplicate_keys"), "null_keys"
    )


def require_unique_key(df: DataFrame, key: str) -> DataFrame:
    row = key_counts(df, key).first()
    if row.duplicate_keys or row.null_keys:
        raise GateError(
            f"{key}: {row.duplicate_keys} duplicate and {row.null_keys} missing keys"
        )
    return df


def values_outside(df: DataFrame, column: str, domain: Iterable[str]) -> DataFrame:
    """Distinct non-NULL values that are not in the domain."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*domain))
        .select(column)
        .distinct()
    )


def families_outside(df: DataFrame, version: str = "v2") -> DataFrame:
    """Families that are neither in the taxonomy nor UNMAPPED."""
    allowed = (*lookups.TAXONOMIES[version].values(), "UNMAPPED")
    return values_outside(df, "canonical_family", allowed)


def require_families(df: DataFrame, version: str = "v2") -> DataFrame:
    # All families are looked at; only the message ends after twenty.
    bad = [r[0] for r in families_outside(df, version).limit(20).collect()]
    if bad:
        raise GateError(f"Invalid canonical families: {sorted(bad)}")
    return df


def checked_families(df: DataFrame, version: str = "v2") -> DataFrame:
    """``df``; a row whose family is neither in the taxonomy nor UNMAPPED stops the job that reads it, without a pass of its own."""
    family = F.col("canonical_family")
    allowed = (*lookups.TAXONOMIES[version].values(), "UNMAPPED")
    message = F.concat(F.lit("Invalid canonical family: "), family)
    return df.withColumn("canonical_family", F.when(family.isNull() | family.isin(*allowed), family).otherwise(F.raise_error(message)))


def conflicting_keys(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys that carry more than one value, with how many."""
    return (
        df.groupBy(*keys)
        .agg(F.count_distinct(value).alias("value_count"))
        .filter("value_count > 1")
    )


def rows_in_conflict(rows: DataFrame, key: str, value: str, inside: bool = True) -> DataFrame:
    """The rows whose key carries more than one value, or all others; a key may be hot."""
    rows = materialized(rows, "conflict-rows")
    conflicts = materialized(conflicting_keys(rows, [key], value), "conflicts")
    return lookup(rows, conflicts, key, "left_semi" if inside else "left_anti")
