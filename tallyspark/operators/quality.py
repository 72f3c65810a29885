"""Data-quality jobs over the production table."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions import text, values

# The checks whose failure puts the table under review.
CRITICAL_CHECKS = (
    "duplicate_voucher_ids", "null_voucher_ids", "invalid_transaction_types",
    "empty_descriptions", "null_amounts", "negative_amounts", "null_transaction_dates",
    "future_transaction_dates", "invalid_years", "invalid_months", "invalid_days",
)


def _row_checks(as_of: Column) -> dict[str, Column]:
    """Plain SQL predicates: a NULL type or part is not counted as wrong."""
    date = F.col("transaction_date")
    return {
        "invalid_transaction_types": ~F.col("transaction_type").isin(*values.BATCH_TYPES),
        "null_descriptions": F.col("description").isNull(),
        "empty_descriptions": F.trim("description") == "",
        "null_amounts": F.col("amount").isNull(),
        "negative_amounts": F.col("amount") < 0,
        "zero_amounts": F.col("amount") == 0,
        "null_transaction_dates": date.isNull(),
        "future_transaction_dates": date > as_of,
        "invalid_years": F.col("transaction_year") != F.year(date),
        "invalid_months": F.col("transaction_month") != F.month(date),
        "invalid_days": F.col("transaction_day") != F.dayofmonth(date),
        "null_categories": F.col("original_category_id").isNull(),
        "null_consumers": F.col("consumer_id").isNull(),
    }


def key_checks(df: DataFrame, key: str) -> DataFrame:
    """One row of key facts.  Only the key column is read and shuffled."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(F.col("n") > 1).alias("duplicate_groups"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        )
    )


def validate_table(df: DataFrame, as_of: Column, categories: DataFrame | None = None) -> DataFrame:
    """``(check_name, failed, critical)`` of every check.

    All row checks are one shuffle-free aggregate; only the key travels for the
    duplicate check.
    """
    checks = _row_checks(as_of)
    rows = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(c).alias(name) for name, c in checks.items()],
    )
    keys = key_checks(df, "voucher_id").select(
        F.col("duplicate_groups").alias("duplicate_voucher_ids"),
        F.col("null_keys").alias("null_voucher_ids"),
    )
    report = long_form(rows, rows.columns, "check_name", "failed").unionByName(
        long_form(keys, keys.columns, "check_name", "failed")
    )
    if categories is not None:
        count = categories.agg(F.count(F.lit(1)).alias("canonical_categories"))
        report = report.unionByName(long_form(count, count.columns, "check_name", "failed"))
    return report.withColumn("critical", F.col("check_name").isin(*CRITICAL_CHECKS))


def long_form(one_row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """Turn one summary row into (label, value) rows."""
    return one_row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias(label), F.col(n).cast("long").alias(value))
                    for n in names
                ]
            )
        )
    )


def overall_status(checks: DataFrame) -> DataFrame:
    """One row: PASS if every critical check is 0, else REVIEW; failed is their sum."""
    failed = F.sum(F.when(F.col("critical"), F.col("failed")).otherwise(0))
    return checks.agg(
        F.when(failed == 0, "PASS").otherwise("REVIEW").alias("check_status"),
        F.max(F.when(F.col("check_name") == "total_records", F.col("failed"))).alias(
            "records_checked"
        ),
        failed.alias("records_failed"),
    )


def flag_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), *[F.count_if(f).alias(f) for f in schemas.FLAGS]
    )


def post_cast_invalid(typed: DataFrame) -> DataFrame:
    return typed.agg(
        *[
            F.count_if(F.col(c).isNull()).alias(f"invalid_{c}")
            for c in ("voucher_id", "vch_amount", "vch_date")
        ]
    )


def type_distribution(df: DataFrame, column: str = "transaction_type") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("transaction_count"))


def profile_table(df: DataFrame, as_of: Column) -> DataFrame:
    """``(metric, value)``: size, duplicates, NULLs per column, ranges and blank texts."""
    blank = text.strip(F.coalesce(F.col("description"), F.lit(""))) == ""
    rows = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns],
        F.count_if(blank).alias("blank_description"),
        F.count_if(F.col("amount") < 0).alias("negative_amount"),
        F.count_if(F.col("amount") == 0).alias("zero_amount"),
        F.count_if(F.col("transaction_date") > as_of).alias("future_date"),
    )
    keys = key_checks(df, "voucher_id").select(
        F.col("duplicate_rows").alias("duplicate_voucher_id")
    )
    return long_form(rows, rows.columns, "metric", "value").unionByName(
        long_form(keys, keys.columns, "metric", "value")
    )


def distributions(df: DataFrame, groups: Sequence[Sequence[str]]) -> DataFrame:
    """``part``, ``first``, ``second``, ``row_count``: how often each value, or pair of values, of several groups of one or two columns occurs.

    One scan for all groups (grouping sets); each task sums before anything is shuffled.  NULL is a value of its own.
    """
    columns = list(dict.fromkeys(c for group in groups for c in group))
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    # A bit for each column, the first one highest: set where the group leaves the column out.
    left_out = lambda group: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in group)
    sets = texts.groupingSets([[F.col(c) for c in group] for group in groups], *columns)
    counted = sets.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("row_count"))
    pick = lambda of: functools.reduce(lambda c, g: c.when(F.col("_set") == left_out(g), of(g)), groups, F)
    return counted.select(
        pick(lambda g: F.lit(",".join(g))).alias("part"),
        pick(lambda g: F.col(g[0])).alias("first"),
        pick(lambda g: F.col(g[1]) if len(g) > 1 else F.lit(None).cast("string")).alias("second"),
        "row_count",
    )


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``part`` (missing), ``first`` (a column), ``second`` (NULL) and ``row_count``: its NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("first"), F.col(c).alias("row_count")) for c in columns])
    return counts.select(F.inline(rows)).select(F.lit("missing").alias("part"), "first", F.lit(None).cast("string").alias("second"), "row_count")


def value_ranges(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.min("transaction_date").alias("min_date"),
        F.max("transaction_date").alias("max_date"),
        F.count_if(F.col("transaction_date").isNull()).alias("invalid_dates"),
    )
