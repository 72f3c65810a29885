"""The analytics views over production and categorization tables.

Money stays decimal; averages are one division of an exact sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import values
from tallyspark.sources.readers import optional_column


def _sum_of(kind: str, size: bool = False):
    """Sum of the amount, or of its size, over rows of one type."""
    amount = F.abs("amount") if size else F.col("amount")
    return F.sum(values.amount_of(kind, F.col("transaction_type"), amount))


def _stats():
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        values.mean(F.col("amount")).alias("average_amount"),
        F.min("amount").alias("minimum_amount"),
        F.max("amount").alias("maximum_amount"),
    ]


def monthly_summary(df: DataFrame) -> DataFrame:
    keys = ["transaction_year", "transaction_month", "transaction_type"]
    return df.groupBy(*keys).agg(*_stats()).orderBy(*keys)


def type_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("transaction_type").agg(*_stats()).orderBy(F.desc("total_amount"))


def consumer_summary(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("consumer_id").isNotNull())
        .groupBy("consumer_id")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            _sum_of("Income").alias("total_income"),
            _sum_of("Expense").alias("total_expense"),
            _sum_of("Transfer").alias("total_transfer"),
            values.mean(F.col("amount")).alias("average_transaction_amount"),
            F.min("transaction_date").alias("first_transaction_date"),
            F.max("transaction_date").alias("last_transaction_date"),
        )
    )


def dq_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("missing_description").alias("missing_descriptions"),
        F.count_if("missing_transaction_date").alias("missing_transaction_dates"),
        F.count_if("negative_amount").alias("negative_amounts"),
        F.count_if("zero_amount").alias("zero_amounts"),
        F.count_if("invalid_transaction_type").alias("invalid_transaction_types"),
        F.count_if("future_transaction_date").alias("future_transaction_dates"),
    )


def financial_kpis(df: DataFrame) -> DataFrame:
    """Pre-aggregated per consumer, so the distinct count costs no row expansion."""
    per_consumer = df.groupBy("consumer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("amount").alias("n_amount"),
        _sum_of("Income").alias("income"),
        _sum_of("Expense").alias("expense"),
        _sum_of("Transfer").alias("transfer"),
        F.sum("amount").alias("amount"),
        F.min("transaction_date").alias("first"),
        F.max("transaction_date").alias("last"),
    )
    return per_consumer.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        F.count("consumer_id").alias("total_consumers"),
        F.sum("income").alias("total_income"),
        F.sum("expense").alias("total_expense"),
        F.sum("transfer").alias("total_transfers"),
        F.try_divide(F.sum("amount").cast("double"), F.sum("n_amount").cast("double")).alias(
            "average_transaction_amount"
        ),
        F.min("first").alias("earliest_transaction_date"),
        F.max("last").alias("latest_transaction_date"),
    )


def transactions_with_category(df: DataFrame, categorization: DataFrame) -> DataFrame:
    joined = df.join(categorization, "voucher_id", "left")
    return joined.select(
        "voucher_id",
        "consumer_id",
        "transaction_date",
        "transaction_year",
        "transaction_month",
        "transaction_type",
        "amount",
        "description",
        "canonical_id",
        F.coalesce("category_name", F.lit("UNMAPPED")).alias("category_name"),
        "mapping_status",
        "classification_method",
        "matched_term",
        "confidence",
        "label_source",
    )


def _categorized(df: DataFrame, categorization: DataFrame) -> DataFrame:
    names = categorization.select("voucher_id", "category_name")
    return (
        df.select("voucher_id", "transaction_type", "amount")
        .join(names, "voucher_id", "left")
        .withColumn("category_name", F.coalesce("category_name", F.lit("UNMAPPED")))
    )


def category_summary(df: DataFrame, categorization: DataFrame) -> DataFrame:
    size = F.abs("amount")
    return (
        _categorized(df, categorization)
        .groupBy("category_name")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            _sum_of("Income").alias("total_income"),
            _sum_of("Expense", size=True).alias("total_expense"),
            _sum_of("Transfer", size=True).alias("total_transfer"),
            F.sum(size).alias("total_amount"),
            values.mean(size).alias("average_amount"),
        )
        .orderBy(F.desc("total_expense"))
    )


def category_type_summary(df: DataFrame, categorization: DataFrame) -> DataFrame:
    keys = ["category_name", "transaction_type"]
    return (
        _categorized(df, categorization)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            _sum_of("Expense", size=True).alias("total_expense"),
        )
        .orderBy(*keys)
    )


def status_summary(categorization: DataFrame) -> DataFrame:
    return (
        categorization.groupBy("mapping_status")
        .agg(F.count(F.lit(1)).alias("transaction_count"))
        .orderBy(F.desc("transaction_count"))
    )


def categorization_rows(categorized: DataFrame) -> DataFrame:
    """Cascade output -> categorization table; rows without an id are UNMAPPED."""

    def pick(*names: str, dtype: str = "string"):
        return optional_column(categorized, names, dtype)

    return categorized.select(
        F.col("voucher_id").cast("long").alias("voucher_id"),
        F.col("canonical_id").cast("int").alias("canonical_id"),
        F.when(F.col("canonical_id").isNull(), "UNMAPPED")
        .otherwise(F.col("canonical_family"))
        .alias("category_name"),
        F.col("canonical_mapping_status").alias("mapping_status"),
        pick("canonical_mapping_method", "mapping_method", "classification_method").alias(
            "classification_method"
        ),
        pick("canonical_matched_term", "matched_term").alias("matched_term"),
        pick("canonical_confidence", "ml_confidence", "confidence", dtype="decimal(5,4)").alias(
            "confidence"
        ),
        pick("canonical_label_source", "label_source").alias("label_source"),
    )


VIEWS = {
    "vw_monthly_transaction_summary": monthly_summary,
    "vw_transaction_type_summary": type_summary,
    "vw_consumer_summary": consumer_summary,
    "vw_data_quality_summary": dq_summary,
    "vw_financial_kpis": financial_kpis,
}
CATEGORY_VIEWS = {
    "vw_transactions_with_category": transactions_with_category,
    "vw_category_summary": category_summary,
    "vw_category_transaction_type_summary": category_type_summary,
}


def register_views(production: DataFrame, categorization: DataFrame) -> list[str]:
    """Create every view as a temp view; returns the names."""
    for name, build in VIEWS.items():
        build(production).createOrReplaceTempView(name)
    for name, build in CATEGORY_VIEWS.items():
        build(production, categorization).createOrReplaceTempView(name)
    return [*VIEWS, *CATEGORY_VIEWS]


def materialize_views(spark: SparkSession, names: list[str], root: str) -> None:
    """Write views as Parquet tables for BI readers."""
    for name in names:
        spark.table(name).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
