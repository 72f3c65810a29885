"""Raw text rows -> typed rows -> flagged rows -> production rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import lookups, schemas
from tallyspark.functions import text, values

# Raw column -> production column, in table order.
RENAMES = {
    "voucher_id": "voucher_id",
    "id": "source_id",
    "consumer_id": "consumer_id",
    "vch_type": "transaction_type",
    "vch_amount": "amount",
    "vch_date": "transaction_date",
    "vch_year": "transaction_year",
    "vch_month": "transaction_month",
    "vch_day": "transaction_day",
    "vch_created_on": "created_on",
    "vch_desc": "description",
    "fc_amount": "foreign_currency_amount",
    "fc_rate": "foreign_currency_rate",
    "account_id": "account_id",
    "record_created_on": "record_created_on",
    "category_id": "original_category_id",
    "use_case_title": "use_case_title",
}

TYPES = {
    "voucher_id": "bigint", "id": "bigint", "consumer_id": "bigint", "account_id": "bigint",
    "vch_year": "int", "vch_month": "int", "vch_day": "int",
}


def numbers(df: DataFrame) -> DataFrame:
    """The eleven numeric columns; bad text becomes NULL."""
    typed = {c: values.to_number(F.col(c), t) for c, t in TYPES.items()}
    typed["vch_amount"] = values.money(F.col("vch_amount"))
    typed["fc_amount"] = values.money(F.col("fc_amount"))
    typed["fc_rate"] = values.rate(F.col("fc_rate"))
    typed["category_id"] = text.strip(F.col("category_id")).try_cast(schemas.CATEGORY_ID)
    return df.withColumns(typed)


def dates(df: DataFrame) -> DataFrame:
    """The three date columns; bad text becomes NULL."""
    return df.withColumns(
        {
            "vch_date": values.to_date(F.col("vch_date")),
            "vch_created_on": values.to_timestamp(F.col("vch_created_on")),
            "record_created_on": values.to_timestamp(F.col("record_created_on")),
        }
    )


def texts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: text.strip(F.col(c)) for c in ("vch_type", "vch_desc", "use_case_title")}
    )


def typed(df: DataFrame) -> DataFrame:
    return texts(dates(numbers(df)))


def flagged(
    df: DataFrame, as_of: Column, valid_types: tuple[str, ...] = values.BATCH_TYPES
) -> DataFrame:
    return df.withColumns(
        values.quality_flags(
            F.col("vch_desc"),
            F.col("vch_date"),
            F.col("vch_amount"),
            F.col("vch_type"),
            as_of,
            valid_types,
        )
    )


def production(df: DataFrame) -> DataFrame:
    """Rename and order the columns of flagged rows."""
    return df.select(
        *[F.col(raw).alias(name) for raw, name in RENAMES.items()], *schemas.FLAGS
    )


def to_production(
    raw: DataFrame, as_of: Column, valid_types: tuple[str, ...] = values.BATCH_TYPES
) -> DataFrame:
    """The whole cleaning step as one projection: no shuffle, one pass."""
    return production(flagged(typed(raw), as_of, valid_types))


def incremental_production(new_rows: DataFrame, as_of: Column) -> DataFrame:
    """Incremental variant: descriptions are not stripped, Transfer is no valid type."""
    return production(flagged(dates(numbers(new_rows)), as_of, values.INCREMENTAL_TYPES))


def null_edge(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN -> NULL."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def date_parts_agree(df: DataFrame) -> DataFrame:
    """Stored year, month and day next to those of the date."""
    date = F.col("transaction_date")
    return df.select(
        "voucher_id",
        F.year(date).alias("date_year"),
        F.month(date).alias("date_month"),
        F.dayofmonth(date).alias("date_day"),
        values.flag(F.col("transaction_year") == F.year(date)).alias("year_agrees"),
        values.flag(F.col("transaction_month") == F.month(date)).alias("month_agrees"),
        values.flag(F.col("transaction_day") == F.dayofmonth(date)).alias("day_agrees"),
    )


def sane_labelled(raw: DataFrame) -> DataFrame:
    """Rows usable as labelled evidence: complete, with a sane numeric category and some text."""
    category = values.to_number(F.col("category_id"), "double")
    usable = raw.dropna(subset=["id", "vch_desc", "category_id", "vch_type"]).filter(
        category <= lookups.MAX_SANE_CATEGORY_ID
    )
    return values.computed_once(
        usable,
        {
            "source_category_id": category.cast("bigint"),
            "clean_description": text.normalize_evidence(F.col("vch_desc")),
            "vch_type": text.strip(F.col("vch_type")),
        },
    ).filter("clean_description <> ''")
