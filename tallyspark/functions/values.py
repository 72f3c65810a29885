"""Typed values from text: numbers, dates, money and the data-quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions import text

BATCH_TYPES = ("Expense", "Income", "Transfer")
INCREMENTAL_TYPES = ("Income", "Expense")

# Accepted date layouts, by shape.
PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2}(?:\.\d{3}(?:\d{3})?)?)?)?$"
ZONED = r"^\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}:\d{2}|T\d{2}:\d{2}:\d{2}(?:\.\d{3}(?:\d{3})?)?)(?:Z|[+-]\d{2}:\d{2})$"
YEAR_FIRST = r"^\d{4}/\d{2}/\d{2}(?: \d{2}:\d{2}:\d{2})?$"
MONTH_FIRST = r"^\d{2}/\d{2}/\d{4}(?: \d{2}:\d{2}(?::\d{2})?)?$"
MINUTES = 16


def to_number(col: Column, dtype: str = "double") -> Column:
    """Number or NULL.  Whole-number types accept ``"5.0"`` as 5; ``"5.7"`` is no whole number, hence NULL."""
    value = text.strip(col.cast("string"))
    if dtype in ("bigint", "long", "int"):
        exact = value.try_cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), exact).try_cast(dtype)
    return value.try_cast(dtype)


def to_timestamp(col: Column) -> Column:
    """Timestamp or NULL.  The value's shape says which layout it has, so that each cell is parsed once."""
    value = text.strip(col.cast("string"))

    def local(plain: Column) -> Column:
        whole = F.when(F.length(plain) == MINUTES, F.concat(plain, F.lit(":00"))).otherwise(plain)
        return whole.try_cast("timestamp_ntz")

    turned = F.concat(value.substr(7, 4), F.lit("-"), value.substr(1, 2), F.lit("-"), value.substr(4, 2), F.substring(value, F.lit(11), F.length(value)))
    return (
        F.when(value.rlike(PLAIN), local(value))
        .when(value.rlike(ZONED), value.try_cast("timestamp").cast("timestamp_ntz"))
        .when(value.rlike(YEAR_FIRST), local(F.translate(value, "/", "-")))
        .when(value.rlike(MONTH_FIRST), local(turned))
    )


def to_date(col: Column) -> Column:
    return to_timestamp(col).cast("date")


def money(col: Column) -> Column:
    """Half-up to two decimals."""
    return text.strip(col.cast("string")).try_cast("decimal(38,18)").try_cast(schemas.MONEY)


def rate(col: Column) -> Column:
    return text.strip(col.cast("string")).try_cast("decimal(38,18)").try_cast(schemas.RATE)


def flag(condition: Column, when_null: bool = False) -> Column:
    """A boolean that is never NULL."""
    return F.coalesce(condition, F.lit(when_null))


def quality_flags(
    description: Column,
    date: Column,
    amount: Column,
    kind: Column,
    as_of: Column,
    valid_types: tuple[str, ...] = BATCH_TYPES,
) -> dict[str, Column]:
    """The six row flags.  A missing type is invalid; a missing amount or date is not."""
    return {
        "missing_description": flag(text.strip(description) == "", when_null=True),
        "missing_transaction_date": date.isNull(),
        "negative_amount": flag(amount < 0),
        "zero_amount": flag(amount == 0),
        "invalid_transaction_type": flag(~kind.isin(*valid_types), when_null=True),
        "future_transaction_date": flag(date > as_of),
    }


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and projections use by value.

    Filters are otherwise pushed below the projection and repeat its
    expressions, once per use.  A one-row generator is a border they stay above.
    """
    keep = [c for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def amount_of(kind: str, type_col: Column, amount: Column) -> Column:
    """The amount where the row has the given type, else 0."""
    return F.when(type_col == kind, amount).otherwise(F.lit(0).cast(schemas.MONEY))


def share(part: Column, whole: Column) -> Column:
    """Percentage as a double, NULL where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def mean(col: Column) -> Column:
    """Average of an exact column: exact sum, one division at the end."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col).cast("double"))
