"""Reports on what the cascade left open and on how its rules behave."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.functions import text, values
from tallyspark.operators.cascade import with_share

FIELDS = [
    "vch_desc", "vch_type", "category_id", "source_category_id", "use_case_title", "source_id",
    "consumer_id", "amount", "foreign_currency_amount", "foreign_currency_rate", "account_id",
]


def is_unresolved() -> Column:
    family = text.strip(F.coalesce("canonical_family", F.lit("")))
    return family.isin("", "UNMAPPED")


def unresolved(categorized: DataFrame) -> DataFrame:
    return categorized.filter(is_unresolved())


def unresolved_share(categorized: DataFrame) -> DataFrame:
    total, open_rows = F.count(F.lit(1)), F.count_if(is_unresolved())
    return categorized.agg(
        total.alias("transactions"),
        open_rows.alias("unresolved"),
        values.share(open_rows, total).alias("unresolved_pct"),
    )


def description(col: str = "vch_desc") -> Column:
    """Stripped text, NULL -> empty, case kept."""
    return text.strip(F.coalesce(F.col(col), F.lit("")))


def top_counts(
    df: DataFrame, columns: Sequence[str], n: int | None = None, count: str = "transaction_count"
) -> DataFrame:
    """Value counts, largest first, then by value; optionally only the first n."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count))
    ordered = counts.orderBy(F.desc(count), *[F.asc_nulls_last(c) for c in columns])
    return ordered.limit(n) if n else ordered


def blank_share(open_rows: DataFrame) -> DataFrame:
    blank = F.count_if(F.lower(description()).isin("", *text.NULL_WORDS))
    total = F.count(F.lit(1))
    return open_rows.agg(
        blank.alias("blank"),
        (total - blank).alias("non_blank"),
        values.share(blank, total).alias("blank_pct"),
    )


def length_band(size: Column) -> Column:
    return (
        F.when(size == 0, "0 characters")
        .when(size <= 5, "1-5 characters")
        .when(size <= 10, "6-10 characters")
        .when(size <= 20, "11-20 characters")
        .when(size <= 50, "21-50 characters")
        .otherwise("51+ characters")
    )


def length_bands(open_rows: DataFrame) -> DataFrame:
    counts = open_rows.groupBy(length_band(F.length(description())).alias("length_band")).agg(
        F.count(F.lit(1)).alias("transaction_count")
    )
    return with_share(counts, "transaction_count", "percentage", [])


def top_descriptions(open_rows: DataFrame, n: int = 50) -> DataFrame:
    named = open_rows.select(F.lower(description()).alias("description")).filter("description <> ''")
    return top_counts(named, ["description"], n)


def by_type(open_rows: DataFrame) -> DataFrame:
    kinds = open_rows.select(
        text.strip(F.coalesce("vch_type", F.lit("MISSING"))).alias("vch_type")
    )
    return with_share(
        kinds.groupBy("vch_type").agg(F.count(F.lit(1)).alias("transaction_count")),
        "transaction_count",
        "percentage",
        [],
    )


def by_method(open_rows: DataFrame) -> DataFrame:
    return open_rows.groupBy(
        F.coalesce("mapping_method", F.lit("MISSING")).alias("mapping_method")
    ).agg(F.count(F.lit(1)).alias("transaction_count"))


def field_availability(open_rows: DataFrame, fields: Iterable[str] = FIELDS) -> DataFrame:
    """Non-NULL count and percentage of every listed field that exists."""
    present = [f for f in fields if f in open_rows.columns]
    one = open_rows.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count(f).alias(f) for f in present]
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("field"),
                        F.col(f).alias("non_null"),
                        values.share(F.col(f), F.col("_total")).alias("non_null_pct"),
                    )
                    for f in present
                ]
            )
        )
    )


def description_uniqueness(open_rows: DataFrame) -> DataFrame:
    per_text = (
        open_rows.select(F.lower(description()).alias("d"))
        .filter("d <> ''")
        .groupBy("d")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_text.agg(
        F.count(F.lit(1)).alias("unique_descriptions"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("non_blank_transactions"),
        F.try_divide(F.sum("n").cast("double"), F.count(F.lit(1)).cast("double")).alias(
            "transactions_per_description"
        ),
    )


def keyword_groups(open_rows: DataFrame) -> DataFrame:
    """Rows that contain any keyword of each group; the groups overlap."""
    lowered = F.lower(description())
    groups = lookups.DIAGNOSTIC_KEYWORDS
    one = open_rows.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(text.contains_any(lowered, words)).alias(g) for g, words in groups.items()],
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(g).alias("keyword_group"),
                        F.col(g).alias("transaction_count"),
                        values.share(F.col(g), F.col("_total")).alias("percentage"),
                    )
                    for g in groups
                ]
            )
        )
    )


# ----------------------------------------------------------------------- metadata


def use_case_top(open_rows: DataFrame, n: int = 100) -> DataFrame:
    titles = open_rows.select(description("use_case_title").alias("use_case_title")).filter(
        ~F.lower("use_case_title").isin("", *text.NULL_WORDS)
    )
    return top_counts(titles, ["use_case_title"], n)


def category_top(open_rows: DataFrame, n: int = 100) -> DataFrame:
    return top_counts(open_rows.select(_category().alias("category_id")), ["category_id"], n)


def _category() -> Column:
    return values.to_number(F.col("category_id"), "double")


def category_use_case(open_rows: DataFrame, n: int = 100) -> DataFrame:
    """Pairs with a category id; blank titles count as MISSING."""
    title = description("use_case_title")
    pairs = open_rows.filter(_category().isNotNull()).select(
        _category().alias("category_id"),
        F.when(title.isin("", "nan", "None", "null"), "MISSING").otherwise(title).alias("use_case_title"),
    )
    return top_counts(pairs, ["category_id", "use_case_title"], n)


# -------------------------------------------------------------------------- rules


def rule_rows(categorized: DataFrame) -> DataFrame:
    return categorized.filter(F.upper("mapping_method") == "RULE").withColumn(
        "description_clean", text.normalize_diagnostic(F.col("vch_desc"))
    )


def rule_top(rules: DataFrame, n: int = 100) -> DataFrame:
    return top_counts(rules, ["description_clean", "canonical_family"], n)


def rule_families(rules: DataFrame) -> DataFrame:
    """Rows and distinct descriptions per family, pre-counted per description."""
    per_text = rules.groupBy("canonical_family", "description_clean").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        per_text.groupBy("canonical_family")
        .agg(
            F.sum("n").alias("transaction_count"), F.count(F.lit(1)).alias("unique_descriptions")
        )
        .orderBy(F.desc("unique_descriptions"))
    )


def rule_generic(rules: DataFrame, n: int = 100) -> DataFrame:
    hits = rules.filter(text.matches_any(F.col("description_clean"), lookups.GENERIC_TERMS))
    return top_counts(hits, ["description_clean", "canonical_family"], n)


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """Descriptions that rules sent to more than one family, with the counts per family.

    One shuffle: the counts per (description, family) stay where their description is.
    """
    per_pair = rules.groupBy("description_clean", "canonical_family").agg(
        F.count(F.lit(1)).alias("transaction_count")
    )
    families = F.count(F.lit(1)).over(Window.partitionBy("description_clean"))
    return per_pair.withColumn("family_count", families).filter("family_count > 1")


def rule_share(categorized: DataFrame) -> DataFrame:
    method = F.upper("mapping_method")
    rule, auto = F.count_if(method == "RULE"), F.count_if(method != "UNMAPPED")
    return categorized.agg(
        rule.alias("rule_rows"),
        auto.alias("automatic_rows"),
        values.share(rule, auto).alias("rule_share_pct"),
    )


# ----------------------------------------------------------------- unknown recovery


def unknown_groups(detail: DataFrame, frequent: int = 10, low_purity: float = 0.5) -> DataFrame:
    """UNKNOWN rows by how often their text occurs among them.

    Texts seen once, seen repeatedly, and seen often with a low historical purity.
    """
    per_text = (
        detail.filter("decision = 'UNKNOWN'")
        .groupBy("clean_description")
        .agg(F.count(F.lit(1)).alias("n"), F.max("hist_purity").alias("purity"))
    )
    group = (
        F.when(F.col("n") == 1, "singleton")
        .when((F.col("n") >= frequent) & (F.col("purity") < low_purity), "frequent_low_purity")
        .otherwise("repeated")
    )
    return per_text.groupBy(group.alias("text_group")).agg(
        F.count(F.lit(1)).alias("texts"), F.sum("n").alias("row_count")
    )


def unknown_recovery(
    detail: DataFrame,
    purities: Sequence[float] = (0.5, 0.6, 0.7, 0.8, 0.9),
    supports: Sequence[int] = (1, 2, 3, 5),
) -> DataFrame:
    """UNKNOWN rows that history would recover at each (purity, support), and how accurately.

    The rows are first counted per distinct (purity, support); the grid meets those counts.
    """
    cells = (
        detail.filter("decision = 'UNKNOWN' and hist_category is not null")
        .groupBy("hist_purity", F.least("hist_support", F.lit(max(supports))).alias("support"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("hist_category") == F.col("true_category")).alias("right"),
        )
    )
    points = F.array(
        *[
            F.struct(F.lit(p).alias("min_purity"), F.lit(s).alias("min_support"))
            for p in purities
            for s in supports
        ]
    )
    hit = (F.col("hist_purity") >= F.col("min_purity")) & (F.col("support") >= F.col("min_support"))
    return (
        cells.select("*", F.inline(points))
        .groupBy("min_purity", "min_support")
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("recovered"),
            F.round(
                values.share(
                    F.sum(F.when(hit, F.col("right")).otherwise(0)),
                    F.sum(F.when(hit, F.col("n")).otherwise(0)),
                ),
                2,
            ).alias("accuracy_pct"),
        )
    )
