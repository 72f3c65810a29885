"""The mapping cascade: approved map, keyword rule, strong category id, classifier, UNMAPPED.

All stages are column expressions on one row; the lookups are small tables of
reviewed rows.  The first stage that yields a family wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.functions import text, values
from tallyspark.functions.quantiles import exact_quantiles
from tallyspark.operators import gates
from tallyspark.operators.taxonomy import family_to_id
from tallyspark.sources.sinks import first_per_key

# A lookup side is broadcast only below this many rows; beyond it the join is left to AQE.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast a lookup if its checked size allows, else leave the strategy to AQE."""
    count = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if count <= BROADCAST_ROWS else df


def clean_inputs(raw: DataFrame) -> DataFrame:
    """Add the normalized columns every stage compares, and the keyword rule's family."""
    cleaned = values.computed_once(
        raw.withColumn("source_category_id", F.col("category_id")),
        {
            "description_clean": text.normalize_cascade(F.col("vch_desc")),
            "vch_type_clean": text.normalize_type(F.col("vch_type")),
            "category_id_clean": text.normalize_category_id(F.col("category_id")),
        },
    )
    return values.computed_once(
        cleaned, {"rule_family": keyword_family(F.col("description_clean"))}
    )


def clean_approved(approved: DataFrame, aliases: dict[str, str] = lookups.CASCADE_ALIASES) -> DataFrame:
    """Normalized, complete approved rows, before the conflict gate and the dedupe."""
    return (
        approved.select(
            text.normalize_cascade(F.col("description")).alias("description_clean"),
            text.normalize_type(F.col("vch_type")).alias("vch_type_clean"),
            values.to_number(F.col("canonical_id"), "int").alias("canonical_id"),
            text.family_alias(F.col("canonical_family"), aliases).alias("canonical_family"),
        )
        .filter(
            "description_clean <> '' and vch_type_clean <> ''"
            " and canonical_id is not null and canonical_family <> ''"
        )
    )


def approved_lookup(approved: DataFrame, gate: bool = True) -> DataFrame:
    """One row per (description, type); a key with two ids stops the job."""
    keys = ["description_clean", "vch_type_clean"]
    rows = clean_approved(approved)
    if gate and not gates.conflicting_keys(rows, keys, "canonical_id").isEmpty():
        raise gates.GateError("Conflicting approved mappings")
    return first_per_key(rows, keys, [F.col("canonical_family")])


def keyword_family(description: Column, rules: dict[str, Sequence[str]] = lookups.RULE_KEYWORDS) -> Column:
    """The family if exactly one family has a keyword in the text, else NULL."""
    hits = F.concat_ws(
        "|", *[F.when(text.contains_any(description, words), f) for f, words in rules.items()]
    )
    # Only a single hit is a family name; none and several are not.
    return text.map_values(hits, {f: f for f in rules})


def strong_categories(
    dominant: DataFrame,
    min_percentage: float = lookups.STRONG_PERCENTAGE,
    min_mapped: int = lookups.STRONG_MIN_MAPPED,
) -> DataFrame:
    """``(category_id_clean, strong_family)`` of ids that reliably mean one family."""
    return (
        dominant.filter(
            (F.col("dominant_percentage") >= min_percentage) & (F.col("mapped_total") >= min_mapped)
        )
        .select(
            text.normalize_category_id(F.col("category_id_clean")).alias("category_id_clean"),
            text.family_alias(
                F.col("dominant_canonical_family"), lookups.CASCADE_ALIASES
            ).alias("strong_family"),
        )
        .filter(F.col("strong_family").isin(*lookups.TAXONOMY_V2.values()))
    )


def with_approved(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add ``approved_id`` and ``approved_family`` (NULL where no reviewed row matches)."""
    keys = ["description_clean", "vch_type_clean"]
    side = small(
        lookup.select(
            *keys,
            F.col("canonical_id").alias("approved_id"),
            F.col("canonical_family").alias("approved_family"),
        )
    )
    return df.join(side, keys, "left")


def with_strong_category(df: DataFrame, strong: DataFrame) -> DataFrame:
    """Add ``strong_family`` by source category id."""
    return df.join(small(strong), "category_id_clean", "left")


def resolve(df: DataFrame, taxonomy_version: str = "v2") -> DataFrame:
    """Combine the stages: first hit wins, then the family follows from the id.

    Stages that were not joined in are treated as giving nothing.
    """

    def stage(name: str, dtype: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(dtype)

    staged = df.withColumns(
        {
            "approved_id": stage("approved_id", "int"),
            "approved_family": stage("approved_family", "string"),
            "strong_family": stage("strong_family", "string"),
            "ml_family": stage("ml_family", "string"),
            "ml_confidence": stage("ml_confidence", "double"),
            "ml_margin": stage("ml_margin", "double"),
        }
    )
    method = (
        F.when(F.col("approved_family").isNotNull(), "APPROVED_MAPPING")
        .when(F.col("rule_family").isNotNull(), "RULE")
        .when(F.col("strong_family").isNotNull(), "CATEGORY_ID")
        .when(F.col("ml_family").isNotNull(), "ML")
        .otherwise("UNMAPPED")
    )
    family = F.coalesce("approved_family", "rule_family", "strong_family", "ml_family")
    cid = F.when(F.col("approved_family").isNotNull(), F.col("approved_id")).otherwise(
        family_to_id(F.coalesce("rule_family", "strong_family", "ml_family"))
    )
    out = staged.withColumns(
        {
            "mapping_method": method,
            "canonical_id": cid,
            "_family": family,
        }
    )
    forced = forced_family(F.col("canonical_id"), F.col("_family"), taxonomy_version)
    is_ml = F.col("mapping_method") == "ML"
    return out.withColumns(
        {
            "canonical_family": F.coalesce(forced, F.lit("UNMAPPED")),
            "ml_confidence": F.when(is_ml, F.col("ml_confidence")),
            "ml_margin": F.when(is_ml, F.col("ml_margin")),
        }
    ).withColumn(
        "canonical_mapping_status",
        F.when(F.col("canonical_family") == "UNMAPPED", "UNMAPPED").otherwise("MAPPED"),
    ).drop(
        "_family", "rule_family", "approved_id", "approved_family", "strong_family", "ml_family"
    )


def forced_family(cid: Column, family: Column, version: str = "v2") -> Column:
    """The taxonomy's name for the id; the given family where the id is unknown."""
    table = {str(k): v for k, v in lookups.TAXONOMIES[version].items()}
    return F.coalesce(text.map_values(cid.cast("string"), table), family)


def crosswalk_ids(lookup: DataFrame) -> DataFrame:
    """Opt-in repair: move v1 ids of an approved lookup to v2 before applying it."""
    table = {str(k): str(v) for k, v in lookups.CROSSWALK_V1_V2.items()}
    moved = text.map_values(F.col("canonical_id").cast("string"), table).cast("int")
    return lookup.withColumn("canonical_id", F.coalesce(moved, F.col("canonical_id")))


def coverage(categorized: DataFrame) -> DataFrame:
    mapped = F.count_if(F.col("canonical_family") != "UNMAPPED")
    total = F.count(F.lit(1))
    return categorized.agg(
        total.alias("transactions"),
        mapped.alias("mapped"),
        (total - mapped).alias("unmapped"),
        values.share(mapped, total).alias("coverage_pct"),
    )


def counts_by(df: DataFrame, column: str, alias: str = "transaction_count") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(alias)).orderBy(F.desc(alias), column)


def coverage_report(categorized: DataFrame) -> DataFrame:
    """``(section, name, transaction_count, share_pct)`` by method and by family."""
    counts = categorized.groupBy("mapping_method", "canonical_family").agg(
        F.count(F.lit(1)).alias("n")
    )
    # One handful of rows per section: the grouped counts, unpivoted.
    sections = counts.select(
        "n",
        F.inline(
            F.array(
                F.struct(F.lit("method").alias("section"), F.col("mapping_method").alias("name")),
                F.struct(F.lit("family").alias("section"), F.col("canonical_family").alias("name")),
            )
        ),
    )
    return with_share(
        sections.groupBy("section", "name").agg(F.sum("n").alias("transaction_count")),
        "transaction_count",
        "share_pct",
        ["section"],
    )


def with_share(df: DataFrame, count: str, alias: str, keys: Sequence[str]) -> DataFrame:
    """Add each row's percentage of its group; ``df`` is already aggregated."""
    if keys:
        total = F.sum(count).over(Window.partitionBy(*keys))
    else:
        total = df.agg(F.sum(count)).scalar()
    return df.withColumn(alias, values.share(F.col(count), total))


def confidence_report(candidates: DataFrame) -> DataFrame:
    """Distribution of classifier confidence over the evaluated candidates, one row."""
    conf, margin = F.col("ml_confidence"), F.col("ml_margin")
    q25, q50, q75 = exact_quantiles(candidates, "ml_confidence", [0.25, 0.5, 0.75])
    (median_margin,) = exact_quantiles(candidates, "ml_margin", [0.5])
    return candidates.agg(
        F.count(F.lit(1)).alias("candidates"),
        F.min(conf).alias("min_confidence"),
        F.lit(q25).cast("double").alias("q25_confidence"),
        F.lit(q50).cast("double").alias("median_confidence"),
        F.lit(q75).cast("double").alias("q75_confidence"),
        F.round(F.avg(conf), 6).alias("mean_confidence"),
        F.max(conf).alias("max_confidence"),
        F.min(margin).alias("min_margin"),
        F.lit(median_margin).cast("double").alias("median_margin"),
        F.round(F.avg(margin), 6).alias("mean_margin"),
    )


def threshold_counts(candidates: DataFrame, thresholds: Sequence[float] = lookups.REPORT_THRESHOLDS) -> DataFrame:
    """``(threshold, accepted, accepted_pct)``: one conditional aggregate, then unpivoted."""
    one = candidates.agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(F.col("ml_confidence") >= t).alias(f"t{i}")
            for i, t in enumerate(thresholds)
        ],
    )
    return one.select(
        "n",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(t).alias("threshold"), F.col(f"t{i}").alias("accepted"))
                    for i, t in enumerate(thresholds)
                ]
            )
        ),
    ).select(
        "threshold", "accepted", values.share(F.col("accepted"), F.col("n")).alias("accepted_pct")
    )


def accepted_summary(categorized: DataFrame) -> DataFrame:
    return categorized.filter("mapping_method = 'ML'").agg(
        F.count(F.lit(1)).alias("accepted"),
        F.round(F.avg("ml_confidence"), 6).alias("mean_confidence"),
        F.min("ml_confidence").alias("min_confidence"),
        F.max("ml_confidence").alias("max_confidence"),
        F.round(F.avg("ml_margin"), 6).alias("mean_margin"),
    )


# ---------------------------------------------------------------- category ids


def category_family_matrix(categorized: DataFrame) -> DataFrame:
    """Counts and percentages per (category id, family) from reviewed methods only.

    The total rides on the grouped rows, so the fact table is shuffled once and
    only after partial aggregation.
    """
    family = text.strip(F.coalesce("canonical_family", F.lit("UNMAPPED")))
    counts = (
        categorized.filter(
            (family != "UNMAPPED") & F.col("mapping_method").isin(*lookups.RULE_METHODS)
        )
        .groupBy(
            F.coalesce(values.to_number(F.col("category_id"), "double"), F.lit(-1.0)).alias(
                "category_id_clean"
            ),
            family.alias("canonical_family_clean"),
        )
        .agg(F.count(F.lit(1)).alias("transaction_count"))
    )
    total = F.sum("transaction_count").over(Window.partitionBy("category_id_clean"))
    return counts.withColumn("mapped_total", total).withColumn(
        "percentage", F.col("transaction_count") / F.col("mapped_total") * 100
    )


def dominant_family(matrix: DataFrame) -> DataFrame:
    """The largest family per category id; the alphabetically first wins a tie."""
    best = F.min_by(
        F.struct("canonical_family_clean", "transaction_count", "mapped_total", "percentage"),
        F.struct((-F.col("transaction_count")).alias("c"), F.col("canonical_family_clean").alias("f")),
    )
    return (
        matrix.groupBy("category_id_clean")
        .agg(best.alias("b"))
        .select(
            "category_id_clean",
            F.col("b.canonical_family_clean").alias("dominant_canonical_family"),
            F.col("b.transaction_count").alias("dominant_count"),
            F.col("b.mapped_total").alias("mapped_total"),
            F.col("b.percentage").alias("dominant_percentage"),
        )
    )


def strength_tier(percentage: Column) -> Column:
    return (
        F.when(percentage >= 95, "STRONG")
        .when(percentage >= 80, "MODERATE")
        .when(percentage >= 60, "WEAK")
        .otherwise("AMBIGUOUS")
    )


def with_strength(dominant: DataFrame) -> DataFrame:
    return dominant.withColumn("mapping_strength", strength_tier(F.col("dominant_percentage")))


def potential_coverage(categorized: DataFrame, dominant: DataFrame) -> DataFrame:
    """``(family, transaction_count, pct_of_all)``: unmapped rows a STRONG id would map.

    Unmapped rows are counted per category id first; only those counts meet the id table.
    """
    per_id = categorized.groupBy(
        F.coalesce(values.to_number(F.col("category_id"), "double"), F.lit(-1.0)).alias(
            "category_id_clean"
        )
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("canonical_family") == "UNMAPPED").alias("unmapped"),
    )
    total = per_id.agg(F.sum("n")).scalar()
    strong = with_strength(dominant).filter("mapping_strength = 'STRONG'")
    return (
        per_id.join(
            strong.select("category_id_clean", "dominant_canonical_family"), "category_id_clean"
        )
        .groupBy(F.col("dominant_canonical_family").alias("canonical_family"))
        .agg(F.sum("unmapped").alias("transaction_count"))
        .filter("transaction_count > 0")
        .select(
            "canonical_family",
            "transaction_count",
            values.share(F.col("transaction_count"), total).alias("pct_of_all"),
        )
    )


def canonical_category(
    labelled: DataFrame, mapping: DataFrame, rules: DataFrame
) -> DataFrame:
    """Approved (text, category) id, else the original id; a (text, type) rule overrides both."""
    approved = mapping.filter(F.lower(F.col("approved").cast("string")) == "true").select(
        F.col("normalized_description").alias("clean_description"),
        "source_category_id",
        F.col("canonical_category_id").cast("long").alias("_mapped"),
    )
    by_type = contextual_lookup(rules).withColumnRenamed("contextual_category", "_ruled")
    return (
        labelled.join(small(approved), ["clean_description", "source_category_id"], "left")
        .join(small(by_type), ["clean_description", "vch_type"], "left")
        .withColumn(
            "canonical_category", F.coalesce("_ruled", "_mapped", F.col("source_category_id"))
        )
        .drop("_ruled", "_mapped")
    )


def contextual_lookup(rules: DataFrame) -> DataFrame:
    return rules.filter(F.lower(F.col("approved").cast("string")) == "true").select(
        F.col("normalized_description").alias("clean_description"),
        "vch_type",
        F.col("canonical_category_id").cast("long").alias("contextual_category"),
    )
