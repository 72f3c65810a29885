"""Taxonomy lookups and keyword proposals for human review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.functions import text, values

PROPOSAL_KEYS = ["proposed_family", "description", "vch_type"]


def id_to_family(col: Column, version: str = "v2") -> Column:
    """Family name of an id; bad ids give NULL."""
    table = {str(k): v for k, v in lookups.TAXONOMIES[version].items()}
    return text.map_values(values.to_number(col, "bigint").cast("string"), table)


def family_to_id(col: Column, version: str = "v2") -> Column:
    """Id of a family name, case-insensitively."""
    table = {v.lower(): str(k) for k, v in lookups.TAXONOMIES[version].items()}
    return text.map_values(F.lower(text.strip(col)), table).cast("int")


def propose_family(description: Column, kind: Column) -> Column:
    """One family for a normalized description, or AMBIGUOUS / Unassigned.

    Transfer and Income rows are first tested for their own terms; all other
    decisions need exactly one matching family.
    """
    terms = lookups.PROPOSAL_TERMS
    general = [f for f in terms if f not in ("Transfers", "Income")]
    hits = F.array_compact(
        F.array(*[F.when(text.contains_term_any(description, terms[f]), f) for f in general])
    )
    return (
        F.when(
            (kind == "Transfer") & text.contains_term_any(description, terms["Transfers"]),
            "Transfers",
        )
        .when((kind == "Income") & text.contains_term_any(description, terms["Income"]), "Income")
        .when(F.size(hits) == 1, F.element_at(hits, 1))
        .when(F.size(hits) > 1, "AMBIGUOUS")
        .otherwise("Unassigned")
    )


def risk_tier(support: Column, purity: Column) -> Column:
    return (
        F.when((support >= 10) & (purity >= 0.95), "SAFE_CANDIDATE")
        .when((support >= 5) & (purity >= 0.80), "REVIEW_CANDIDATE")
        .otherwise("WEAK_CANDIDATE")
    )


def risk_rank(tier: Column) -> Column:
    return F.when(tier == "SAFE_CANDIDATE", 0).when(tier == "REVIEW_CANDIDATE", 1).otherwise(2)


def proposed(labelled: DataFrame) -> DataFrame:
    """Labelled rows with a proposed family, only where there is one."""
    return (
        values.computed_once(
            labelled,
            {"proposed_family": propose_family(F.col("clean_description"), F.col("vch_type"))},
        )
        .filter(~F.col("proposed_family").isin("Unassigned", "AMBIGUOUS"))
        .withColumnRenamed("clean_description", "description")
    )


def proposal_groups(labelled: DataFrame) -> DataFrame:
    """One proposal per (family, description, type) with its evidence.

    Counted per source category first, so a description that fills a third of
    the table is already a handful of rows when its group is formed.
    """
    counts = (
        proposed(labelled)
        .groupBy(*PROPOSAL_KEYS, "source_category_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    groups = counts.groupBy(*PROPOSAL_KEYS).agg(
        F.sum("n").alias("transaction_support"),
        # Most frequent category; the smaller id wins a tie.
        F.max(F.struct(F.col("n"), (-F.col("source_category_id")).alias("c"))).alias("top"),
        F.count(F.lit(1)).alias("distinct_source_category_ids"),
    )
    purity = F.round(F.col("top.n") / F.col("transaction_support"), 4)
    synonym = F.coalesce(text.map_values(F.col("description"), lookups.SYNONYMS), F.lit(""))
    return groups.select(
        "description",
        "vch_type",
        "proposed_family",
        text.map_values(
            F.col("proposed_family"), {k: str(v) for k, v in lookups.PROPOSAL_IDS.items()}
        )
        .cast("int")
        .alias("proposed_canonical_id"),
        "transaction_support",
        (-F.col("top.c")).alias("dominant_source_category_id"),
        "distinct_source_category_ids",
        purity.alias("source_category_purity"),
        F.lit("REVIEW_REQUIRED").alias("review_status"),
        F.lit(False).alias("approved"),
        F.lit(lookups.PROPOSAL_NOTE).alias("evidence_note"),
        risk_tier(F.col("transaction_support"), purity).alias("risk_level"),
        synonym.alias("possible_synonym"),
        F.when(synonym != "", lookups.SYNONYM_NOTE).otherwise("").alias("synonym_review_note"),
    )


def review_order(proposals: DataFrame) -> DataFrame:
    """Safest first, then by support and purity."""
    return proposals.orderBy(
        risk_rank(F.col("risk_level")),
        F.desc("transaction_support"),
        F.desc("source_category_purity"),
        "description",
        "vch_type",
    )


def family_summary(proposals: DataFrame) -> DataFrame:
    tiers = {
        "safe_candidates": "SAFE_CANDIDATE",
        "review_candidates": "REVIEW_CANDIDATE",
        "weak_candidates": "WEAK_CANDIDATE",
    }
    return (
        proposals.groupBy("proposed_family")
        .agg(
            F.count(F.lit(1)).alias("proposals"),
            F.sum("transaction_support").alias("total_transactions"),
            F.sum("distinct_source_category_ids").alias("distinct_source_categories"),
            F.median("source_category_purity").alias("median_purity"),
            *[F.count_if(F.col("risk_level") == t).alias(n) for n, t in tiers.items()],
        )
        .orderBy(F.desc("total_transactions"))
    )
