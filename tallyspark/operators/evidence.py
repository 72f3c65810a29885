"""The evidence engine: history, similarity, clusters and context -> category, confidence, decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import values
from tallyspark.functions.values import share
from tallyspark.operators.cascade import contextual_lookup, small
from tallyspark.operators.lookup import lookup
from tallyspark.session import materialized

# Engine constants.
AUTO_ABOVE = 0.90
REVIEW_ABOVE = 0.70
SUPPORT_SATURATION = 5
AGREEMENT_BONUS = 0.15
CONFIDENCE_CEILING = 0.99
CLUSTER_BOOST = 0.07
MIN_CLUSTER_PURITY = 0.60
MIN_CLUSTER_SIZE = 20


def fit_history(labelled: DataFrame, text: str = "clean_description", category: str = "category") -> DataFrame:
    """``(text, category, purity, support)``: the usual category of every non-empty text.

    Counted per (text, category) first: a text that fills a third of the table
    shrinks to its distinct categories before its group is formed.
    """
    counts = (
        labelled.filter(F.col(text) != "")
        .groupBy(text, category)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        counts.groupBy(text)
        .agg(
            F.max(F.struct(F.col("n"), (-F.col(category)).alias("c"))).alias("top"),
            F.sum("n").alias("support"),
        )
        .select(
            text,
            (-F.col("top.c")).alias("category"),
            (F.col("top.n") / F.col("support")).alias("purity"),
            "support",
        )
    )


def label_fragmentation(labelled: DataFrame, text: str = "clean_description", category: str = "category") -> DataFrame:
    """Occurrences, distinct categories and the top category's share per text."""
    counts = (
        labelled.filter(F.col(text) != "")
        .groupBy(text, category)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy(text).agg(
        F.sum("n").alias("occurrences"),
        F.count(F.lit(1)).alias("distinct_categories"),
        (F.max("n") / F.sum("n")).alias("top_share"),
    )


def with_history(df: DataFrame, history: DataFrame, text: str = "clean_description") -> DataFrame:
    """Add hist_category, hist_purity, hist_support; unseen texts get (NULL, 0, 0)."""
    table = history.select(
        text,
        F.col("category").alias("hist_category"),
        F.col("purity").alias("hist_purity"),
        F.col("support").alias("hist_support"),
    )
    return lookup(df, table, text).fillna(
        {"hist_purity": 0.0, "hist_support": 0}
    )


# --------------------------------------------------------------------------- clusters


def parse_top_descriptions(col: Column) -> Column:
    """``"petrol (40) | diesel (5)"`` -> array of (description, count); bad items are skipped."""
    items = F.transform(F.split(col, r" \| "), F.trim)
    pattern = r"^(.*) \(([^()]*)\)*$"
    pairs = F.transform(
        items,
        lambda item: F.struct(
            F.trim(F.regexp_extract(item, pattern, 1)).alias("description"),
            F.trim(F.regexp_extract(item, pattern, 2)).try_cast("int").alias("count"),
        ),
    )
    return F.coalesce(
        F.filter(pairs, lambda p: p["count"].isNotNull()),
        F.array().cast("array<struct<description:string,count:int>>"),
    )


def strong_clusters(
    clusters: DataFrame,
    order: str = "ord",
    normalize=lambda c: c,
    min_size: int = MIN_CLUSTER_SIZE,
    min_purity: float = MIN_CLUSTER_PURITY,
) -> DataFrame:
    """``(term, cluster_id, purity_proxy, cluster_size, position)`` of trustworthy clusters.

    Two clusters with one term: the later row gives the values, the earlier its position.
    """
    total = F.aggregate("pairs", F.lit(0), lambda acc, p: acc + p["count"])
    parsed = (
        clusters.filter("discovered_cluster <> -1")
        .withColumn("pairs", parse_top_descriptions(F.col("top_descriptions")))
        .filter(F.size("pairs") > 0)
        .withColumn("top", F.try_element_at("pairs", F.lit(1)))
        .withColumn("proxy", F.coalesce(F.try_divide(F.col("top.count"), total), F.lit(0.0)))
        .withColumn("term", normalize(F.col("top.description")))
        .filter(
            (F.col("cluster_size") >= min_size) & (F.col("proxy") >= min_purity) & (F.col("term") != "")
        )
    )
    return (
        parsed.groupBy("term")
        .agg(
            F.max_by(F.struct("discovered_cluster", "proxy", "cluster_size"), order).alias("last"),
            F.min(order).alias("position"),
        )
        .select(
            "term",
            F.col("last.discovered_cluster").cast("int").alias("cluster_id"),
            F.round("last.proxy", 3).alias("purity_proxy"),
            F.col("last.cluster_size").cast("long").alias("cluster_size"),
            "position",
        )
    )


def word_runs(col: Column, longest: int) -> Column:
    """All runs of 1..longest consecutive words of a blank-separated text, without repeats."""
    words = F.filter(F.split(col, " "), lambda w: w != "")
    none = F.array().cast("array<string>")

    def of_length(n: int) -> Column:
        return F.when(
            F.size(words) >= n,
            F.transform(
                F.sequence(F.lit(1), F.size(words) - (n - 1)),
                lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "),
            ),
        ).otherwise(none)

    return F.array_distinct(F.concat(*[of_length(n) for n in range(1, longest + 1)]))


def contained_terms(texts: DataFrame, terms: DataFrame, text: str = "clean_description") -> DataFrame:
    """Every (text, term row) where the term is a whole word run of the text: an equi-join on runs."""
    terms = materialized(terms, "terms")
    longest = terms.agg(F.max(F.size(F.split("term", " ")))).first()[0] or 1
    runs = texts.select(text, F.explode(word_runs(F.col(text), longest)).alias("term"))
    return runs.join(terms, "term")


def cluster_boost(texts: DataFrame, strong: DataFrame, text: str = "clean_description") -> DataFrame:
    """``(text, cluster_boost, cluster_match_id)`` for distinct texts: the first strong term wins.

    Both inputs are written, as each is read twice.
    """
    texts = materialized(texts, "boost-texts")
    hits = (
        contained_terms(texts, strong, text)
        .groupBy(text)
        .agg(F.min_by("cluster_id", "position").alias("cluster_match_id"))
    )
    return (
        texts.join(hits, text, "left")
        .withColumn(
            "cluster_boost", F.when(F.col("cluster_match_id").isNotNull(), CLUSTER_BOOST).otherwise(0.0)
        )
        .select(text, "cluster_boost", "cluster_match_id")
    )


def with_context(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Add contextual_category by (text, type)."""
    return df.join(small(contextual_lookup(rules)), ["clean_description", "vch_type"], "left")


# --------------------------------------------------------------------------- decision


def combine(df: DataFrame) -> DataFrame:
    """One category, confidence and evidence source per row.

    Needs hist_*, sem_*, cluster_* and optionally contextual_category columns.
    """
    if "contextual_category" not in df.columns:
        df = df.withColumn("contextual_category", F.lit(None).cast("long"))
    context = F.col("contextual_category")
    hist, sem = F.col("hist_category"), F.col("sem_category")
    has_hist = hist.isNotNull() & (F.col("hist_support") >= 1)
    has_sem = sem.isNotNull()
    factor = F.least(F.col("hist_support"), F.lit(SUPPORT_SATURATION)) / SUPPORT_SATURATION
    hist_conf = F.when(has_hist, F.col("hist_purity") * factor).otherwise(0.0)
    sem_conf = F.when(has_sem, F.col("sem_confidence")).otherwise(0.0)
    agreed = F.least(F.greatest(hist_conf, sem_conf) + AGREEMENT_BONUS, F.lit(CONFIDENCE_CEILING))

    def result(category: Column, confidence: Column, source: str) -> Column:
        return F.struct(
            category.cast("long").alias("category"),
            confidence.cast("double").alias("confidence"),
            F.lit(source).alias("source"),
        )

    chosen = (
        F.when(context.isNotNull(), result(context, F.lit(CONFIDENCE_CEILING), "contextual_rule"))
        .when(has_hist & has_sem & (hist == sem), result(hist, agreed, "historical+semantic_agree"))
        .when(has_hist & (hist_conf >= sem_conf), result(hist, hist_conf, "historical"))
        .when(has_sem, result(sem, sem_conf, "semantic"))
        .otherwise(result(F.lit(None), F.lit(0.0), "none"))
    )
    boosted = F.col("_c.category").isNotNull() & (F.coalesce("cluster_boost", F.lit(0.0)) > 0)
    confidence = F.when(
        boosted, F.least(F.col("_c.confidence") + F.col("cluster_boost"), F.lit(CONFIDENCE_CEILING))
    ).otherwise(F.col("_c.confidence"))
    return (
        df.withColumn("_c", chosen)
        .withColumns(
            {
                "predicted_category": F.col("_c.category"),
                "confidence": F.round(confidence, 4),
                "evidence_source": F.when(boosted, F.concat("_c.source", F.lit("+cluster"))).otherwise(
                    F.col("_c.source")
                ),
            }
        )
        .drop("_c")
        .withColumn("decision", decide(F.col("confidence"), F.col("predicted_category")))
    )


def decide(confidence: Column, category: Column, right_closed: bool = True) -> Column:
    """Route by confidence.  With ``right_closed`` the limits themselves fall below."""
    above = (lambda t: confidence > t) if right_closed else (lambda t: confidence >= t)
    return (
        F.when(category.isNull(), "UNKNOWN")
        .when(above(AUTO_ABOVE), "AUTO_CATEGORIZE")
        .when(above(REVIEW_ABOVE), "REVIEW")
        .otherwise("UNKNOWN")
    )


def scored(detail: DataFrame) -> DataFrame:
    """Mark correct predictions; a missing prediction is wrong."""
    return detail.withColumn(
        "correct", values.flag(F.col("predicted_category") == F.col("true_category"))
    )


def evaluation_overall(detail: DataFrame) -> DataFrame:
    rows = F.count(F.lit(1))
    return detail.agg(
        rows.alias("test_rows"),
        F.round(share(F.count("predicted_category"), rows), 2).alias("coverage_attempted_pct"),
        F.round(share(F.count_if("correct"), rows), 2).alias("accuracy_pct"),
    )


def evaluation_by_decision(detail: DataFrame) -> DataFrame:
    """Count, share and accuracy per decision; UNKNOWN has no accuracy."""
    counts = detail.groupBy("decision").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("correct").alias("right")
    )
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.select(
        "decision",
        "row_count",
        F.round(share(F.col("row_count"), total), 2).alias("pct_of_test_set"),
        F.when(
            F.col("decision") != "UNKNOWN", F.round(share(F.col("right"), F.col("row_count")), 2)
        ).alias("accuracy_pct"),
    )


def evidence_breakdown(detail: DataFrame) -> DataFrame:
    return detail.groupBy("evidence_source").agg(F.count(F.lit(1)).alias("row_count"))
