"""End-to-end jobs: batch load, mapping with its training loop, evaluation, incremental load.

Each job is one declarative plan per output; tables that several outputs read
are written once to the shared folder, which also cuts lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import lookups, schemas
from tallyspark.functions import values
from tallyspark.operators import (
    cascade,
    classifier,
    clean,
    evaluate,
    evidence,
    gates,
    incremental,
    quality,
    similarity,
    training,
    views,
)
from tallyspark.operators.lookup import lookup
from tallyspark.session import materialized
from tallyspark.sources import sinks


def etl_status(source: DataFrame, target: DataFrame) -> DataFrame:
    return sinks.count_status(target, source)


def batch_load(
    raw: DataFrame, table: sinks.KeyedTable, as_of: Column, log_path: str | None = None
) -> DataFrame:
    """Gate, clean, flag and upsert raw rows; returns the status row.

    The raw rows are typed once: the gate, the load and the status read what was written.
    """
    gates.require_columns(raw, schemas.RAW_COLUMNS)
    rows = materialized(clean.to_production(raw, as_of), "production")
    gates.require_unique_key(rows, "voucher_id")
    table.upsert(rows, [F.col("source_id")])
    status = etl_status(rows, table.read())
    if log_path:
        row = sinks.log_row(
            "ETL_LOAD",
            F.col("status"),
            F.col("source_count"),
            F.abs("difference"),
            "Batch load reconciliation.",
            F.current_timestamp(),
        )
        sinks.append_log(status.select(*row), log_path, only_if_present=True)
    return status


def incremental_load(raw: DataFrame, table: sinks.KeyedTable, as_of: Column) -> DataFrame:
    """Insert rows with unseen keys; returns the reconciliation row."""
    gates.require_columns(raw, schemas.RAW_COLUMNS)
    keys = raw.select(values.to_number(F.col("voucher_id"), "bigint").alias("voucher_id")).filter("voucher_id is not null").distinct()
    known, _ = table.known(materialized(keys.withColumn("_bucket", table.bucket()), "keys"))
    detected = materialized(incremental.detect_new(raw, known), "detected")
    table.insert_ignore(incremental.transform_new(detected, as_of), [F.col("source_id")])
    return incremental.reconcile(detected, table.read())


def staged(raw: DataFrame, approved: DataFrame) -> DataFrame:
    """Raw rows with their normalized columns and what the approved map and the keyword rules say."""
    return cascade.with_approved(cascade.clean_inputs(raw), cascade.approved_lookup(approved))


def first_pass(raw: DataFrame, approved: DataFrame) -> DataFrame:
    """Approved map and keyword rules only: what the category table and the model learn from."""
    return cascade.resolve(staged(raw, approved))


def category_table(categorized: DataFrame) -> DataFrame:
    """Dominant family per category id with its strength, as a written table."""
    dominant = cascade.dominant_family(cascade.category_family_matrix(categorized))
    return materialized(cascade.with_strength(dominant), "dominant")


def full_pass(
    raw: DataFrame,
    approved: DataFrame,
    dominant: DataFrame,
    model: classifier.TextModel | None = None,
) -> DataFrame:
    """The whole cascade.  ``dominant`` is a written table; the model is optional."""
    return second_pass(staged(raw, approved), dominant, model)


def second_pass(rows: DataFrame, dominant: DataFrame, model: classifier.TextModel | None = None) -> DataFrame:
    """The whole cascade from ``staged`` rows, which are a written table where a model joins in.

    Predictions are made once per distinct open text and joined back by text.  A family outside the taxonomy stops the job.
    """
    rows = cascade.with_strong_category(rows, cascade.strong_categories(dominant))
    if model is not None:
        rows = lookup(rows, materialized(model_decisions(rows, model), "decisions"), "description_clean")
    return gates.checked_families(cascade.resolve(rows))


def categorize(raw: DataFrame, approved: DataFrame) -> DataFrame:
    """Both passes without a model; raw rows are cleaned and matched once."""
    rows = materialized(staged(raw, approved), "staged")
    return second_pass(rows, category_table(cascade.resolve(rows)))


def model_decisions(staged: DataFrame, model: classifier.TextModel) -> DataFrame:
    """``(description_clean, ml_family, ml_confidence, ml_margin)`` of the texts no earlier stage settled."""
    open_texts = (
        staged.filter(
            "approved_family is null and strong_family is null and rule_family is null"
            " and description_clean <> ''"
        )
        .select(F.col("description_clean").alias("text"))
        .distinct()
    )
    scored = evaluate.top2(classifier.probabilities(model, open_texts))
    return classifier.accepted_families(scored).withColumnRenamed("text", "description_clean")


@dataclass
class Mapping:
    categorized: DataFrame
    dominant: DataFrame
    training: DataFrame
    model: classifier.TextModel


def map_transactions(
    raw: DataFrame, approved: DataFrame, model_path: str | None = None, validation: DataFrame | None = None
) -> Mapping:
    """Bootstrap: first pass -> category table and model -> full cascade.

    Raw rows are cleaned and matched once.  ``validation`` holds human-validated rows; their labels train the model as well.
    """
    rows = materialized(staged(raw, approved), "staged")
    pass1 = cascade.resolve(rows)
    dominant = category_table(pass1)
    labels = [training.trusted_rows(pass1)]
    if validation is not None:
        labels.append(training.validated_rows(validation))
    train = materialized(training.training_set(training.labelled_union(labels)), "training")
    learned = classifier.training_rows(train)
    if model_path:
        model = classifier.load_or_fit(raw.sparkSession, model_path, learned)
    else:
        model = classifier.fit(learned)
    return Mapping(second_pass(rows, dominant, model), dominant, train, model)


def evaluate_evidence(
    train: DataFrame, test: DataFrame, clusters: DataFrame, rules: DataFrame, k: int = 5
) -> DataFrame:
    """Detail table of the evidence engine on held-out rows.

    ``train`` and ``test`` are sane labelled rows.  All evidence is computed
    per distinct text and joined to the rows at the end.
    """
    history = materialized(
        evidence.fit_history(train, category="source_category_id"), "history"
    )
    references = history.select(F.col("clean_description").alias("reference"), "category", "purity")
    texts = materialized(test.select("clean_description").distinct(), "texts")
    near = similarity.nearest_texts(
        texts.select(F.col("clean_description").alias("text")),
        references.select(F.col("reference").alias("text")),
        k,
    )
    sem = similarity.vote(near, references).withColumnRenamed("query", "clean_description")
    boosts = evidence.cluster_boost(texts, materialized(evidence.strong_clusters(clusters), "clusters"))
    per_text = materialized(
        evidence.with_history(texts, history)
        .join(sem, "clean_description", "left")
        .join(boosts, "clean_description", "left"),
        "evidence",
    )
    rows = lookup(materialized(evidence.with_context(test, rules), "context"), per_text, "clean_description")
    detail = rows.withColumn("true_category", F.col("source_category_id"))
    return evidence.scored(evidence.combine(detail))


def build_views(production: DataFrame, categorized: DataFrame, root: str | None = None) -> list[str]:
    """Register the analytics views; write them as tables if a folder is given."""
    names = views.register_views(production, views.categorization_rows(categorized))
    if root:
        views.materialize_views(production.sparkSession, names, root)
    return names


def validate(table: DataFrame, as_of: Column, log_path: str | None = None) -> DataFrame:
    """All checks in long form; optionally logs the overall status."""
    checks = quality.validate_table(table, as_of)
    if log_path:
        status = quality.overall_status(checks)
        row = sinks.log_row(
            "TABLE_DATA_QUALITY",
            F.col("check_status"),
            F.col("records_checked"),
            F.col("records_failed"),
            "Transaction table validation.",
            F.current_timestamp(),
        )
        sinks.append_log(status.select(*row), log_path)
    return checks
