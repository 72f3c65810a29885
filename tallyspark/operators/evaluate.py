"""Scores over stored class probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.functions.quantiles import exact_quantiles
from tallyspark.functions.text import normalize_ml
from tallyspark.functions import values
from tallyspark.functions.values import share
from tallyspark.operators.cascade import with_share

# Rule methods whose rows need no prediction.
TRUSTED_SHOPPING = (
    "REFINED_SHOPPING_EXPENSE", "REFINED_SHOPPING_TRANSFER", "REFINED_SHOPPING_INCOME",
)


def top2(df: DataFrame, single_class_repeats: bool = False) -> DataFrame:
    """Add prediction, confidence, second_prediction, second_confidence and margin.

    Equal probabilities go to the class that comes first.  With one class the
    second is absent with probability 0, or repeats the first on request.
    """
    ranked = F.array_sort(
        F.transform(
            F.arrays_zip("probabilities", "classes"),
            lambda x, i: F.struct((-x["probabilities"]).alias("m"), i.alias("i"), x["classes"].alias("c")),
        )
    )
    only = F.size("_r") < 2
    first, second = F.element_at("_r", 1), F.try_element_at("_r", F.lit(2))
    spare = first if single_class_repeats else F.lit(None)
    second_p = F.when(only, -first["m"] if single_class_repeats else F.lit(0.0)).otherwise(-second["m"])
    second_c = F.when(only, spare["c"] if single_class_repeats else F.lit(None)).otherwise(second["c"])
    return values.computed_once(
        df.withColumn("_r", ranked),
        {
            "prediction": first["c"],
            "confidence": -first["m"],
            "second_prediction": second_c,
            "second_confidence": second_p,
            "margin": -first["m"] - second_p,
        },
    ).drop("_r")


def threshold_grid(
    df: DataFrame,
    confidences: Sequence[float] = lookups.CONFIDENCE_GRID,
    margins: Sequence[float] = lookups.MARGIN_GRID,
) -> DataFrame:
    """Accepted rows, coverage and accuracy for every threshold pair.

    Rows are counted once per (confidence step, margin step) cell; the grid is
    then summed over those few cells, not over the rows.
    """

    def steps(col: Column, limits: Sequence[float]) -> Column:
        reached = F.lit(0)
        for limit in limits:
            reached = reached + F.when(col >= limit, 1).otherwise(0)
        return reached

    cells = df.groupBy(
        steps(F.col("confidence"), confidences).alias("c"),
        steps(F.col("margin"), margins).alias("m"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("prediction") == F.col("actual")).alias("right"),
    )
    points = F.array(
        *[
            F.struct(
                F.lit(c).alias("confidence_threshold"),
                F.lit(m).alias("margin_threshold"),
                (F.col("c") > i).alias("c_ok"),
                (F.col("m") > j).alias("m_ok"),
            )
            for i, c in enumerate(confidences)
            for j, m in enumerate(margins)
        ]
    )
    hit = F.col("c_ok") & F.col("m_ok")
    accepted = F.sum(F.when(hit, F.col("n")).otherwise(0))
    right = F.sum(F.when(hit, F.col("right")).otherwise(0))
    return (
        cells.select("n", "right", F.inline(points))
        .groupBy("confidence_threshold", "margin_threshold")
        .agg(
            accepted.alias("accepted_predictions"),
            F.round(share(accepted, F.sum("n")), 2).alias("coverage_pct"),
            F.round(share(right, accepted), 2).alias("accepted_accuracy_pct"),
        )
    )


def recommend(grid: DataFrame, target: float = 95.0) -> DataFrame:
    """The widest point that reaches the target accuracy, else the most accurate point."""
    valid = F.coalesce(F.col("accepted_accuracy_pct") >= target, F.lit(False))
    coverage, accuracy = F.col("coverage_pct"), F.col("accepted_accuracy_pct")
    order = F.struct(
        valid.alias("v"),
        F.when(valid, coverage).otherwise(accuracy).alias("a"),
        F.when(valid, accuracy).otherwise(coverage).alias("b"),
        # Remaining ties: the lower thresholds.
        (-F.col("confidence_threshold")).alias("c"),
        (-F.col("margin_threshold")).alias("m"),
    )
    best = grid.filter(F.col("accepted_accuracy_pct").isNotNull()).agg(
        F.max_by(F.struct(*grid.columns, valid.alias("reaches_target")), order).alias("best")
    )
    return best.filter("best is not null").select("best.*")


def confusion_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("actual", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per actual label that occurs, one column per label, absent pairs 0."""
    return (
        confusion_counts(df)
        .groupBy("actual")
        .pivot("prediction", list(labels))
        .agg(F.sum("n"))
        .fillna(0)
    )


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class from ``(actual, prediction, n)``.

    Rows ``accuracy``, ``macro avg`` and ``weighted avg`` close the report.
    """
    sides = counts.select(
        "n",
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("label"), F.lit("actual").alias("side")),
                F.struct(F.col("prediction").alias("label"), F.lit("predicted").alias("side")),
            )
        ),
        (F.col("actual") == F.col("prediction")).alias("hit"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    is_actual = F.col("side") == "actual"
    per_class = (
        sides.groupBy("label")
        .agg(
            total(is_actual & F.col("hit")).alias("tp"),
            total(is_actual).alias("support"),
            total(~is_actual).alias("predicted"),
        )
        .withColumns(
            {
                "precision": ratio(F.col("tp"), F.col("predicted")),
                "recall": ratio(F.col("tp"), F.col("support")),
            }
        )
        .withColumn(
            "f1_score",
            ratio(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
        )
    )
    scores = ["precision", "recall", "f1_score"]
    n = F.sum("support")
    summary = per_class.agg(
        F.struct(
            F.lit("accuracy").alias("label"),
            *[ratio(F.sum("tp"), n).alias(s) for s in scores],
            n.alias("support"),
        ).alias("accuracy"),
        F.struct(
            F.lit("macro avg").alias("label"),
            *[F.avg(s).alias(s) for s in scores],
            n.alias("support"),
        ).alias("macro"),
        F.struct(
            F.lit("weighted avg").alias("label"),
            *[(F.sum(F.col(s) * F.col("support")) / n).alias(s) for s in scores],
            n.alias("support"),
        ).alias("weighted"),
    ).select(F.inline(F.array("accuracy", "macro", "weighted")))
    return per_class.select("label", *scores, "support").unionByName(summary)


def confidence_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.round(F.avg("confidence"), 6).alias("mean_confidence"),
        F.min("confidence").alias("min_confidence"),
        F.max("confidence").alias("max_confidence"),
        F.round(F.avg("margin"), 6).alias("mean_margin"),
        F.round(
            share(F.count_if(F.col("prediction") == F.col("actual")), F.count(F.lit(1))), 6
        ).alias("accuracy_pct"),
    )


# ------------------------------------------------------------- unresolved rows


def prediction_candidates(rows: DataFrame) -> DataFrame:
    """Rows that still need a prediction: not settled by a trusted rule, text not blank."""
    return rows.withColumn("ml_description", normalize_ml(F.col("vch_desc"))).filter(
        ~F.coalesce("refined_rule_method", F.lit("")).isin(*TRUSTED_SHOPPING)
        & (F.col("ml_description") != "")
    )


def confidence_bucket(confidence: Column) -> Column:
    return (
        F.when(confidence >= 0.90, "HIGH_CONFIDENCE")
        .when(confidence >= 0.70, "MEDIUM_CONFIDENCE")
        .when(confidence >= 0.50, "LOW_CONFIDENCE")
        .otherwise("VERY_LOW_CONFIDENCE")
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Value counts with each value's percentage of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts, "count", "percentage", [])


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles, max: exact."""
    c = F.col(column)
    p25, p50, p75 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    return df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev(c).alias("std"),
        F.min(c).alias("min"),
        F.lit(p25).cast("double").alias("p25"),
        F.lit(p50).cast("double").alias("p50"),
        F.lit(p75).cast("double").alias("p75"),
        F.max(c).alias("max"),
    )


def least_confident(df: DataFrame, key: str, n: int = 30) -> DataFrame:
    return df.orderBy("confidence", key).limit(n)


def first_confident(df: DataFrame, key: str, n: int = 30) -> DataFrame:
    return df.filter(F.col("confidence") >= 0.90).orderBy(key).limit(n)
