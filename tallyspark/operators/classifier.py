"""Text classifier: word TF-IDF and multinomial logistic regression.

Fitting uses MLlib on the capped training set.  The fitted model is two small
tables: term -> idf and one weight per class, and the intercepts.  Scoring is a
join of the words of each distinct text with the term table, all in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark import lookups
from tallyspark.functions.text import classifier_tokens, family_alias, normalize_ml
from tallyspark.operators.cascade import small
from tallyspark.operators.similarity import idf_table, unit_weights
from tallyspark.session import materialized
from tallyspark.sources.sinks import path_exists

MAX_DF = 0.98
# Rows per partition while fitting: the capped set is small, many tiny tasks only cost time.
FIT_ROWS = 5_000


@dataclass
class TextModel:
    """``terms``: term, idf, coefficients; ``classes``: class names with intercepts, by name."""

    terms: DataFrame
    classes: list[str]
    intercepts: list[float]

    def save(self, path: str) -> None:
        spark = self.terms.sparkSession
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        rows = [(i, c, b) for i, (c, b) in enumerate(zip(self.classes, self.intercepts))]
        spark.createDataFrame(rows, "idx int, class string, intercept double").coalesce(
            1
        ).write.mode("overwrite").parquet(f"{path}/classes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextModel:
        # One row per class.
        rows = (
            spark.read.schema("idx int, class string, intercept double")
            .parquet(f"{path}/classes")
            .orderBy("idx")
            .collect()
        )
        terms = spark.read.schema("gram string, idf double, coefficients array<double>").parquet(
            f"{path}/terms"
        )
        return TextModel(terms, [r["class"] for r in rows], [r.intercept for r in rows])


def training_rows(training: DataFrame) -> DataFrame:
    """``(row_id, text, label)`` ready for fitting: aliased families, no empty texts."""
    return training.select(
        F.col("normalized_desc").alias("row_id"),
        normalize_ml(F.col("vch_desc")).alias("text"),
        family_alias(F.col("canonical_family"), lookups.CLASSIFIER_ALIASES).alias("label"),
    ).filter("text <> '' and label <> ''")


def token_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    return (
        texts.select(key, F.explode(classifier_tokens(F.col(text))).alias("gram"))
        .groupBy(key, "gram")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def sublinear():
    return F.log(F.col("tf").cast("double")) + 1.0


def class_weights(rows: DataFrame) -> DataFrame:
    """Add the balanced weight n / (classes * class size)."""
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()
    return rows.join(
        F.broadcast(counts.select("label", (total / F.col("n")).alias("weight"))), "label"
    )


def fit(rows: DataFrame, max_iter: int = 2000) -> TextModel:
    """Fit on ``(row_id, text, label)``; the input is the capped training set."""
    spark = rows.sparkSession
    rows = materialized(rows, "classifier-rows")
    counts = token_counts(rows, "row_id", "text")
    size = rows.agg(F.count(F.lit(1))).scalar()
    idf = idf_table(counts, size).filter(F.col("df") <= size * MAX_DF)
    # The vocabulary of the capped training set; one dense index per term.
    vocabulary = materialized(
        idf.withColumn("idx", F.row_number().over(Window.orderBy("gram")) - 1), "vocabulary"
    )
    terms = vocabulary.count()
    summary = rows.groupBy("label").count().collect()  # one row per class
    classes = sorted(r.label for r in summary)
    if len(classes) < 2 or min(r["count"] for r in summary) < 2:
        raise ValueError("fitting needs two classes with at least two rows each")
    total = sum(r["count"] for r in summary)

    to_vector = F.udf(lambda pairs: Vectors.sparse(terms, pairs), VectorUDT())
    pairs = (
        unit_weights(counts, vocabulary, "row_id", sublinear())
        .groupBy("row_id")
        .agg(F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("pairs"))
    )
    labels = F.array(*[F.lit(c) for c in classes])
    features = (
        class_weights(rows)
        .join(pairs, "row_id", "left")
        .select(
            (F.array_position(labels, F.col("label")) - 1).cast("double").alias("y"),
            "weight",
            to_vector(
                F.coalesce("pairs", F.array().cast("array<struct<idx:int,w:double>>"))
            ).alias("features"),
        )
    )
    model = LogisticRegression(
        labelCol="y",
        featuresCol="features",
        weightCol="weight",
        maxIter=max_iter,
        tol=1e-4,
        regParam=1.0 / total,
        elasticNetParam=0.0,
        standardization=False,
        family="multinomial" if len(classes) > 2 else "binomial",
    ).fit(features.coalesce(1 + total // FIT_ROWS))
    weights = model.coefficientMatrix.toArray()
    intercepts = model.interceptVector.toArray()
    if len(classes) == 2:
        # softmax over (0, z) is the sigmoid of z
        weights = [weights[0] * 0.0, weights[0]]
        intercepts = [0.0, float(intercepts[0])]
    rows_out = [(i, [float(w[i]) for w in weights]) for i in range(terms)]
    coefficients = spark.createDataFrame(rows_out, "idx int, coefficients array<double>")
    return TextModel(
        materialized(
            vocabulary.join(coefficients, "idx").select("gram", "idf", "coefficients"), "terms"
        ),
        classes,
        [float(b) for b in intercepts],
    )


def slopes(model: TextModel, rows: DataFrame) -> DataFrame:
    """How far a fit is from its optimum: ``label``, ``train_rows``, ``terms``, and the steepest slope at the model and ``at_zero``.

    The slope of the penalised, weighted log loss by each coefficient is summed by joins over the training rows, apart from the
    solver; at the optimum all are 0.  ``at_zero`` is the steepest one of the model that knows nothing.
    """
    spark = rows.sparkSession
    rows = materialized(class_weights(rows), "slope-rows")
    total, every = rows.agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n")).first()
    scored = probabilities(model, rows.select("text").distinct())
    labels = F.array(*[F.lit(c) for c in model.classes])
    miss = F.transform(labels, lambda c, i: F.get("probabilities", i) - F.when(c == F.col("label"), 1.0).otherwise(0.0))
    blank = F.transform(labels, lambda c: F.lit(1.0 / len(model.classes)) - F.when(c == F.col("label"), 1.0).otherwise(0.0))
    errors = materialized(rows.join(scored, "text").select("row_id", "weight", miss.alias("miss"), blank.alias("blank")), "slope-errors")
    grams = unit_weights(token_counts(rows, "row_id", "text"), small(model.terms.select("gram", "idf")), "row_id", sublinear())
    sums = grams.join(errors, "row_id").select("gram", (F.col("w") * F.col("weight")).alias("x"), F.posexplode(F.arrays_zip("miss", "blank")).alias("k", "e"))
    sums = sums.groupBy("gram", "k").agg((F.sum(F.col("x") * F.col("e.miss")) / total).alias("s"), (F.sum(F.col("x") * F.col("e.blank")) / total).alias("z"))
    held = model.terms.select("gram", F.posexplode("coefficients").alias("k", "b"))
    # The penalty is 1 / rows, as in the fit.
    steep = held.join(sums, ["gram", "k"], "left").groupBy("k").agg(
        F.max(F.abs(F.coalesce("s", F.lit(0.0)) + F.col("b") / every)).alias("slope"), F.max(F.abs("z")).alias("at_zero"), F.count(F.lit(1)).alias("terms")
    )
    names = spark.createDataFrame(list(enumerate(model.classes)), "k int, label string")
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("train_rows"))
    return names.join(steep, "k").join(sizes, "label").select("label", "train_rows", "terms", "slope", "at_zero")


def load_or_fit(spark: SparkSession, path: str, rows: DataFrame) -> TextModel:
    """The saved model if there is a whole one, else fit from the training rows and save."""
    if path_exists(spark, f"{path}/classes/_SUCCESS"):  # written last
        return TextModel.load(spark, path)
    fit(rows).save(path)
    return TextModel.load(spark, path)


def probabilities(model: TextModel, texts: DataFrame) -> DataFrame:
    """``(text, classes, probabilities)`` for a table of distinct ``text``."""
    counts = token_counts(texts, "text", "text")
    scored = counts.join(small(model.terms), "gram").withColumn("w", sublinear() * F.col("idf"))
    sums = scored.groupBy("text").agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
        *[
            F.sum(F.col("w") * F.element_at("coefficients", i + 1)).alias(f"s{i}")
            for i in range(len(model.classes))
        ],
    )
    joined = texts.select("text").join(sums, "text", "left")
    logits = F.array(
        *[
            F.coalesce(F.col(f"s{i}") / F.col("norm"), F.lit(0.0)) + F.lit(b)
            for i, b in enumerate(model.intercepts)
        ]
    )
    powers = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    total = F.aggregate("powers", F.lit(0.0), lambda acc, x: acc + x)
    return (
        joined.withColumn("logits", logits)
        .withColumn("powers", powers)
        .select(
            "text",
            F.array(*[F.lit(c) for c in model.classes]).alias("classes"),
            F.transform("powers", lambda x: x / total).alias("probabilities"),
        )
    )


def accepted_families(
    top2: DataFrame,
    min_confidence: float = lookups.ML_MIN_CONFIDENCE,
    min_margin: float = lookups.ML_MIN_MARGIN,
) -> DataFrame:
    """``(text, ml_family, ml_confidence, ml_margin)``; the family is NULL where not accepted."""
    keep = (F.col("confidence") >= min_confidence) & (F.col("margin") >= min_margin)
    return top2.select(
        "text",
        F.when(keep, F.col("prediction")).alias("ml_family"),
        F.col("confidence").alias("ml_confidence"),
        F.col("margin").alias("ml_margin"),
    )
