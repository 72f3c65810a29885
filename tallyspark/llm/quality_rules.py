"""Quality rules: counts over whole texts, two fixed limits and boosted trees learned from labels.

A text is cut into words at blanks and ASCII control white space.  A document fails
the base rules with fewer than 20 words, or with over 30 % of its words in 8-word
windows that occur twice or more in the same text.  Trees that are boosted on labelled
documents judge the others by shares of these counts; they may only get stricter as
symbols, repeated lines and repeated words increase.

Defined results: a null text has no word and fails; a label without a document, a null
label and a document without a label are ignored in fitting; with labels of fewer than
two classes only the base rules decide.  Repeated rows are judged alike.  Other columns
are left alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm import trees
from tallyspark.llm.common import by_batch

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: Labelled documents that a fit looks at, at most; they are chosen by a hash of their id.
FIT_ROWS = 20_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_digits", "n_marks"]
#: Whether the verdict may rise (1) or fall (-1) with each feature, or both (0).
MONOTONE = [0, 0, -1, -1, -1, 0, -1, 0, 0]

_ANY = bytes(range(256))
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WINDOW)], np.uint64)


def repeated_words(words: np.ndarray) -> int:
    """Words inside windows of 8 that occur at least twice; ``words`` holds a number for each word."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    sums = np.zeros(n, np.uint64)
    for k, factor in enumerate(_FACTORS):
        sums += words[k : k + n].astype(np.uint64) * factor
    ordered = np.sort(sums)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0  # equal windows have equal sums
    # Exact: number the pairs, then pairs of pairs, then windows of 8.
    numbers = words.astype(np.int64)
    for step in (1, 2, 4):
        pairs = numbers[:-step] * (int(numbers.max()) + 1) + numbers[step:]
        numbers = np.unique(pairs, return_inverse=True)[1]
    twice = np.bincount(numbers)[numbers] > 1
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, np.flatnonzero(twice), 1)
    np.add.at(inside, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(inside) > 0).sum())


def count_text(text: str | None) -> list[int]:
    """The values of ``COUNTS`` for one whole text."""
    if not text:
        return [0] * len(COUNTS)
    data = text.encode()
    words = data.split()  # bytes split at ASCII white space only
    number: dict[bytes, int] = {}
    numbers = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = text.split("\n")
    with_word = [x for x in lines if x.strip(BLANKS)]
    without = lambda chars: len(data) - len(data.translate(_ANY, chars))
    return [
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(with_word) - len(set(with_word)),
        repeated_words(numbers),
        len(with_word),
        len(number),
        without(_UPPER),
        without(_DIGIT),
        text.count("!") + text.count("?"),
    ]


def features(counts: np.ndarray) -> np.ndarray:
    """Shares that do not grow with the length of a text, from rows of ``COUNTS``."""
    words, chars, symbols, dup, repeat, lines, distinct, upper, digits, marks = np.asarray(counts, float).T
    per = lambda a, b: a / np.maximum(b, 1)
    return np.stack(
        [
            np.log1p(words),
            per(chars, words),
            per(symbols, chars),
            per(dup, lines),
            per(repeat, words),
            per(distinct, words),
            per(marks, words),
            per(upper, chars),
            per(digits, chars),
        ],
        1,
    )


def base_failed(counts: np.ndarray) -> np.ndarray:
    words, repeat = counts[:, 0], counts[:, COUNTS.index("n_repeat_words")]
    return (words < LEAST_WORDS) | (100 * repeat > MOST_REPEATED_PERCENT * words)


def _counts_of(texts: pa.Array) -> np.ndarray:
    return np.array([count_text(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(COUNTS))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of each document, computed where the text is read."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = _counts_of(batch.column(1))
            return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts.T)], names=["doc_id", *COUNTS])

        return step

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(make), schema)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> trees.Forest | None:
    """Trees boosted on at most ``fit_rows`` labelled documents; None where the labels have one class or none.

    Only the counts of these documents come to the driver.
    """
    known = (
        labels.select(F.col("doc_id").cast("long"), (F.col("quality") >= 1).alias("good"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    chosen = docs.select("doc_id", "text")
    chosen = chosen.join(F.broadcast(known.select(F.col("doc_id").alias("label_id"))), F.col("doc_id") == F.col("label_id"), "left_semi")
    # One row for a doc_id, however often it is repeated: as many rows as labels at most.
    counted = statistics(chosen).groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("counts"))
    rows = counted.join(F.broadcast(known), "doc_id").select("good", "counts.*").collect()
    good = np.array([r["good"] for r in rows], float)
    if len(set(good)) < 2:
        return None
    counts = np.array([r[1:] for r in rows], np.int64)
    return trees.fit(features(counts), good, MONOTONE)


def judge(counts: np.ndarray, model: trees.Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(failed the base rules, probability of being good, kept)."""
    failed = base_failed(counts)
    good = model.probability(features(counts)) if model is not None else np.ones(len(counts))
    return failed, good, ~failed & (good >= 0.5)


def score(docs: DataFrame, model: trees.Forest | None) -> DataFrame:
    """Counts and verdict of each document: ``doc_id``, the counts, ``base_failed``, ``probability``, ``kept``."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = _counts_of(batch.column(1))
            failed, good, kept = judge(counts, model)
            columns = [batch.column(0), *map(pa.array, counts.T), pa.array(failed), pa.array(good), pa.array(kept)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", *COUNTS, "base_failed", "probability", "kept"])

        return step

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, probability double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(make), schema)


def keep(docs: DataFrame, model: trees.Forest | None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    at = docs.columns.index("text")

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array(judge(_counts_of(batch.column(at)), model)[2]))

        return step

    return docs.mapInArrow(by_batch(make), docs.schema)
