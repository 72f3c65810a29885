"""Quality classifier by co-training a view of the text and a view of the page's metadata.

The text view counts hashed words and word shapes and a few shares (symbols, capitals,
repeats); the metadata view knows source, language and length.  Each view is a ridge-penalized
logistic regression, calibrated on labelled documents that it was not fitted on.  In each round
both views score every document; those of which a view is confident become pseudo-labels for
the other view, which is then fitted again.  At the end a logistic regression over both
calibrated log-odds, fitted on the calibration part, combines the views, and all documents are
scored.

What is fitted is bounded: at most ``fit_rows`` labelled documents and ``pseudo_rows`` pseudo-labels
of each class, view and round, chosen by a hash of the id; scoring and the search for confident
documents cover all.  Only numbers of these few documents come to the driver.

Defined results: a null text has no words, null metadata is a value of its own, a null n_chars
is 0; labels that disagree count as the lower one, null labels are ignored; without labels of
both classes scores are null and all documents are kept; documents that share a doc_id share a
label; repeated rows are scored alike.
"""

from __future__ import annotations

import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import by_batch, written

WORD_BUCKETS, SHAPE_BUCKETS, SHARES = 384, 128, 6
META_BUCKETS, LENGTH_STEPS = 64, 16
TEXT_SIZE = WORD_BUCKETS + SHAPE_BUCKETS + SHARES
META_SIZE = 2 * META_BUCKETS + LENGTH_STEPS + 1
FIT_ROWS, PSEUDO_ROWS, ROUNDS, CONFIDENT = 8_000, 1_000, 2, 0.97
REMEMBERED = 300_000
SYMBOLS = b"#*$%&|<>!"
UPPER = bytes(range(65, 91))
VIEWS = ("text", "meta")


class _Buckets(dict):
    """Word -> bucket of the word and of its shape, as one number; forgets all when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = word.decode("utf-8", "replace")
        shape = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in letters[-4:])
        found = zlib.crc32(word.lower()) % WORD_BUCKETS * SHAPE_BUCKETS + zlib.crc32(shape.encode()) % SHAPE_BUCKETS
        self[word] = found
        return found


_buckets = _Buckets()


def text_features(text: str | None) -> np.ndarray:
    """Logs of hashed counts, normed, and shares."""
    data = (text or "").encode()
    words = data.split()
    out = np.zeros(TEXT_SIZE, np.float32)
    if not words:
        return out
    n = len(words)
    codes = np.fromiter(map(_buckets.__getitem__, words), np.int64, n)
    counts = np.concatenate(
        [np.bincount(codes // SHAPE_BUCKETS, minlength=WORD_BUCKETS), np.bincount(codes % SHAPE_BUCKETS, minlength=SHAPE_BUCKETS)]
    )
    out[: len(counts)] = counts / n * 10
    without = lambda chars: (len(data) - len(data.translate(None, chars))) / len(data)
    repeats = sum(map(operator.eq, words, words[1:])) / n
    out[len(counts) :] = [np.log1p(n) / 10, 5 * without(SYMBOLS), 5 * without(UPPER), 5 * repeats, len(set(words)) / n, len(data) / n / 20]
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_SIZE, np.float32)
    out[zlib.crc32(repr(source).encode()) % META_BUCKETS] = 1
    out[META_BUCKETS + zlib.crc32(repr(lang).encode()) % META_BUCKETS] = 1
    size = np.log2(max(n_chars or 0, 0) + 1)
    out[2 * META_BUCKETS + min(int(size), LENGTH_STEPS - 1)] = 1
    out[-1] = size / 16
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 15) -> np.ndarray:
    """Weights and, last, the offset (without penalty) of a ridge-penalized logistic regression, by Newton's method."""
    x = np.hstack([np.asarray(x, float), np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(penalty)
        move = np.linalg.solve(hess, grad)
        w -= move / max(1.0, np.abs(move).max() / 5)
        if np.abs(move).max() < 1e-6:
            break
    return w


def raw(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.asarray(x, float) @ w[:-1] + w[-1]


@dataclass
class Views:
    """Weights of the views, their calibration (slope, offset) and their combination (two weights, offset)."""

    weights: dict[str, np.ndarray]
    calibration: dict[str, np.ndarray]
    joint: np.ndarray

    def log_odds(self, view: str, x: np.ndarray) -> np.ndarray:
        return raw(self.calibration[view], np.clip(raw(self.weights[view], x), -30, 30)[:, None])

    def combined(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        return raw(self.joint, np.stack([text, meta], 1))


def chance(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -60, 60)))


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
    )


def _features_of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    _, texts, *meta = (c.to_pylist() for c in batch.columns)
    return {
        "text": np.stack([text_features(t) for t in texts]),
        "meta": np.stack([meta_features(*row) for row in zip(*meta)]),
    }


def _collected(docs: DataFrame, chosen: DataFrame) -> tuple[dict[str, np.ndarray], list]:
    """Features of the few chosen documents and their rows of ``chosen``, which holds ``id`` and more, once per id."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _features_of(batch)
            columns = [pa.array(list(found[v].astype(np.float32)), pa.list_(pa.float32())) for v in VIEWS]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *VIEWS])

        return step

    ids = F.broadcast(chosen.select("id").distinct())  # bounded by fit_rows or pseudo_rows
    rows = _inputs(docs).join(ids, F.col("doc_id") == F.col("id"), "left_semi")
    made = rows.mapInArrow(by_batch(make), "doc_id long, text array<float>, meta array<float>").dropDuplicates(["doc_id"])
    got = made.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).collect()
    sizes = {"text": TEXT_SIZE, "meta": META_SIZE}
    x = {v: np.array([r[v] for r in got], np.float32).reshape(len(got), sizes[v]) for v in VIEWS}
    return x, got


def _confident(docs: DataFrame, views: Views, known: DataFrame) -> DataFrame:
    """Every document without a label of which a view is confident: ``id``, ``view``, ``good``."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = _features_of(batch)
            ids = np.arange(batch.num_rows)
            rows = [[], [], []]
            for view in VIEWS:
                p = chance(views.log_odds(view, found[view]))
                for good, sure in ((True, p >= CONFIDENT), (False, p <= 1 - CONFIDENT)):
                    rows[0] += ids[sure].tolist()
                    rows[1] += [view] * int(sure.sum())
                    rows[2] += [good] * int(sure.sum())
            taken = batch.column(0).take(pa.array(rows[0], pa.int64()))
            return pa.RecordBatch.from_arrays([taken, pa.array(rows[1], pa.string()), pa.array(rows[2], pa.bool_())], names=["id", "view", "good"])

        return step

    found = _inputs(docs).mapInArrow(by_batch(make), "id long, view string, good boolean").filter("id is not null")
    return written(found.join(F.broadcast(known.select("id")), "id", "left_anti"), "sure")


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, pseudo_rows: int = PSEUDO_ROWS, rounds: int = ROUNDS) -> Views | None:
    """Co-trained views; None without labels of both classes."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") >= 1).alias("good"))
        .dropna()
        .groupBy("id")
        .agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(fit_rows)
    )
    known = written(known, "labelled")
    x, got = _collected(docs, known)
    y = np.array([float(r["good"]) for r in got])
    apart = np.array([zlib.crc32(str(r["id"]).encode()) % 10 < 3 for r in got], bool)
    if len(set(y[apart])) < 2 or len(set(y[~apart])) < 2:
        return None

    def fitted(extra: dict[str, tuple[np.ndarray, np.ndarray]]) -> Views:
        weights, calibration = {}, {}
        for view in VIEWS:
            more_x, more_y = extra[view]
            weights[view] = fit_logistic(np.concatenate([x[view][~apart], more_x]), np.concatenate([y[~apart], more_y]))
            calibration[view] = fit_logistic(np.clip(raw(weights[view], x[view][apart]), -30, 30)[:, None], y[apart])
        views = Views(weights, calibration, np.array([1.0, 1.0, 0.0]))
        both = np.stack([views.log_odds(v, x[v][apart]) for v in VIEWS], 1)
        views.joint = fit_logistic(both, y[apart])
        return views

    sizes = {"text": TEXT_SIZE, "meta": META_SIZE}
    extra = {v: (np.empty((0, sizes[v]), np.float32), np.empty(0)) for v in VIEWS}
    views = fitted(extra)
    for number in range(rounds):
        sure = _confident(docs, views, known)
        parts = [
            sure.filter((F.col("view") == view) & (F.col("good") == good)).distinct().orderBy(F.xxhash64("id", F.lit(number)), "id").limit(pseudo_rows)
            for view in VIEWS
            for good in (True, False)
        ]
        chosen = parts[0]
        for part in parts[1:]:
            chosen = chosen.union(part)
        more, rows = _collected(docs, written(chosen, "pseudo"))
        for teacher, pupil in (VIEWS, VIEWS[::-1]):
            taught = np.array([r["view"] == teacher for r in rows], bool)
            given = np.array([float(r["good"]) for r in rows])
            old_x, old_y = extra[pupil]
            if taught.any():
                extra[pupil] = (np.concatenate([old_x, more[pupil][taught]]), np.concatenate([old_y, given[taught]]))
        views = fitted(extra)
    return views


def score(docs: DataFrame, views: Views | None) -> DataFrame:
    """``doc_id``, the calibrated probabilities ``text_score`` and ``meta_score``, the combined ``score``, and ``kept``."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = batch.num_rows
            if views is None:
                columns = [pa.nulls(n, pa.float64())] * 3 + [pa.array([True] * n)]
            else:
                found = _features_of(batch)
                text, meta = (views.log_odds(v, found[v]) for v in VIEWS)
                both = chance(views.combined(text, meta))
                columns = [pa.array(chance(text)), pa.array(chance(meta)), pa.array(both), pa.array(both >= 0.5)]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "text_score", "meta_score", "score", "kept"])

        return step

    return _inputs(docs).mapInArrow(by_batch(make), "doc_id long, text_score double, meta_score double, score double, kept boolean")
