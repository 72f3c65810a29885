import random

import numpy as np
import pytest
from brute import quality_counts

from tallyspark.llm import quality_rules, trees


def test_counts_equal_brute_force():
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a b c d e f g h a b c d e f g h", "x\nx\n \nx y", "é# *é\x1c\xa0z", "w " * 5000]
    texts += ["".join(rng.choice(["a", "b", " ", " ", "\n", "#", "\x0b", "é"]) for _ in range(rng.randrange(200))) for _ in range(300)]
    for text in texts:
        got = dict(zip(quality_rules.COUNTS, quality_rules.count_text(text)))
        want = quality_counts(text)
        assert {k: got[k] for k in want} == want, text


def test_trees_learn_and_keep_the_order():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 3))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=1500) * 0.5 > 0).astype(float)
    forest = trees.fit(x, y, [1, -1, 0])
    test = rng.normal(size=(500, 3))
    assert ((forest.probability(test) > 0.5) == (test[:, 0] - test[:, 1] > 0)).mean() > 0.85
    for column, sign in ((0, 1), (1, -1)):
        grid = np.repeat(test[:50], 40, 0)
        grid[:, column] = np.tile(np.linspace(-4, 4, 40), 50)
        steps = np.diff(forest.raw(grid).reshape(50, 40), axis=1) * sign
        assert (steps >= -1e-9).all()
    assert np.isfinite(forest.raw(np.full((2, 3), np.nan))).all()


def test_flat_arrays_equal_a_walk_of_the_tree():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(400, 2)), rng.integers(0, 2, 400)
    forest = trees.fit(x, y, trees=7, depth=3)

    def walk(row):
        total = forest.base
        for root in forest.roots:
            k = root
            while forest.low[k] != k:
                k = forest.low[k] if row[forest.feature[k]] <= forest.threshold[k] else forest.high[k]
            total += forest.value[k]
        return total

    assert np.allclose(forest.raw(x[:50]), [walk(r) for r in x[:50]])


@pytest.fixture(scope="module")
def given(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


def test_verdicts_agree_with_labels(given):
    docs, labels = given
    model = quality_rules.fit(docs, labels)
    scored = quality_rules.score(docs, model).join(labels, "doc_id").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in scored if not r["base_failed"]]
    assert np.mean(right) > 0.97
    kept = {r["doc_id"] for r in quality_rules.score(docs, model).filter("kept").collect()}
    stayed = quality_rules.keep(docs, model)
    assert stayed.columns == docs.columns and {r["doc_id"] for r in stayed.collect()} == kept


def test_unusual_rows(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(None, None, 1.0), (1, "", 2.0), (2, good, 3.0), (2, good, 3.0), (3, "w " * 100_000, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept double")
    none = spark.createDataFrame([(None, 1), (2, None), (9, 0)], "doc_id long, quality int")
    model = quality_rules.fit(docs, none)
    assert model is None
    got = {(r["doc_id"], r["kept"]) for r in quality_rules.score(docs, model).collect()}
    assert got == {(None, False), (1, False), (2, True), (3, False)}
    assert quality_rules.keep(docs, model).count() == 2
    assert quality_rules.score(docs.limit(0), model).count() == 0
