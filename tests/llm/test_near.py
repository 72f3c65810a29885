import random

import numpy as np
import pytest
from brute import near_classes, shingles

from tallyspark.llm import dart_minhash as dm
from tallyspark.llm.components import components


def corpus(seed=3, bases=12, copies=9):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8)))
    shared = [word() for _ in range(60)]
    docs = []
    for b in range(bases):
        words = [word() for _ in range(rng.choice([6, 60, 200]))]
        if b % 3 == 0:
            words = shared + words
        for c in range(rng.randrange(1, copies)):
            new = list(words)
            for _ in range(rng.randrange(0, 1 + len(new) // 40) if c else 0):
                new[rng.randrange(len(new))] = word()
            docs.append((len(docs) * 7 % 1009, " ".join(new)))
    return docs


@pytest.mark.parametrize("small", [0, 10_000])
def test_components(spark, monkeypatch, small):
    monkeypatch.setattr("tallyspark.llm.components.SMALL_EDGES", small)
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(5, 5), (200, 7), (7, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 2**63, 80).astype(np.uint64)
    a, b = rng.integers(1, 9, 80), rng.integers(1, 9, 80)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    got = [(dm.signature(x, a) == dm.signature(x, b)).mean() for x in (dm.mix(items + np.uint64(k)) for k in range(150))]
    assert abs(np.mean(got) - truth) < 0.02
    whole = rng.integers(0, 2**63, 30_000).astype(np.uint64)
    assert len(dm.signature(whole, np.ones(30_000, int))) == dm.COORDINATES


def test_shingles_and_similarity_equal_brute_force():
    rng = random.Random(2)
    texts = ["", " \n", "A b", "a B\tc d e f", "\x1ca\x85b " * 9] + ["".join(rng.choice("ab é\n") for _ in range(300)) for _ in range(60)]
    for x, y in zip(texts, texts[1:]):
        assert len(np.unique(dm.shingles(x))) == len(shingles(x)) and len(dm.shingles(x)) == shingles(x).total()
        both = shingles(x) & shingles(y)
        total = (shingles(x) | shingles(y)).total()
        want = both.total() / total if shingles(x) and shingles(y) else 0
        assert abs(dm.similarity(x, y) - want) < 1e-12


def test_classes_equal_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id long, text string, key string")
    got = {r["doc_id"]: r for r in dm.report(frame).collect()}
    want = dict(zip([i for i, _ in docs], near_classes(docs)))
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())
    stayed = dm.keep_one(frame)
    assert stayed.columns == frame.columns
    assert sorted(r["doc_id"] for r in stayed.collect()) == sorted(set(want.values()))


def test_unusual_rows(spark):
    rows = [(None, None), (4, ""), (3, "one two three four five six"), (3, "one two three four five six"), (8, "ONE two\nthree four five six"), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["class_id"], r["class_size"]) for r in dm.report(docs).collect()}
    assert got == {(None, 4, 2), (4, 4, 2), (3, 3, 3), (8, 3, 3), (9, 9, 1)}
    assert sorted(r["doc_id"] for r in dm.keep_one(docs).collect()) == [3, 4, 9]
    assert dm.report(docs.limit(0)).count() == 0


def test_star_group_in_crowded_bands_equals_brute_force(spark):
    rng = random.Random(9)
    base = [f"b{k}" for k in range(400)]
    docs = []
    for c in range(300):
        new = list(base)
        at = rng.randrange(6, 14)
        for k in range(6):  # each change spoils five shingles: 370 of 430 stay, and about 0.75 of two copies
            new[(at + 65 * k + rng.randrange(50)) % 400] = f"c{c}x{k}"
        docs.append((c, " ".join(new)))
    docs.insert(150, (1000, " ".join(base)))
    assert min(dm.similarity(docs[150][1], t) for _, t in docs) >= 0.8
    assert np.mean([dm.similarity(docs[0][1], t) >= 0.8 for _, t in docs[1:]]) < 0.5
    got = [r["class_id"] for r in dm.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()]
    assert set(got) == {0}
