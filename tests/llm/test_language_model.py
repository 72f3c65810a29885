import collections
import math
import re
import zlib

import numpy as np
import pytest

from tallyspark.llm import language_model as lm


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", low)] + [b""]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(None, None), (-7, ""), (-8, "ÀB\x1cC\xa0d THE the"), (0, "again")], "doc_id long, text string")
    return given.union(more).cache()


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


class Plain:
    """All n-grams of the training rows in one dictionary; probabilities by the definition."""

    def __init__(self, rows):
        self.seen, self.past = collections.Counter(), collections.Counter()
        for _, text in (r for r in rows if not held(r[0])):
            line = [b"", *words(text)]
            for i in range(1, len(line)):
                for size in range(1, min(3, i + 1) + 1):
                    self.seen[tuple(line[i - size + 1 : i + 1])] += 1
                for size in (1, 2):
                    if size <= i:
                        self.past[tuple(line[i - size : i])] += 1
        self.n = sum(c for g, c in self.seen.items() if len(g) == 1)
        self.v = sum(len(g) == 1 for g in self.seen)

    def chance(self, history, word):
        if not history:
            return (self.seen[(word,)] + 0.5) / (self.n + 0.5 * (self.v + 1))
        shorter = self.chance(history[1:], word)
        return (self.seen[(*history, word)] + lm.STRENGTH * shorter) / (self.past[history] + lm.STRENGTH)

    def score(self, text):
        line = [b"", *words(text)]
        return sum(math.log10(self.chance(tuple(line[max(0, i - 2) : i]), line[i])) for i in range(1, len(line)))

    def row(self, doc_id, text):
        said = words(text)
        base = sum(math.log10(self.chance((), w)) for w in said)
        return doc_id, held(doc_id), len(said), sum(self.seen[(w,)] > 0 for w in said), self.n, round(base, 5), round(self.score(text), 5)


def found(df):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return collections.Counter((*(r[n] for n in names), round(r["base_score"], 5), round(r["score"], 5)) for r in df.collect())


def test_scores_equal_brute_force_at_any_size_of_blocks_and_ranges(docs):
    rows = docs.collect()
    plain = Plain(rows)
    want = collections.Counter(plain.row(i, t) for i, t in rows)
    for sizes in ({}, {"block_tokens": 3000, "range_grams": 5000}, {"block_tokens": 1}):
        assert found(lm.score_documents(docs, **sizes)) == want, sizes


def test_a_table_in_other_partitions_and_one_hot_text(spark):
    rows = [(i, "a b c d") for i in range(200)] + [(1000 + i, f"a b {i} c a b") for i in range(50)] + [(1, "a b c d")]
    plain = Plain(rows)
    want = collections.Counter(plain.row(i, t) for i, t in rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    extra = df.selectExpr("*", "1 as block", "'x' as texts", "2 as part", "3 as n_tokens")
    for given in (df.coalesce(1), extra.repartition(7)):
        assert found(lm.score_documents(given, block_tokens=40, range_grams=50)) == want


def test_probabilities_after_any_history_sum_to_one(docs):
    plain = Plain(docs.limit(60).collect())
    every = [g[0] for g in plain.seen if len(g) == 1]
    histories = [h for h in plain.past][:: max(1, len(plain.past) // 12)] + [(b"never", b"met")]
    for history in histories:
        assert abs(sum(plain.chance(history, w) for w in every) + plain.chance(history, b"not a word") - 1) < 1e-9


def test_longer_histories_help_on_held_out_texts(docs):
    rows = [r for r in lm.score_documents(docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score_documents(docs).count() == 0
    only_held = spark.createDataFrame([(i, "a b") for i in range(40) if held(i)], "doc_id long, text string")
    got = lm.score_documents(only_held).collect()
    assert got and all(r["n_known"] == 0 and r["base_score"] == r["score"] == 0 and r["n_tokens"] == 3 for r in got)
    nulls = lm.score_documents(spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")).collect()
    assert [(r["held_out"], r["n_tokens"], r["train_tokens"]) for r in nulls] == [(False, 1, 2)] * 2


@pytest.mark.parametrize("closed", [True, False])
def test_all_texts_are_walked_at_once_as_one_by_one(monkeypatch, closed):
    """op9's CPU seconds: no loop over tokens where n-grams have their shorter ones; with shared hashes they need not, and the walk decides."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 12, 300)
    firsts = np.cumsum(sizes + 1) - sizes - 1
    ends, n = firsts + sizes, int((sizes + 1).sum())
    place = np.arange(n) - np.repeat(firsts, sizes + 1)
    has = [(rng.random(n) < 0.8) & (place > 0), (rng.random(n) < 0.6) & (place > 0), (rng.random(n) < 0.5) & (place > 1)]
    if closed:
        has[1][1:] &= has[0][1:] & (has[0][:-1] | (place[1:] == 1))
        has[2][1:] &= has[1][1:] & has[1][:-1]
    arcs, failures = [-rng.random(n) for _ in range(3)], [-rng.random(n) for _ in range(3)]
    one = [lm.walk(*([level[a : b + 1].tolist() for level in kind] for kind in (arcs, has, failures))) for a, b in zip(firsts, ends)]
    walked, plain = [], lm.walk
    monkeypatch.setattr(lm, "walk", lambda *given: walked.append(1) or plain(*given))
    assert np.allclose(lm.walks(arcs, has, failures, firsts, ends), one, atol=1e-12)
    assert not walked if closed else 0 < len(walked) < 300
