import collections
import random

import numpy as np
import pytest
from brute import components as grouped
from brute import similar

from tallyspark.llm import dart_minhash as dm
from tallyspark.llm import line_dedup, linking


def near_texts(n=120, words=60, seed=2):
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    texts = []
    for c in range(n):
        new = list(base)
        for _ in range(rng.randrange(0, 6)):
            new[rng.randrange(words)] = f"c{c}{rng.randrange(99)}"
        texts.append(" ".join(new))
    return texts


def classes(n, links):
    roots = grouped(n, links)
    return {frozenset(j for j in range(n) if roots[j] == r) for r in roots}


def wanted(texts, weighted=True):
    sets = [collections.Counter(dm.shingles(t).tolist()) for t in texts]
    return classes(len(texts), similar(sets if weighted else [collections.Counter(set(s)) for s in sets], 0.8))


@pytest.mark.parametrize("weighted", [True, False])
def test_a_tile_gives_only_spanning_links(weighted):
    texts = near_texts() + ["", "a b", "a b", "a a a a a a a", "a a a a a a a a"]
    n = len(texts)
    links = list(linking.spanning(0.8, weighted, (list(range(n)), list(range(n)), linking.hashes_of(dm.cut, texts))))
    assert classes(n, links) == wanted(texts, weighted)
    assert len(links) == n - len(wanted(texts, weighted))


def test_two_thousand_copies_give_fewer_links_than_copies():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(words[:k] + [f"x{n}"] + words[k + 1 :]) for n, k in ((n, rng.randrange(300)) for n in range(2000))]
    hashes = linking.hashes_of(dm.cut, texts)
    tiles = [(list(range(a, a + 1000)), list(range(a, a + 1000)), hashes[a : a + 1000]) for a in (0, 1000)]
    links = [x for tile in tiles for x in linking.spanning(0.8, True, tile)]
    between = list(linking.spanning(0.8, True, *tiles))
    assert len(links) == 1998 and len(between) <= 1999
    assert len(classes(2000, links + between)) == 1
    # What is in one component already gives no link.
    one = [(nodes, [0] * 1000, t) for nodes, _, t in tiles]
    assert list(linking.spanning(0.8, True, *one)) == []


@pytest.mark.parametrize("weighted", [True, False])
def test_small_tiles_give_the_same_links_as_large_ones(weighted, monkeypatch):
    texts = near_texts(40, 12, 5) + ["", "a a a a a a a", "a a a a a a a a"]
    hashes = linking.hashes_of(dm.cut, texts)
    found = []
    for few in (0, 100):
        monkeypatch.setattr(linking, "FEW", few)
        n = len(texts)
        one = list(linking.spanning(0.8, weighted, (range(n), range(n), hashes)))
        two = list(linking.spanning(0.8, weighted, (range(20), range(20), hashes[:20]), (range(20, n), range(20, n), hashes[20:])))
        found.append((classes(n, one), classes(n, two)))
    assert found[0] == found[1] and found[0][0] == wanted(texts, weighted)


def members_of(spark, bands, texts):
    """Members as the operators give them, and their texts."""
    rows = [(node, band, len(texts[node].split())) for band, nodes in bands.items() for node in nodes]
    held = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    return spark.createDataFrame(rows, "node long, band long, size long"), lambda some: held.join(some, "node")


@pytest.mark.parametrize("tile", [1024, 8])
def test_bands_of_many_tiles_lose_no_link(spark, monkeypatch, tile):
    """The same links whether a band is one tile or many, with bands that repeat and overlap."""
    monkeypatch.setattr(linking, "TILE", tile)
    texts = near_texts(90)
    bands = {1: range(90), 2: range(90), 3: range(10, 30), 4: [0], 5: [2, 3]}
    members, held = members_of(spark, bands, texts)
    for turns in (1, 3):
        links = [(r["node"], r["root"]) for r in linking.link(members, held, dm.cut, 0.8, True, turns).collect()]
        assert classes(90, links) == wanted(texts)


def test_pairs_without_a_common_band_are_not_compared(spark):
    members, held = members_of(spark, {1: [0, 1], 2: [2]}, ["a b c d e f"] * 3)
    assert sorted(r["node"] for r in linking.link(members, held, dm.cut, 0.8).collect()) == [0, 1]
    assert linking.link(members.limit(0), held, dm.cut, 0.8).count() == 0


@pytest.mark.parametrize("length", [12, 20, 60])
def test_line_bands_find_nearly_all_similar_lines(length):
    """Pairs at 0.8 or more that share a band: all but one of a thousand is the rule for long lines; short ones have fewer bands."""
    rng = random.Random(length)
    word = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    pairs, met = 0, 0
    for _ in range(1500):
        line = word(length)
        front, back = rng.randrange(0, 1 + length // 12), rng.randrange(0, 1 + length // 12)
        other = word(front) + line[rng.randrange(2) : length - rng.randrange(2)] + word(back)
        of, hashes = line_dedup.cut([line, other])
        a, b = (np.unique(hashes[of == k]) for k in range(2))
        both = len(np.intersect1d(a, b))
        if line != other and both / (len(a) + len(b) - both) >= 0.8:
            pairs += 1
            row, keys = line_dedup.bands(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]))
            met += bool(len(np.intersect1d(keys[row == 0], keys[row == 1])))
    assert pairs > 300 and met >= 0.995 * pairs


def test_characters_of_all_planes_and_clashing_columns(spark):
    of, hashes = line_dedup.cut(["abcdef", "", "abcd", "😀😀😀😀😀😀", "éabcde"])
    assert of.tolist() == [0, 0, 3, 3, 4, 4] and hashes[2] == hashes[3] and len(set(hashes.tolist())) == 4
    rows = [(1, "one and the same line\nx", "k", 7), (2, "one and the same line\ny", "k", 8)]
    for names in ("doc hash", "_doc kept", "own lines", "lines _lines"):
        docs = spark.createDataFrame(rows, f"doc_id long, text string, {names.split()[0]} string, {names.split()[1]} int")
        got = line_dedup.dedup(docs)
        assert got.columns == docs.columns
        assert sorted(map(tuple, got.collect())) == [rows[0], (2, "y", "k", 8)]
    for names in ("doc key", "_doc _key"):
        docs = spark.createDataFrame([(1, "a b c d e f", "k", 7), (2, "A b c d e f", "k", 8)], f"doc_id long, text string, {names.split()[0]} string, {names.split()[1]} int")
        assert [tuple(r) for r in dm.keep_one(docs).collect()] == [(1, "a b c d e f", "k", 7)]
