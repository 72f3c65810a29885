"""Near-duplicate documents by DartMinHash.

A text is a weighted set: its shingles of five words (lower-cased by ASCII rules, cut at
ASCII white space), weighted by how often they occur; similarity is the weighted Jaccard
similarity, which is the plain one where shingles do not repeat.  Every shingle has the same
hashed darts in every text: on its plane of weight and rank, unit squares hold a number of
darts that is Poisson distributed with mean 1.  A text is hit by the darts whose weight lies
below the shingle's weight.  Each dart belongs to one of the signature's coordinates; a coordinate
keeps the dart of least rank.  Only darts up to a rank are thrown that fills all coordinates
most of the time; where one is left empty, the rank is doubled.  So a signature costs time in
proportion to the words of the text plus the number of darts, whatever the number of coordinates.

Texts with equal bytes are one node.  Coordinates are cut into bands; nodes that share a band are
compared exactly, in bands of any size, as ``linking`` describes.  A pair at similarity 0.8 shares none of the ``BANDS``
bands in less than one of 10,000 cases, a more similar one more rarely.

Defined results: a null text is empty; texts without words are only grouped with equal texts; a
text of fewer than five words has one shingle; a class is named by its smallest doc_id
(nulls last); repeated rows are in one class.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import broadcast_if_small, by_batch, unused, written
from tallyspark.llm.linking import link

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
#: Parts of the bands that are compared one after the other.
TURNS = 3
INVOLVED_ROWS = 200_000

# Odd multipliers of the hashes.
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_STEP = 0xD6E8FEB86659FD93
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
_EXPECTED = COORDINATES * math.log(COORDINATES) + 2 * COORDINATES

_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers 0 to n of an odd number modulo 2^64."""
    global _powers
    if len(_powers) <= n:
        more = np.full(max(n + 1, 1 << 16), _STEP, np.uint64)
        more[0] = 1
        _powers = np.multiply.accumulate(more)
    return _powers


_INVERSE = pow(_STEP, -1, 1 << 64)
_inverses = np.ones(1, np.uint64)


def _inverse_power(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) <= n:
        more = np.full(max(n + 1, 1 << 16), _INVERSE, np.uint64)
        more[0] = 1
        _inverses = np.multiply.accumulate(more)
    return _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed function of 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """64-bit hashes of all shingles of a text, with repeats."""
    data = np.frombuffer((text or "").encode().lower(), np.uint8)
    blank = np.concatenate([[True], _BLANK[data], [True]])
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    if not len(starts):
        return np.empty(0, np.uint64)
    # A word's hash is the difference of two prefix sums, moved to the text's beginning.
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(len(data))[: len(data)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * _inverse_power(len(data))[starts] + (ends - starts).astype(np.uint64))
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mix(out * _A + words[k : k + n])
    return out


def signature(items: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The dart kept by each coordinate, for whole-numbered positive weights."""
    total = int(weights.sum())
    column = np.arange(total, dtype=np.uint64) - np.repeat(np.cumsum(weights) - weights, weights).astype(np.uint64)
    region = mix(np.repeat(items, weights) + column * _B)
    limit = _EXPECTED / total
    while True:
        rows = np.arange(math.ceil(limit), dtype=np.uint64)
        square = mix((region[:, None] + (rows * _C)[None, :]).ravel())
        row = np.tile(rows.astype(float), total)
        count = np.searchsorted(_POISSON, (square >> np.uint64(11)).astype(float) * 2.0**-53, "right")
        hit = np.repeat(np.arange(len(square)), count)
        number = np.arange(len(hit)) - np.repeat(np.cumsum(count) - count, count)
        dart = mix(square[hit] + (number + 1).astype(np.uint64) * _A)
        rank = row[hit] + (dart >> np.uint64(11)).astype(float) * 2.0**-53
        near = rank < limit
        dart, rank = mix(dart[near] + _B), rank[near]
        coordinate = (dart % np.uint64(COORDINATES)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        kept = np.zeros(COORDINATES, np.uint64)
        filled = np.zeros(COORDINATES, bool)
        kept[coordinate[order]] = dart[order]  # the last one written has the least rank
        filled[coordinate] = True
        if filled.all():
            return kept
        limit *= 2


def sign(text: str | None) -> tuple[int, list[int]] | None:
    """(number of shingles, band keys) of a text with words."""
    found = shingles(text)
    if not len(found):
        return None
    kept = signature(*np.unique(found, return_counts=True))
    keys = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for k in range(ROWS):
        keys = mix(keys * _A + kept.reshape(BANDS, ROWS)[:, k])
    return len(found), keys.view(np.int64).tolist()


def cut(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Number of its text and hash of each shingle of some texts."""
    each = [shingles(t) for t in texts]
    return np.repeat(np.arange(len(each)), [len(x) for x in each]), np.concatenate(each) if each else np.empty(0, np.uint64)


def similarity(left: str | None, right: str | None) -> float:
    """Exact weighted Jaccard similarity of two texts; 0 if either has no words."""
    a, n = np.unique(shingles(left), return_counts=True)
    b, m = np.unique(shingles(right), return_counts=True)
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common / (int(n.sum()) + int(m.sum()) - common)


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (of the text's bytes), ``n`` and ``bands`` of each row; null where there are no words."""
    names = ["doc_id", "key", "n", "bands"]

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            keys = [hashlib.md5((t or "").encode()).digest() for t in texts]
            done: dict[bytes, tuple | None] = {}
            for key, text in zip(keys, texts):
                if key not in done:
                    done[key] = sign(text) or (None, None)
            signs = [done[k] for k in keys]
            kinds = [pa.int64(), pa.list_(pa.int64())]
            columns = [pa.array([s[i] for s in signs], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), *columns], names=names)

        return step

    schema = "doc_id long, key binary, n long, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(by_batch(make), schema)


def _texts(docs: DataFrame, nodes: DataFrame, some: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the nodes in ``some``."""
    involved = nodes.join(some, "node").select("node", F.col("key").alias("node_key"), "first_id")
    involved = broadcast_if_small(written(involved, "near-involved"), INVOLVED_ROWS)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.unhex(F.md5("text")) == F.col("node_key"))
    return written(keyed.join(involved, same).select("node", "text").dropDuplicates(["node"]), "near-texts")


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``key`` of the text, ``class_id``, ``class_key`` (text of the class's first document) and ``class_size``, a row for each row of ``docs``."""
    signed = written(signatures(docs), "near-signatures")
    nodes = signed.groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "*"), "near-nodes")
    members = written(nodes.filter("n is not null").select("node", F.col("n").alias("size"), F.explode("bands").alias("band")), "near-bands")
    roots = link(members, lambda some: _texts(docs, nodes, some), cut, least, weighted=True, turns=TURNS)
    named = nodes.select("node", "key", "first_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = written(named, "near-named")
    first = F.min(F.struct(F.col("first_id").isNull().alias("unnamed"), "first_id", "key"))
    groups = named.groupBy("root").agg(first.alias("first"), F.sum("copies").alias("class_size"))
    labels = named.select("key", "root").join(groups, "root")
    labels = labels.select("key", F.col("first.first_id").alias("class_id"), F.col("first.key").alias("class_key"), "class_size")
    return signed.select("doc_id", "key").join(written(labels, "near-labels"), "key").select("doc_id", "key", "class_id", "class_key", "class_size")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` (smallest doc_id of its class), ``class_size`` and ``kept`` of every document."""
    found = classes(docs)
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))
    return found.select("doc_id", "class_id", "class_size", kept.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``, with all its columns."""
    found = written(classes(docs), "near-classes")
    own = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("class_key"))
    doc, key = unused(docs, "doc"), unused(docs, "key")
    named = lambda df: df.select(F.col("doc_id").alias(doc), F.col("key").alias(key))
    dropped, twice = named(found.filter(~own)).distinct(), named(found.filter(own).groupBy("doc_id", "key").count().filter("count > 1"))
    dropped, twice = (broadcast_if_small(written(x, "near-dropped"), INVOLVED_ROWS) for x in (dropped, twice))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (F.unhex(F.md5(text)) == F.col(key))
    rest = docs.join(dropped, same, "left_anti")
    if twice.isEmpty():
        return rest
    repeated = rest.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return rest.join(twice, same, "left_anti").unionByName(repeated)
