"""Vector codes: parts of vectors by the nearest entry of a codebook, found through memoised grid cells.

Components become integers, ``floor(4096 x)``; vectors are cut into ``PARTS`` equal parts.  A part position's codebook
begins with that part of the ``ENTRIES`` smallest ids.  In each round every part goes to its nearest entry, and an entry becomes
the componentwise floor of its parts' mean; entries without parts stay.  Tasks send sums for each entry
only, so what a round brings to the driver is the size of the codebooks, whatever the number of vectors.

The nearest entry is found through a grid.  A part lies in a coarse cell, a box; the entries whose least distance
to the box is beyond the least of all entries' greatest distances to it cannot be nearest to any point of the box
(they are *dominated*).  The other entries are kept under the cell's hash and compared exactly for every part in
the cell; each task's memory of cells begins anew when it holds ``CELLS`` of them, which changes no result.

Everything is exact: components too large for 64-bit products are compared as Python's whole numbers, and
sums travel in limbs of 32 bits.  Defined results: rows whose vector is null or holds null or non-finite components are left
out; so are vectors whose length is not that of the first kept vector, and all if that length is 0 or no multiple of ``PARTS``
(a shorter part would have no components in common).  A null id is the largest; equal ids are ordered by their vectors.  Fewer than ``ENTRIES``
kept rows give so many entries.  Distances tie to the lower index.  Repeated rows count each.  Errors beyond a long are
the greatest long.  An empty table gives no rows; columns other than the id, the vector and the label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import broadcast_if_small, written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
#: Cells whose candidates a task remembers for a part position.
CELLS = 1 << 16
#: About so many cells lie side by side over the entries of a codebook.
ACROSS = 4
#: Below this size of components no square or sum of a part's squares leaves 64 bits.
SMALL = 1 << 26
MOST = (1 << 63) - 1


def integers(values: np.ndarray) -> np.ndarray:
    """``floor(4096 x)`` of finite doubles, as 64-bit integers or, if some are large, as Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    if not values.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    exact = [int(s) if math.isfinite(s) else int(x) * SCALE for s, x in zip(scaled.ravel().tolist(), values.ravel().tolist())]
    return np.array(exact, object).reshape(values.shape)


def _low(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(2)


@dataclass
class Grid:
    """The codebook of one part position with the candidates of the cells seen so far."""

    entries: np.ndarray  # a row for each entry
    shift: int = 0
    seen: dict = field(default_factory=dict)

    def __post_init__(self):
        spread = max(int(self.entries[:, j].max() - self.entries[:, j].min()) for j in range(self.entries.shape[1]))
        self.shift = max(0, (spread // ACROSS).bit_length())

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Which entries no other dominates over the box of each cell."""
        low = (cells << self.shift)[:, None, :]
        high = low + (1 << self.shift) - 1
        entries = self.entries[None, :, :]
        outside = np.maximum(np.maximum(low - entries, entries - high), 0)
        across = np.maximum(abs(entries - low), abs(high - entries))
        least, most = (outside * outside).sum(2), (across * across).sum(2)
        return (least <= most.min(1)[:, None]).astype(bool)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point, the lowest of several, and the squared distance."""
        if points.dtype == object or self.entries.dtype == object:
            points = points.astype(object)
        cells = points >> self.shift
        if points.dtype == object:
            keys = [tuple(c) for c in cells]
            numbers = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            of_point = np.fromiter((numbers[k] for k in keys), np.int64, len(keys))
            first = np.zeros(len(numbers), np.int64)
            first[of_point[::-1]] = np.arange(len(keys))[::-1]
            names = list(numbers)
        else:
            rows = np.ascontiguousarray(cells).view(f"V{cells.shape[1] * 8}").ravel()
            found, first, of_point = np.unique(rows, return_index=True, return_inverse=True)
            names = [x.tobytes() for x in found]
        new = [i for i, name in enumerate(names) if name not in self.seen]
        known = {i: self.seen[name] for i, name in enumerate(names) if name in self.seen}
        if len(self.seen) + len(new) > CELLS:
            self.seen.clear()
        masks = np.zeros((len(names), len(self.entries)), bool)
        for i, mask in known.items():
            masks[i] = mask
        if new:
            masks[new] = self.candidates(cells[first[new]])
            self.seen.update(zip((names[i] for i in new[:CELLS]), masks[new[:CELLS]]))
        best = np.full(len(points), -1, np.int64)
        error = np.zeros(len(points), points.dtype)
        for k, entry in enumerate(self.entries):
            rows = np.flatnonzero(masks[of_point, k])
            apart = points[rows] - entry
            apart = (apart * apart).sum(1)
            nearer = (best[rows] < 0) | (apart < error[rows]).astype(bool)
            best[rows[nearer]], error[rows[nearer]] = k, apart[nearer]
        return best, error


def _vectors(column: pa.ListArray) -> np.ndarray:
    return integers(column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1))


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """Places and digits of a whole number to the base 2^32; the last digit has the sign."""
    place = 0
    while not -(1 << 31) <= value < 1 << 31:
        yield place, value & 0xFFFFFFFF
        place, value = place + 1, value >> 32
    if value:
        yield place, value


def _sums(books: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Number and sums of the parts at each entry: ``part``, ``entry``, ``position`` (-1: the number), ``place``, ``digit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(book) for book in books]
        totals: dict[tuple[int, int, int], int] = defaultdict(int)
        for batch in batches:
            vectors = _vectors(batch.column(0))
            for part, (grid, points) in enumerate(zip(grids, np.split(vectors, PARTS, axis=1))):
                best, _ = grid.nearest(points)
                for entry in np.unique(best).tolist():
                    own = points[best == entry]
                    totals[part, entry, -1] += len(own)
                    for position, sum_ in enumerate(own.sum(0).tolist()):
                        totals[part, entry, position] += sum_
        rows = [(*slot, *limb) for slot, total in totals.items() for limb in limbs(total)]
        columns = list(zip(*rows)) or [()] * 5
        names = ["part", "entry", "position", "place", "digit"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _assigned(books: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(book) for book in books]
        for batch in batches:
            vectors = _vectors(batch.column(2))
            found = [grid.nearest(points) for grid, points in zip(grids, np.split(vectors, PARTS, axis=1))]
            codes = ["".join(f"{c:02x}" for c in row) for row in np.stack([best for best, _ in found], 1).tolist()]
            errors = [min(MOST, sum(row)) for row in zip(*[error.tolist() for _, error in found])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"]
            )

    return run


def kept(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` (doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    usual = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.select("vec_id", "label", F.when(F.col("embedding").isNotNull() & usual, vector).alias("vector")).filter("vector is not null")


def first_books(rows: DataFrame, entries: int = ENTRIES) -> list[np.ndarray]:
    """The codebooks to begin with, from the smallest ids; at most ``entries`` rows reach the driver."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    length = len(first[0]["vector"]) if first else 0
    vectors = [r["vector"] for r in first if len(r["vector"]) == length]
    if not length or length % PARTS:
        return []
    return np.split(integers(np.array(vectors, float)), PARTS, axis=1)


def train(rows: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The codebook of each part position, from all of ``rows`` (the result of ``kept``)."""
    books = first_books(rows, entries)
    if not books:
        return []
    length = PARTS * books[0].shape[1]
    vectors = rows.filter(F.size("vector") == length).select("vector")
    for _ in range(rounds):
        sums = vectors.mapInArrow(_sums(books), "part long, entry long, position long, place long, digit long")
        total: dict[tuple[int, int, int], int] = defaultdict(int)
        # A row for each number of the codebooks and limb, whatever the number of vectors.
        for r in sums.groupBy("part", "entry", "position", "place").agg(F.sum("digit").alias("digit")).collect():
            total[r["part"], r["entry"], r["position"]] += r["digit"] << 32 * r["place"]
        new = []
        for part, book in enumerate(books):
            means = [
                [total[part, e, j] // total[part, e, -1] for j in range(book.shape[1])] if total[part, e, -1] else row for e, row in enumerate(book.tolist())
            ]
            large = max(abs(x) for row in means for x in row) >= SMALL
            new.append(np.array(means, object if large else np.int64))
        books = new
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of the rows of ``kept`` whose vectors fit the codebooks."""
    if not books:
        return rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    fitting = rows.filter(F.size("vector") == PARTS * books[0].shape[1])
    kinds = dict(rows.dtypes)
    return fitting.mapInArrow(_assigned(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def report(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every kept row."""
    own = written(kept(rows), "codes-kept")
    books = train(own)
    coded = written(compress(own, books), "codes")
    whole: Column = F.sum(F.col("error").cast("decimal(38, 0)"))
    sums = coded.groupBy("label").agg(F.least(whole, F.lit(MOST).cast("decimal(38, 0)")).cast("long").alias("label_error"))
    sums = sums.select(F.col("label").alias("other"), "label_error")
    joined = coded.join(broadcast_if_small(sums), F.col("label").eqNullSafe(F.col("other")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """The same rows in SQL: one assignment and one update after the other."""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(
            f"""n{k} AS MATERIALIZED (SELECT rn, part, min(d * {ENTRIES} + e) AS best FROM (
        SELECT c.rn, c.part, b.e, sum((c.x - b.x) * (c.x - b.x)) AS d FROM c JOIN b{k} AS b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL) GROUP BY ALL)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""b{k + 1} AS MATERIALIZED (SELECT b.part, b.pos, b.e, coalesce((s - ((s % n + n) % n)) // n, b.x) AS x FROM b{k} AS b LEFT JOIN (
        SELECT c.part, c.pos, CAST(n{k}.best % {ENTRIES} AS BIGINT) AS e, CAST(sum(c.x) AS BIGINT) AS s, count(*) AS n
        FROM c JOIN n{k} ON c.rn = n{k}.rn AND c.part = n{k}.part GROUP BY ALL) AS m ON m.part = b.part AND m.pos = b.pos AND m.e = b.e)"""
            )
    usual = "embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0"
    width = f"(len(embedding) // {PARTS})"
    last, listing = f"n{ROUNDS}", ", ".join(steps)
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS rn, vec_id, label, embedding FROM embeddings WHERE {usual}),
c AS MATERIALIZED (SELECT rn, (i - 1) // {width} AS part, (i - 1) % {width} AS pos, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT rn, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM k)),
b0 AS MATERIALIZED (SELECT part, pos, rn AS e, x FROM c WHERE rn < {ENTRIES}),
{listing},
r AS (SELECT rn, string_agg(printf('%02x', CAST(best % {ENTRIES} AS BIGINT)), '' ORDER BY part) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM {last} GROUP BY rn),
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, e, pos)) AS sha FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha FROM h) AS codebooks_sha256
FROM r JOIN k ON k.rn = r.rn
"""


ORACLE = _oracle()
