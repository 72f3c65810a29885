"""Links between all similar nodes that share a band.

The members of a band are dealt into tiles of bounded size.  A task compares the texts of a tile exactly, by the
weighted Jaccard similarity of their shingles, and keeps its own union-find: texts that are in one
component already need no comparison, and only the links that join two components leave the task - fewer than the tile has
members, however many of them are alike.  So no row is formed for a pair of texts.

Bands with the same members are compared once.  Bands of one tile are done after that.  In larger ones, first the
components' least members are compared with each other, and at last each two tiles of a band that still hold different components, each such
pair of tiles in a row and a task of its own.  So every pair of texts that shares a band is compared, or is in one component already; none is
lost to the size of its band.  What grows with the square of a band are comparisons between its different components; this is the price of losing no link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import broadcast_if_small, by_batch, forget, written
from tallyspark.llm.components import components

#: Members of a tile, and the sum of their sizes (characters or shingles), about.
TILE, TILE_SIZE = 1024, 1 << 20
#: Tiles of so many members at most are compared pair by pair.
FEW = 8

#: Texts -> for each shingle of each text its text's number and a hash of 64 bits, with repeats, in the order of texts.
Cut = Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]]


class Sets:
    """Multisets of the shingles of some texts, ordered by size."""

    def __init__(self, of_text: np.ndarray, ids: np.ndarray, n: int, width: int, weighted: bool):
        key, count = np.unique(of_text * width + ids, return_counts=True)
        text, self.ids = np.divmod(key, width)
        self.counts = count if weighted else np.ones(len(count), np.int64)
        self.ends = np.searchsorted(text, np.arange(n), "right")
        self.begins = np.searchsorted(text, np.arange(n), "left")
        total = np.concatenate([[0], np.cumsum(self.counts)])
        self.sizes = total[self.ends] - total[self.begins]

    def common(self, held: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Size of the intersection of each of ``some`` sets with the one whose counts are ``held``."""
        begins, widths = self.begins[some], (self.ends - self.begins)[some]
        at = np.repeat(begins - np.cumsum(widths) + widths, widths) + np.arange(widths.sum())
        return np.add.reduceat(np.minimum(held[self.ids[at]], self.counts[at]), np.cumsum(widths) - widths)


Tile = tuple[Sequence[int], Sequence[int], list[np.ndarray]]  # nodes, roots, hashes of the shingles of each


def hashes_of(cut: Cut, texts: Sequence[str]) -> list[np.ndarray]:
    of_text, hashes = cut(texts)
    ends = np.searchsorted(of_text, np.arange(len(texts) + 1))
    return [hashes[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def spanning(least: float, weighted: bool, left: Tile, right: Tile | None = None) -> Iterator[tuple[int, int]]:
    """Links of similar texts that join components: within one tile, or between two."""
    nodes, roots, hashes = left if right is None else tuple([*a, *b] for a, b in zip(left, right))
    compare = _few if len(nodes) <= FEW else _many
    yield from compare(least, weighted, nodes, roots, hashes, len(left[0]) if right is not None else None)


def _few(least: float, weighted: bool, nodes: Sequence[int], roots: Sequence[int], hashes: list[np.ndarray], border: int | None) -> Iterator[tuple[int, int]]:
    """Pair by pair, for tiles so small that their sets need no common numbering."""
    sets = [np.unique(h, return_counts=weighted) for h in hashes]
    sizes = [int(s[1].sum()) if weighted else len(s) for s in sets]
    component = list(roots)
    order = sorted((i for i, n in enumerate(sizes) if n), key=sizes.__getitem__)
    for place, x in enumerate(order):
        for y in order[place + 1 :]:
            if component[x] == component[y] or border is not None and (x < border) == (y < border):
                continue
            if sizes[x] < least * sizes[y] - 1e-9:
                break
            if weighted:
                _, i, j = np.intersect1d(sets[x][0], sets[y][0], assume_unique=True, return_indices=True)
                common = int(np.minimum(sets[x][1][i], sets[y][1][j]).sum())
            else:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if common / (sizes[x] + sizes[y] - common) >= least:
                yield int(nodes[x]), int(nodes[y])
                component = [component[x] if c == component[y] else c for c in component]


def _many(least: float, weighted: bool, nodes: Sequence[int], roots: Sequence[int], hashes: list[np.ndarray], border: int | None) -> Iterator[tuple[int, int]]:
    """One text against all larger ones at a time."""
    nodes = np.asarray(nodes)
    component = np.unique(np.asarray(roots), return_inverse=True)[1]
    of_text, every = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes]), np.concatenate(hashes)
    ids = np.unique(every, return_inverse=True)[1] if len(every) else every.astype(np.int64)
    width = int(ids.max()) + 1 if len(ids) else 1
    sets = Sets(of_text, ids, len(hashes), width, weighted)
    order = np.argsort(sets.sizes, kind="stable")
    order = order[sets.sizes[order] > 0]
    sizes = sets.sizes[order]
    held = np.zeros(width, np.int64)
    for place, x in enumerate(order):
        # The larger ones that are not too large, of another component and, between tiles, of the other tile.
        end = np.searchsorted(sizes, sizes[place] / least + 1e-9, "right")
        some = order[place + 1 : end]
        some = some[component[some] != component[x]]
        if border is not None:
            some = some[(some < border) != (x < border)]
        if not len(some):
            continue
        own = slice(sets.begins[x], sets.ends[x])
        held[sets.ids[own]] = sets.counts[own]
        common = sets.common(held, some)
        held[sets.ids[own]] = 0
        for y in some[common / (sets.sizes[x] + sets.sizes[some] - common) >= least]:
            if component[y] != component[x]:
                yield int(nodes[x]), int(nodes[y])
                component[component == component[y]] = component[x]


def _compared(rows: DataFrame, cut: Cut, least: float, weighted: bool) -> DataFrame:
    """Links found in rows of ``left`` and ``right`` (null: within ``left``), arrays of node, root and text."""

    def make():
        def found(tiles: list[list[tuple]]) -> Iterator[tuple[int, int]]:
            # Shingles are cut for many tiles at once.
            hashes = iter(hashes_of(cut, [text for row in tiles for tile in row for text in tile[2]]))
            for row in tiles:
                yield from spanning(least, weighted, *[(nodes, roots, [next(hashes) for _ in texts]) for nodes, roots, texts in row])

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            links: list[tuple[int, int]] = []
            held, size = [], 0
            for sides in zip(batch.column(0), batch.column(1)):
                row = [tuple(x.to_pylist() for x in items.values.flatten()) for items in sides if items.is_valid]
                held.append(row)
                size += sum(len(text) for tile in row for text in tile[2])
                if size >= TILE_SIZE:
                    links += found(held)
                    held, size = [], 0
            if held:
                links += found(held)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], names=["a", "b"])

        return step

    return rows.select("left", "right").mapInArrow(by_batch(make), "a long, b long")


def _different(members: DataFrame) -> DataFrame:
    """One ``band`` for each set of at least two members, with their number ``n`` and sizes' sum ``size``."""
    seed = lambda k: F.bit_xor(F.xxhash64("node", F.lit(k)))
    bands = members.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("size"), seed(1).alias("x"), seed(2).alias("y"))
    return bands.filter("n > 1").groupBy("n", "size", "x", "y").agg(F.min("band").alias("band")).select("band", "n", "size")


def _parts() -> Column:
    return F.greatest(F.ceil(F.col("n") / TILE), F.ceil(F.col("size") / TILE_SIZE), F.lit(1))


def _tiled(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``band``, ``part`` and ``items`` of rows of ``band``, ``node``, ``root`` and the number ``parts`` of tiles."""
    part = F.pmod(F.xxhash64("node", "band"), F.col("parts")).cast("int")
    items = F.collect_list(F.struct("node", "root", "text")).alias("items")
    return rows.withColumn("part", part).join(texts, "node").groupBy("band", "part").agg(items, F.first("parts").cast("int").alias("parts"))


def _within(tiles: DataFrame) -> DataFrame:
    items = tiles.filter(F.size("items") > 1).select(F.col("items").alias("left"))
    return items.withColumn("right", F.lit(None).cast(items.schema["left"].dataType))


def _between(tiles: DataFrame) -> DataFrame:
    """Each two tiles of a band, dealt by the pair."""
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    first = tiles.select("band", F.col("part").alias("i"), F.explode(F.filter(others, lambda j: j > F.col("part"))).alias("j"), F.col("items").alias("left"))
    second = tiles.select("band", F.explode(F.filter(others, lambda i: i < F.col("part"))).alias("i"), F.col("part").alias("j"), F.col("items").alias("right"))
    return first.join(second, ["band", "i", "j"]).select("left", "right")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open(rows: DataFrame) -> DataFrame:
    """Rows of the bands that still hold several components."""
    several = rows.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("band")
    return rows.join(broadcast_if_small(written(several, "open-bands")), "band")


def link(members: DataFrame, texts: Callable[[DataFrame], DataFrame], cut: Cut, least: float, weighted: bool = False, turns: int = 1) -> DataFrame:
    """``node`` and ``root`` of the nodes that are linked to others.

    ``members`` is a table of ``written``, which is deleted once it is used: ``node``, ``band`` and ``size`` (characters or shingles of
    the node's text); ``texts`` gives ``node`` and ``text`` of the given nodes, at least; ``cut`` makes the shingles.  The bands come in
    ``turns``, so that texts travel for a part of them at a time, and later ones only for bands that still hold different components.
    """
    bands = written(_different(members).withColumn("parts", _parts()), "bands")
    rows = written(members.join(broadcast_if_small(bands.select("band", "parts")), "band"), "crowded")
    forget(members)
    own = texts(rows.select("node").distinct())
    compared = lambda tiles: _compared(tiles, cut, least, weighted)
    links = roots = None
    for turn in range(turns):
        now = rows.filter(F.pmod("band", F.lit(turns)) == turn)
        now = _open(_rooted(now, roots)) if turn else now.withColumn("root", F.col("node"))
        found = compared(_within(_tiled(now, own)))
        links = written(links.unionByName(found) if turn else found, "links")
        roots = written(components(links), "roots")
    large = rows.filter("parts > 1")
    if large.isEmpty():
        return roots
    # The least member of each component of a large band speaks for it.
    left = written(_open(_rooted(large, roots)), "open")
    heads = left.groupBy("band", "root").agg(F.min("node").alias("node"), F.min_by("size", "node").alias("size"))
    counts = written(heads.groupBy("band").agg(F.count("*").alias("n"), F.sum("size").alias("size")).select("band", _parts().alias("parts")), "heads")
    heads = written(heads.join(broadcast_if_small(counts), "band"), "head-rows")
    links = written(links.unionByName(compared(_within(_tiled(heads, own)))), "links")
    roots = written(components(links), "roots")
    left = written(_open(_rooted(left.drop("root"), roots)), "open")
    if left.isEmpty():
        return roots
    tiles = written(_tiled(left, own), "tiles")
    links = written(links.unionByName(compared(_between(tiles))), "links")
    return written(components(links), "roots")
