"""Source divergence audit: how the words of each source differ from the other sources of its language.

Identical texts of a language are collapsed into one with the number of its copies in each source,
so that each text is cut into terms once, however often it was copied; its terms then count for
every copy, in the sources' counts and in the numbers of documents.  Terms are runs of ASCII
letters and of any characters beyond ASCII, with A-Z in lower case.  A language keeps the terms that
at least ``LEAST_DOCS`` of its documents hold, V of them; a group with N occurrences of these gives
each the smoothed share ``p = 1 + floor(10^9 (count + 1) / (N + V))``, and two groups differ by
``floor((p - q)^2 / q)``, summed over the terms (``pair``) or term by term against the language (``term``).

The sum over all terms of a pair is made from occurring terms only.  Where neither source has a
term the summand is the same for all such terms; where one has it, it depends on the term's
share alone, so equal shares are counted first; what is left are the terms of both sources, which are
compared in tiles of at most ``TILE`` by ``TILE`` sources, with one matrix of sums for each pair of tiles
in each task.  So rows are formed for groups' terms and for pairs of groups (these are the result), never for
pairs of documents.

Whole texts are read and nothing is sampled; only the ``term`` report ends at rank ``TOP``.  Defined results: null
``text``, ``lang`` and ``source`` are empty strings; a group without kept terms has shares from the smoothing
alone, and 0 everywhere in a language that keeps no term; equal values are ranked by the item's bytes;
repeated rows count each; an empty table gives no rows; other columns are not read.  Sums are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import broadcast_if_small, written

LEAST_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
TILE = 64
#: Bytes of text that are cut at once, and pairs of source and term that are summed at once.
CHUNK_BYTES, CHUNK_ROWS = 32 << 20, 1 << 22

# Letters in lower case and bytes beyond ASCII stay; all else parts terms.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _groups_of(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lang``, ``source`` and ``text`` without nulls, and the text's ``key``."""
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*plain).withColumn("key", F.unhex(F.md5("text")))


def collapsed(docs: DataFrame) -> DataFrame:
    """``lang``, ``text`` and ``copies`` (structs of ``source`` and ``n``), one row for each different text of a language.

    Only texts that occur more than once are shuffled, if the keys of these are few enough to be sent to all tasks.
    """
    rows = _groups_of(docs)
    repeated = rows.groupBy("lang", "key").agg(F.count("*").alias("n")).filter("n > 1").select("lang", "key")
    repeated = broadcast_if_small(written(repeated, "divergence-repeated"))
    single = rows.join(repeated, ["lang", "key"], "left_anti").select("lang", "text", F.array(F.struct("source", F.lit(1).cast("long").alias("n"))).alias("copies"))
    rows = rows.join(repeated, ["lang", "key"], "left_semi")
    copies = rows.groupBy("lang", "key", "source").agg(F.count("*").alias("n"))
    copies = copies.groupBy("lang", "key").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = rows.groupBy("lang", "key").agg(F.first("text").alias("text"))
    return single.union(texts.join(copies, ["lang", "key"]).select("lang", "text", "copies"))


def _terms(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """Number of the text of each term of the texts, and the terms."""
    data = np.frombuffer("\n".join(texts).encode().translate(_FOLD) + b" ", np.uint8)
    # The line break between two texts is folded too; lengths tell the texts apart.
    sizes = np.fromiter((len(t.encode()) if not t.isascii() else len(t) for t in texts), np.int64, len(texts))
    inside = data != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    text = np.searchsorted(np.cumsum(sizes + 1), starts, "right")
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return text, pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])


def _summed(lang: str, texts: list[str], sources: list[list[str]], numbers: list[list[int]], most: int) -> Iterator[pa.RecordBatch]:
    """Counts of the terms of some texts of a language, for each source."""
    text, terms = _terms(texts)
    encoded = terms.dictionary_encode()
    words = encoded.dictionary
    if not len(words):
        return
    # Once per text and term, in the order of texts.
    pair, times = np.unique(text * len(words) + encoded.indices.to_numpy(), return_counts=True)
    begins = np.searchsorted(pair, np.arange(len(texts) + 1) * len(words))
    names = pa.array([s for each in sources for s in each], pa.string()).dictionary_encode()
    of_text = np.repeat(np.arange(len(texts)), [len(s) for s in sources])
    weight = np.fromiter((n for each in numbers for n in each), np.int64, len(of_text))
    width = begins[of_text + 1] - begins[of_text]
    cut = np.flatnonzero(np.diff(np.cumsum(width) // most)) + 1
    for part in np.split(np.arange(len(of_text)), cut):
        sizes = width[part]
        at = np.repeat(begins[of_text[part]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        key = np.repeat(names.indices.to_numpy()[part].astype(np.int64), sizes) * len(words) + pair[at] % len(words)
        order = np.argsort(key, kind="stable")
        found, first = np.unique(key[order], return_index=True)
        weights = np.repeat(weight[part], sizes)[order]
        docs, count = (np.add.reduceat(x, first) if len(first) else np.zeros(0, np.int64) for x in (weights, weights * times[at][order]))
        source, term = names.dictionary.take(pa.array(found // len(words))), words.take(pa.array(found % len(words)))
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(lang, pa.string()), len(found)), source, term, pa.array(count), pa.array(docs)],
            names=["lang", "source", "term", "count", "docs"],
        )


def _count(chunk_bytes: int, chunk_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts, copies = (batch.column(k).to_pylist() for k in range(3))
            by_lang: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                by_lang.setdefault(lang, []).append(i)
            for lang, rows in by_lang.items():
                held, size = [], 0
                for i in rows:
                    held.append(i)
                    size += len(texts[i])
                    if size >= chunk_bytes or i == rows[-1]:
                        sources, numbers = ([[c[name] for c in copies[j]] for j in held] for name in ("source", "n"))
                        yield from _summed(lang, [texts[j] for j in held], sources, numbers, chunk_rows)
                        held, size = [], 0

    return run


def term_counts(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``lang``, ``source``, ``term``, its ``count`` and the number ``docs`` of the documents with it."""
    found = collapsed(docs).mapInArrow(_count(chunk_bytes, chunk_rows), "lang string, source string, term string, count long, docs long")
    # Each task has summed its chunks: a key has a row for each chunk at most, and summing once more before the shuffle is in vain.
    found = found.repartition("lang", "source", "term")
    return found.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def _exact(name: str, total: str = "total", kept: str = "kept") -> Column:
    """The smoothed share of ``name`` occurrences."""
    return F.expr(f"1 + (cast({name} + 1 as decimal(20, 0)) * cast({SCALE} as decimal(10, 0))) div cast({total} + {kept} as decimal(20, 0))")


def _differ(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _whole(sql: str) -> Column:
    """The sum of a long expression, without a bound."""
    return F.sum(F.expr(sql).cast("decimal(38, 0)"))


def _meeting(tile: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For pairs of sources, what their common terms add to the sum of the terms seen apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "no", "other", "value"]
        sums: dict[tuple[str, int, int], np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, one, other), sum_ in sums.items():
                a, b = np.nonzero(sum_)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(a)), pa.array(a + one * tile), pa.array(b + other * tile), pa.array(sum_[a, b])], names=names
                )
            sums.clear()

        for batch in batches:
            langs, tiles, with_tiles = (batch.column(k).to_pylist() for k in range(3))
            flat = []
            for k in (3, 4):
                lists = batch.column(k)
                values = [x.to_numpy() for x in lists.values.flatten()]
                flat.append((lists.offsets.to_numpy(), *values))
            (at, no, p, z), (with_at, with_no, q, with_z) = flat
            for i, key in enumerate(zip(langs, tiles, with_tiles)):
                if key not in sums:
                    if len(sums) >= 256:
                        yield from rows()
                    sums[key] = np.zeros((tile, tile), np.int64)
                x, y = slice(at[i], at[i + 1]), slice(with_at[i], with_at[i + 1])
                left, right = (p[x, None], z[x, None]), (q[None, y], with_z[None, y])
                apart = lambda a, b: (a - b) * (a - b) // b
                value = apart(left[0], right[0]) - apart(left[0], right[1]) - apart(left[1], right[0]) + apart(left[1], right[1])
                sums[key][np.ix_(no[x] % tile, with_no[y] % tile)] += value
        yield from rows()

    return run


def _pairs(shares: DataFrame, groups: DataFrame, tile: int) -> DataFrame:
    """``lang``, ``source``, ``item``, ``value`` of all pairs of sources of a language."""
    one = groups.select("lang", "no", "source", "kept", F.col("zero").alias("z"))
    other = groups.select("lang", F.col("no").alias("other"), F.col("source").alias("item"), F.col("zero").alias("y"))
    value = "decimal(38, 0)"
    plain = one.join(other, "lang").filter("no <> other")
    nowhere = plain.select("lang", "no", "other", F.expr(f"coalesce(cast(kept as {value}) * ({_differ('z', 'y')}), 0)").cast(value).alias("value"))
    # A term of one source only: equal shares are counted before they meet the other sources.
    equal = shares.groupBy("lang", "no", "p", "zero").agg(F.count("*").alias("n"))
    met = equal.join(broadcast_if_small(other), "lang").filter("no <> other").groupBy("lang", "no", "other")
    single = met.agg(
        _whole(f"n * ({_differ('p', 'y')} - {_differ('zero', 'y')})").alias("here"), _whole(f"n * ({_differ('y', 'p')} - {_differ('y', 'zero')})").alias("there")
    )
    single = written(single, "divergence-single")
    single = single.select("lang", "no", "other", "here").union(single.select("lang", "other", "no", "there"))
    # Terms of both.
    numbered = shares.withColumn("tile", F.floor(F.col("no") / tile).cast("int")).repartition("lang", "term")
    lists = numbered.groupBy("lang", "term", "tile").agg(F.collect_list(F.struct("no", "p", F.col("zero").alias("z"))).alias("left"))
    right = lists.select("lang", "term", F.col("tile").alias("with_tile"), F.col("left").alias("right"))
    both = lists.join(right, ["lang", "term"]).filter("tile <> with_tile or size(left) > 1")
    common = both.select("lang", "tile", "with_tile", "left", "right").mapInArrow(_meeting(tile), "lang string, no long, other long, value long")
    common = common.filter("no <> other").withColumn("value", F.col("value").cast(value))
    summed = nowhere.union(single).union(common).groupBy("lang", "no", "other").agg(F.sum("value").cast("long").alias("value"))
    names = groups.select("lang", "no", "source")
    named = summed.join(broadcast_if_small(names), ["lang", "no"])
    return named.join(broadcast_if_small(names.select("lang", F.col("no").alias("other"), F.col("source").alias("item"))), ["lang", "other"]).select(
        "lang", "source", "item", "value"
    )


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, tile: int = TILE, chunk_bytes: int = CHUNK_BYTES, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``: all pairs of sources, and up to ``top`` terms of each source."""
    counts = written(term_counts(docs, chunk_bytes, chunk_rows), "divergence-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("all")).filter(F.col("docs") >= least_docs)
    terms = written(terms.select("lang", "term", "all"), "divergence-terms")
    kept = written(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "count", "all"), "divergence-kept")
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = _groups_of(docs).select("lang", "source").distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    groups = groups.withColumn("zero", F.when(F.col("kept") > 0, _exact("0")))
    groups = written(groups.withColumn("no", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1), "divergence-groups")
    shares = kept.join(broadcast_if_small(groups), ["lang", "source"]).withColumns({"p": _exact("count"), "q": _exact("all", "lang_total")})
    shares = written(shares.select("lang", "source", "no", "term", "p", "q", "zero"), "divergence-shares")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(shares, groups, tile).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(ranked)})
    more = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_differ("p", "q")).alias("value"))
    more = more.withColumns({"part": F.lit("term"), "rank": F.row_number().over(ranked)}).filter(F.col("rank") <= top)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).union(more.select(*columns))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v ON w.lang = v.lang AND w.term = v.term GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM v GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
        (1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(t.n, 0) + l.v))::HUGEINT AS p,
        (1 + CAST(1000000000 AS HUGEINT) * (v.n + 1) // (l.n + l.v))::HUGEINT AS q
    FROM g JOIN v ON g.lang = v.lang JOIN l ON l.lang = g.lang
    LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(f.value, 0)::BIGINT AS value
    FROM g JOIN g AS o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = o.source
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM u QUALIFY part = 'pair' OR rank <= 200
"""
