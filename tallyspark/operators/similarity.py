"""Nearest reference texts and vectors, exactly, as distributed joins.

Nothing is capped or sampled.  Both kinds of search work the same way; how
many blocks the bounds rule out depends on the data.  Where vectors do not cluster,
the bounds of the exact search rule out few, and its work then grows with queries times
references, as dense block products:

1. References are cut into blocks of bounded size that hold similar ones:
   neighbouring texts in sort order, or vectors around a centre.
2. The most promising blocks of a query are scored; the k-th best similarity found is a
   lower bound of the final one.
3. Only blocks whose references can still reach it are scored as well: those with one of the
   query's leading rare grams, or whose distance from the centre allows it.

A block that many queries ask for is scored in several chunks of queries, so a
crowd around one text or vector spreads over tasks.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.session import broadcast_if_small, forget, materialized, written

# References per block and queries per chunk, in grams: a block travels once for each chunk of queries that ask for it.
BLOCK_GRAMS = 2_000_000
CHUNK_GRAMS = 1_500_000
# Fewer grams than this make no chunk of their own for the sake of idle cores.
LEAST_CHUNK = 200_000
# Grams that travel at a time, for each gram of the texts on both sides.
TRAVEL = 1.5
# Rarest grams of a query that choose the blocks to begin with: so many that frequent words have a say as well.
SEEDS = 64
# Grams are looked up in blocks until less than this share of the bound is left of a query's vector.
LOOKED_UP = 0.25
# Held grams that are added up inside a block for a first bound, for each neighbour wanted.
SUMMED = 128
# Blocks of all grams that are broadcast together, at most: 16 bytes each.
PEAK_ROWS = 4_000_000
BUCKET_ROWS = 4_096
# References that place the centres, leaves of their tree at most, and leaves that a query is compared with first.
CENTRE_SAMPLE = 20_000
THINNING = 1_000_000
MOST_LEAVES = 65_536
FIRST_CELLS = 3
EPS = 1e-9
DIGITS = 10


# Grams of a vocabulary that is broadcast, at most: about 100 bytes each.
VOCABULARY_ROWS = 1_000_000


# ------------------------------------------------------------------ term weights


def gram_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, gram, tf)`` of char 3-5-grams inside blank-padded words.

    The texts travel once, by key, and are counted key by key; a task holds the grams of one key.
    """
    kind = texts.schema[key].dataType.simpleString()
    rows = texts.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    counted = rows.repartition("_key").sortWithinPartitions("_key").mapInArrow(_gram_counter(), f"_key {kind}, gram string, tf long")
    return counted.withColumnRenamed("_key", key)


def _cutter():
    def cut(word: str) -> list[str]:
        padded = f" {word} "
        return [padded[i : i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)]

    return cut


def _gram_counter():
    """Counts of each key's grams in batches sorted by key.

    Grams are cut from each distinct word and carry its count.  Built as a closure, so that it reaches the workers by value.
    """

    cut = _cutter()

    def count(batches):
        grams_of = functools.lru_cache(100_000)(cut)
        key, counts, keys, sizes, grams, tfs = None, {}, [], [], [], []

        def done():
            keys.append(key)
            sizes.append(len(counts))
            grams.extend(counts)
            tfs.extend(counts.values())

        def batch_of(kind):
            named = pa.array(keys, kind).take(pa.array(np.repeat(np.arange(len(keys)), sizes)))
            made = pa.RecordBatch.from_arrays([named, pa.array(grams, pa.string()), pa.array(tfs, pa.int64())], ["_key", "gram", "tf"])
            for held in (keys, sizes, grams, tfs):
                held.clear()
            return made

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for k, held in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != key:
                    done()
                    key, counts = k, {}
                    if len(grams) > 50_000:
                        yield batch_of(kind)
                for word, n in Counter((held or "").split(" ")).items():
                    if word:
                        for gram in grams_of(word):
                            counts[gram] = counts.get(gram, 0) + n
        if kind is not None:
            done()
            yield batch_of(kind)

    return count


def idf_table(counts: DataFrame, documents: Column) -> DataFrame:
    """``(gram, df, idf)`` with smoothing as if one more text held every gram."""
    return (
        counts.groupBy("gram")
        .agg(F.count(F.lit(1)).alias("df"))
        .withColumn("idf", F.log((F.lit(1) + documents) / (F.lit(1) + F.col("df"))) + 1)
    )


def unit_weights(counts: DataFrame, idf: DataFrame, key: str, tf: Column | None = None) -> DataFrame:
    """TF-IDF weights with L2 norm 1 per key; grams outside the vocabulary are dropped first."""
    tf = F.col("tf").cast("double") if tf is None else tf
    raw = counts.join(idf, "gram").withColumn("w", tf * F.col("idf"))
    # The window holds the grams of one text.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.withColumn("w", F.col("w") / norm)


def char_tfidf(texts: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, gram, tf, df, idf, w)`` of texts that are their own reference."""
    counts = materialized(gram_counts(texts, key, text), "grams")
    idf = materialized(idf_table(counts, texts.agg(F.count(F.lit(1))).scalar()), "idf")
    return unit_weights(counts, broadcast_if_small(idf, VOCABULARY_ROWS), key)


# ----------------------------------------------------------------- sparse neighbours


def nearest_texts(queries: DataFrame, references: DataFrame, k: int = 5) -> DataFrame:
    """``(query, reference, similarity, rank)``: the k nearest references of every query text.

    Both inputs have one column ``text`` of distinct, non-empty texts.
    Similarities are rounded to ten digits, so that equal texts tie on every
    machine; ties go to the alphabetically first reference.

    Grams have one order, rare ones first.  The block that a query's grams speak for most is scored;
    it gives a lower bound of its k-th best similarity.  If the first gram that a reference shares with the query is g,
    their similarity is at most the product of the lengths of both vectors from g on.  So only blocks whose references can
    still reach the bound are asked, and there only references are scored that the query's rare grams bring near it.
    """
    asked_texts, ref_texts = numbered(queries, "query"), numbered(references, "reference")
    ref_lists, asked_lists = _weighted_texts(asked_texts, ref_texts)
    peaks = written(_single(ref_lists, "rw").groupBy("gid", "block").agg(F.max("rw").alias("peak"), F.max("rest").alias("ref_rest")), "peaks")
    # Both turns read these; what only the bounds need is not kept.
    ref_rows = written(_packed(ref_lists, ["reference", "block"], "rw"), "ref-texts")
    forget(ref_lists)
    asked = _single(asked_lists, "w")
    first = written(first_blocks(asked, peaks), "first-blocks")
    asked_rows = written(_packed(asked_lists, ["query"], "w"), "query-texts")
    bound = written(kth_best(_score_texts(first, asked_rows, ref_rows, k), "query", "similarity", k), "bounds")
    # What reached the bound in the first block is found again, so these need no union.
    bounded = _single(asked_lists.join(bound, "query", "left"), "w")
    wanted = written(open_blocks(bounded, peaks, bound).join(bound, "query", "left"), "open-blocks")
    for done in (asked_lists, peaks, first, bound):
        forget(done)
    scores = written(_score_texts(wanted, asked_rows, ref_rows, k), "scores")
    for done in (ref_rows, asked_rows, wanted):
        forget(done)
    # Numbers follow the alphabet, so they break ties as the texts would.
    best = top_k(scores, "query", [F.desc("similarity"), F.asc("reference")], k)
    named = best.join(_names(asked_texts, "query"), "query").join(_names(ref_texts, "reference"), "reference")
    return named.select(F.col("query_text").alias("query"), F.col("reference_text").alias("reference"), "similarity", "rank")


def numbered(texts: DataFrame, key: str) -> DataFrame:
    """``key`` (a number, in the order of the texts), ``text`` and ``block``: runs of neighbouring texts of about ``BLOCK_GRAMS`` grams."""
    ordered = texts.select("text").repartitionByRange("text").sortWithinPartitions("text")
    ids = ordered.select(F.monotonically_increasing_id().alias(key), F.spark_partition_id().alias("range"), "text")
    running = Window.partitionBy("range").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    # A text has at most three grams for each character and blank.
    grams = F.sum(3 * (F.length("text") + 2)).over(running)
    block = (F.col("range").cast("long") * 10_000_000 + F.floor(grams / BLOCK_GRAMS)).alias("block")
    own = written(ids, "numbered")
    made = written(own.select(key, "text", block), "blocks")
    forget(own)
    return made


def _names(texts: DataFrame, key: str) -> DataFrame:
    return texts.select(key, F.col("text").alias(f"{key}_text"))


def _weighted_grams(queries: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Unit weights of both sides by gram id, with the length of the vector from each gram on.

    References also carry their block, the grams of queries their ``place`` from the rarest on.
    """
    refs, asked = _weighted_texts(queries, references)
    return _single(refs, "rw"), _single(asked, "w")


def _weighted_texts(queries: DataFrame, references: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per text: ``gids`` from the rarest gram on, their ``weights`` and ``rests`` (see ``_rester``).

    Only the different grams of a block travel, to the vocabulary and back to the block's texts.
    """
    counts = written(_block_grams(references), "ref-grams")
    # Numbered from the rarest gram on.
    total = references.agg(F.count(F.lit(1))).scalar()
    ordered = counts.groupBy("gram").agg(F.sum("n").alias("df")).withColumn("idf", F.log((F.lit(1) + total) / (F.lit(1) + F.col("df"))) + 1)
    vocabulary = written(ordered.orderBy("df", "gram").select("gram", "idf", F.monotonically_increasing_id().alias("gid")), "vocabulary")
    words = broadcast_if_small(vocabulary)
    refs = written(_weighed(references, "reference", counts.join(words, "gram")), "ref-weights")
    forget(counts)
    asked = written(_weighed(queries, "query", _block_grams(queries).join(words, "gram")).drop("block"), "query-weights")
    forget(vocabulary)
    return refs, asked


def _block_grams(texts: DataFrame) -> DataFrame:
    """``(block, gram, n)``: the different grams of each block and the number of its texts that hold them."""
    cut = _cutter()

    def count(table: pa.Table) -> pa.Table:
        grams_of, counts = functools.lru_cache(100_000)(cut), Counter()
        for held in table.column("text").to_pylist():
            counts.update({gram for word in held.split(" ") if word for gram in grams_of(word)})
        block = pa.array(np.full(len(counts), table.column("block")[0].as_py()), pa.int64())
        return pa.table({"block": block, "gram": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    return texts.select("block", "text").groupBy("block").applyInArrow(count, "block long, gram string, n long")


def _weighed(texts: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """Block, ``key``, ``gids``, ``weights`` and ``rests`` of the texts with a gram in ``words`` (block, gram, gid, idf)."""
    cut, rester = _cutter(), _rester()

    def weigh(rows: pa.Table, known: pa.Table) -> pa.Table:
        gid, idf = known.column("gid").to_numpy(), known.column("idf").to_numpy()
        place = dict(zip(known.column("gram").to_pylist(), range(len(gid))))

        @functools.lru_cache(100_000)
        def places(word: str) -> list[int]:
            return [place[gram] for gram in cut(word) if gram in place]

        kept, sizes, ids, weights, rests = [], [0], [np.zeros(0, "int64")], [np.zeros(0)], [np.zeros(0, "float32")]
        for row, held in enumerate(rows.column("text").to_pylist()):
            found = [at for word in held.split(" ") if word for at in places(word)]
            if found:
                at, tf = np.unique(found, return_counts=True)
                at, tf = at[order := np.argsort(gid[at])], tf[order]
                w = tf * idf[at]
                w /= np.sqrt((w * w).sum())
                kept.append(row)
                sizes.append(len(w))
                for lists, value in ((ids, gid[at]), (weights, w), (rests, rester(w))):
                    lists.append(value)
        ends = pa.array(np.cumsum(sizes), pa.int32())
        lists = {name: pa.ListArray.from_arrays(ends, pa.array(np.concatenate(v))) for name, v in (("gids", ids), ("weights", weights), ("rests", rests))}
        return pa.table({**{c: rows.column(c).take(pa.array(kept, pa.int64())) for c in ("block", key)}, **lists})

    return (
        texts.select("block", key, "text")
        .groupBy("block")
        .cogroup(words.select("block", "gram", "gid", "idf").groupBy("block"))
        .applyInArrow(weigh, f"block long, {key} long, gids array<long>, weights array<double>, rests array<float>")
    )


def _rester():
    """Length of a vector from each gram on, rare grams first, rounded up: it only serves as an upper bound."""

    def rests(w):
        return np.nextafter(np.sqrt(np.cumsum((w * w)[::-1])[::-1]).astype("float32"), np.float32(np.inf))

    return rests


def _single(texts: DataFrame, weight: str) -> DataFrame:
    """A row for each gram of ``_weighted_texts``: keys, ``gid``, ``weight``, ``rest`` and ``place`` from the rarest on."""
    keys = [c for c in texts.columns if c in ("reference", "query", "block", "bound")]
    grams = F.arrays_zip("gids", "weights", "rests")
    rows = texts.select(*keys, F.posexplode(grams).alias("at", "gram"))
    rest = F.col("gram.rests").cast("double").alias("rest")
    return rows.select(*keys, F.col("gram.gids").alias("gid"), F.col("gram.weights").alias(weight), rest, (F.col("at") + 1).alias("place"))


def _met(asked: DataFrame, peaks: DataFrame) -> DataFrame:
    """The grams of ``asked`` with each block that holds them, its ``peak`` and ``ref_rest``.

    Up to ``PEAK_ROWS`` they are broadcast as lists, so that a query's rows stay together and add up before they travel.
    """
    if peaks.count() > PEAK_ROWS:
        return asked.join(peaks, "gid")
    # Rounded up, as they are only used in upper bounds.
    up = [F.collect_list((F.col(c) * (1 + 1e-6)).cast("float")).alias(c) for c in ("peak", "ref_rest")]
    held = peaks.groupBy("gid").agg(F.collect_list("block").alias("block"), *up)
    rows = asked.join(F.broadcast(held), "gid").select(*asked.columns, F.explode(F.arrays_zip("block", "peak", "ref_rest")).alias("held"))
    return rows.select(*asked.columns, "held.block", F.col("held.peak").cast("double").alias("peak"), F.col("held.ref_rest").cast("double").alias("ref_rest"))


def first_blocks(asked: DataFrame, peaks: DataFrame) -> DataFrame:
    """``(query, block)``: the block that the grams of each query speak for most."""
    seeds = asked.filter(F.col("place") <= SEEDS).select("query", "gid", "w")
    reach = _met(seeds, peaks).groupBy("query", "block").agg(F.sum(F.col("w") * F.col("peak")).alias("reach"))
    return top_k(reach, "query", [F.desc("reach"), F.asc("block")], 1).select("query", "block")


def open_blocks(asked: DataFrame, peaks: DataFrame, bound: DataFrame) -> DataFrame:
    """``(query, block)``: all blocks that may hold a reference as near as the query's ``bound`` (joined, unless ``asked`` has it).

    The first shared gram must leave enough of both vectors, and the largest weights of the block's references for the
    query's grams, with all that the query's vector may have beyond those looked up, must add up to the bound.
    """
    known = asked if "bound" in asked.columns else asked.join(bound, "query", "left")
    known = known.withColumn("least", F.coalesce("bound", F.lit(0.0)) - EPS).filter(F.col("rest") >= LOOKED_UP * F.col("least"))
    reach = (
        _met(known.select("query", "gid", "w", "rest", "least"), peaks)
        .groupBy("query", "block")
        .agg(
            F.max(F.col("rest") * F.col("ref_rest")).alias("from_first"),
            F.sum(F.col("w") * F.col("peak")).alias("looked_up"),
            F.first("least").alias("least"),
        )
    )
    in_all = F.col("looked_up") + LOOKED_UP * F.greatest("least", F.lit(0.0))
    return reach.filter((F.col("from_first") >= F.col("least")) & (in_all >= F.col("least"))).select("query", "block")


def _score_texts(wanted: DataFrame, asked: DataFrame, refs: DataFrame, k: int) -> DataFrame:
    """The k best references inside each wanted (query, block), of those that reach its ``bound`` if there is one.

    A text travels as one row: its grams and weights are two arrays.  ``asked`` and ``refs`` hold grams, or are packed already.
    A block meets its chunks of queries in turns if all that travels is more than ``TRAVEL`` times the texts.
    """
    asked, refs = (rows if "gids" in rows.columns else _packed(rows, keys, w) for rows, keys, w in ((asked, ["query"], "w"), (refs, ["reference", "block"], "rw")))
    held = F.coalesce(F.sum(F.size("gids")), F.lit(0))
    if "bound" not in wanted.columns:
        wanted = wanted.withColumn("bound", F.lit(None).cast("double"))
    # The blocks that a query asks stand in its row, so its grams meet them without a join for each turn.
    asks = written(wanted.groupBy("query").agg(F.first("bound").alias("bound"), F.collect_list("block").alias("blocks")).join(asked, "query"), "asks")
    asked_grams = asks.select(F.size("gids").alias("n"), F.explode("blocks").alias("block")).groupBy("block").agg(F.sum("n").alias("asked"))
    # Few grams go in smaller chunks, so that every core has some.
    each = F.lit(2 * asks.sparkSession.sparkContext.defaultParallelism)
    per_chunk = F.least(F.lit(CHUNK_GRAMS), F.greatest(F.lit(LEAST_CHUNK), F.sum("asked").over(Window.partitionBy()) / each))
    chunks = written(asked_grams.select("block", "asked", F.ceil(F.col("asked") / per_chunk).cast("int").alias("chunks")), "chunks")
    few = broadcast_if_small(chunks)
    left = asks.select("query", "bound", "gids", "weights", F.explode("blocks").alias("block")).join(few, "block")
    left = left.withColumn("chunk", F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int")).drop("asked", "chunks")
    right = refs.join(few, "block").select(
        "reference",
        "block",
        "gids",
        "weights",
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )

    def scored(asks: DataFrame, held: DataFrame) -> DataFrame:
        groups = asks.groupBy("block", "chunk").cogroup(held.groupBy("block", "chunk"))
        return groups.applyInArrow(_block_scorer(k, SUMMED), "query long, reference long, similarity double")

    # The chunks go in turns, so that what travels at a time does not outgrow the texts.
    travel = chunks.agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0] + refs.join(few, "block").agg(F.coalesce(F.sum(F.size("gids") * F.col("chunks")), F.lit(0))).first()[0]
    turns = math.ceil(travel / max(1, TRAVEL * (refs.agg(held).first()[0] + asked.agg(held).first()[0])))
    if turns <= 1:
        return scored(left, right)
    turn = F.pmod(F.xxhash64("block", "chunk"), F.lit(turns))
    parts = [written(scored(left.filter(turn == i), right.filter(turn == i)), "turn-scores") for i in range(turns)]
    forget(asks)
    return functools.reduce(DataFrame.unionByName, parts)


def _packed(grams: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """One row per text: ``gids`` from the rarest on and their ``weights``, of single grams or of rows that hold them as lists."""
    if "gids" in grams.columns:
        return grams.select(*keys, "gids", "weights")
    pairs = F.sort_array(F.collect_list(F.struct("gid", weight))).alias("pairs")
    return grams.groupBy(*keys).agg(pairs).select(*keys, F.col("pairs.gid").alias("gids"), F.col(f"pairs.{weight}").alias("weights"))


def _block_scorer(k: int, summed: int):
    """The k best references of one block for each query of a chunk, of those that reach its bound if it has one.

    If the first gram that both share is g, their similarity is at most the product of the lengths of both vectors from g on.  The
    references that hold a gram lie in the order of that length, so only those are looked at whose product reaches the bound.  For each
    reference these grams are the first of all shared ones; their sum, with the product of what is left of both vectors after the
    last of them, must reach the bound; who does is scored in full.  A query without a bound takes one from the best sums over its
    very rarest grams.  The grams of many queries are added up at a time; a query that looks at a large part of the block is summed alone,
    reference by reference.  Built as a closure, so that it reaches the workers by value.
    """
    # Held weights and lengths are kept in 32 bits; bounds give way by so much.
    slack, at_a_time, hits_at_a_time, tried = 1e-4, 2_048, 1_000_000, 32 * k

    def lists(table: pa.Table, key: str):
        gids, weights = (table.column(c).combine_chunks() for c in ("gids", "weights"))
        size = np.diff(gids.offsets.to_numpy()).astype("int64")
        return table.column(key).to_numpy(), gids.flatten().to_numpy(), weights.flatten().to_numpy(), size, np.cumsum(size) - size

    def runs(starts, lengths):
        ends = np.cumsum(lengths)
        return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)

    def placing(code, length):
        """One number for gram and length, the greater length first: the bits of positive floats are in their order."""
        return (code.astype("uint64") << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - length.astype("float32").view("uint32"))

    def best(asks: pa.Table, held: pa.Table) -> pa.Table:
        out = {"query": [np.zeros(0, "int64")], "reference": [np.zeros(0, "int64")], "similarity": [np.zeros(0)]}
        if asks.num_rows and held.num_rows:
            names, gids, rw, size, begin = lists(held, "reference")
            by_gram = np.argsort(gids)
            in_order = gids[by_gram]
            new = np.append(True, in_order[1:] != in_order[:-1])
            vocabulary, edge = in_order[new], np.append(np.flatnonzero(new), len(gids))
            code = np.empty(len(gids), "int32")
            code[by_gram] = np.cumsum(new, dtype="int32") - 1
            del in_order, new, by_gram
            # Length of a reference's vector after each of its grams, and from it on.
            so_far = np.cumsum(rw * rw)
            left = np.maximum(so_far[np.repeat(begin + size - 1, size)] - so_far, 0.0) + 1e-10
            placed = placing(code, np.sqrt(left + rw * rw))
            by_gram = np.argsort(placed)
            placed = placed[by_gram]
            held_left = np.sqrt(left).astype("float32")[by_gram]
            held_by, held_w = np.repeat(np.arange(len(names), dtype="int32"), size)[by_gram], rw[by_gram].astype("float32")
            del by_gram, so_far, left
            # The first grams of each reference as rows of one width, a last empty gram fills up; what is longer follows in ``code``.
            width = int(min(size.max(), 2 * size.mean() + 8))
            columns = np.arange(width)
            inside = columns < size[:, None]
            places = np.where(inside, begin[:, None] + columns, 0)
            row_code, row_w = np.where(inside, code[places], np.int32(len(vocabulary))), rw[places]
            del inside, places
            dense = np.zeros(len(vocabulary) + 1)
            queries, asked_gids, asked_w, asked_size, asked_begin = lists(asks, "query")
            bounds = np.nan_to_num(asks.column("bound").to_numpy().astype(float))

            def similarity(some):
                found = np.einsum("ij,ij->i", dense[row_code[some]], row_w[some])
                longer = np.flatnonzero(size[some] > width)
                if len(longer):
                    more = size[some[longer]] - width
                    row = runs(begin[some[longer]] + width, more)
                    found[longer] += np.add.reduceat(dense[code[row]] * rw[row], np.cumsum(more) - more)
                return found

            def added(owner, at, n, w, after):
                """Query, reference, sum over the first ``n`` of the grams ``at`` and the product of the lengths left, of all who hold any."""
                hit = runs(edge[at], n)
                key = np.repeat(owner, n) * len(names) + held_by[hit]
                order = np.argsort(key)
                key, hit = key[order], hit[order]
                starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, "int64")
                if not len(starts):
                    return starts, starts, np.zeros(0), np.zeros(0)
                sums = np.add.reduceat(np.repeat(w, n)[order] * held_w[hit], starts)
                return *np.divmod(key[starts], len(names)), sums, np.minimum.reduceat(np.repeat(after, n)[order] * held_left[hit], starts)

            def keep(query, some, least):
                """The k best of ``some`` as they are scored in full; ``dense`` holds the query."""
                sims = np.round(similarity(some), DIGITS)
                near = (sims > 0) & (sims >= least)
                if np.count_nonzero(near) > k:
                    near &= sims >= -np.partition(-sims, k - 1)[k - 1]
                some, sims = some[near], sims[near]
                order = np.lexsort((names[some], -sims))[:k]
                out["query"].append(np.full(len(order), query))
                out["reference"].append(names[some[order]])
                out["similarity"].append(sims[order])

            def alone(query, bound, at, w, rest):
                """One query whose grams are held by many: sums for all references of the block."""

                def sums(grams, weights):
                    n = edge[grams + 1] - edge[grams]
                    hit = runs(edge[grams], n)
                    return np.bincount(held_by[hit], np.repeat(weights, n) * held_w[hit], len(names))

                dense[at] = w
                rest = np.append(rest, 0.0)
                taken = max(1, int(np.searchsorted(np.cumsum(edge[at + 1] - edge[at]), 2 * len(names), "right")))
                sum_ = sums(at[:taken], w[:taken])
                if np.count_nonzero(sum_) >= k:
                    bound = max(bound, similarity(np.argpartition(-sum_, k - 1)[:k]).min())
                least = bound - EPS
                needed = int(np.argmax(rest < least - slack)) if least > slack else len(at)
                if needed > taken:
                    sum_ += sums(at[taken:needed], w[taken:needed])
                    taken = needed
                some = np.flatnonzero((sum_ > 0) & (sum_ >= least - rest[taken] - slack))
                if len(some):
                    keep(query, some, least)
                dense[at] = 0.0

            for low in range(0, len(queries), at_a_time):
                high = min(low + at_a_time, len(queries))
                span = slice(asked_begin[low], asked_begin[high - 1] + asked_size[high - 1])
                at = np.minimum(np.searchsorted(vocabulary, asked_gids[span]), len(vocabulary) - 1)
                known = np.flatnonzero(vocabulary[at] == asked_gids[span])
                owner = np.repeat(np.arange(high - low), asked_size[low:high])[known]
                at, w = all_at, all_w = at[known], asked_w[span][known]
                first = np.searchsorted(owner, np.arange(high - low + 1))
                # Length of the vector from each gram on.
                so_far = np.append(0.0, np.cumsum(w * w))
                rest = np.sqrt(np.maximum(so_far[first[1:]][owner] - so_far[:-1], 0.0) + 1e-10)
                after = np.sqrt(np.maximum(so_far[first[1:]][owner] - so_far[1:], 0.0) + 1e-10)
                n = edge[at + 1] - edge[at]
                before = np.append(0, np.cumsum(n))
                bound = bounds[low:high].copy()

                def each(owners, some):
                    """Each query of ``owners`` (sorted) with its references, while ``dense`` holds its weights."""
                    starts = np.flatnonzero(np.append(True, owners[1:] != owners[:-1])) if len(owners) else []
                    for i, j in zip(starts, [*starts[1:], len(owners)]):
                        own = slice(first[owners[i]], first[owners[i] + 1])
                        dense[all_at[own]] = all_w[own]
                        yield owners[i], some[i:j], slice(i, j)
                        dense[all_at[own]] = 0.0

                open_ = bound <= 0
                if open_.any():
                    few = open_[owner] & (before[:-1] - before[first[:-1]][owner] < summed * k) & (n <= max(summed * k, len(names) // 4))
                    owners, some, sums, _ = added(owner[few], at[few], n[few], w[few], after[few])
                    for i, own, place in each(owners, some):
                        if len(own) >= k:
                            if len(own) > tried:
                                own = own[np.argpartition(-sums[place], tried - 1)[:tried]]
                            bound[i] = -np.partition(-similarity(own), k - 1)[k - 1]
                least = bound - EPS
                take = np.flatnonzero(rest >= least[owner] - slack)
                owner, at, w, after = owner[take], at[take], w[take], after[take]
                enough = np.maximum(least[owner] - slack, 0.0) / rest[take]
                n = np.searchsorted(placed, placing(at, enough), "right") - edge[at]
                hits = np.bincount(owner, n, high - low)
                many = hits > max(len(names) / 4, 1_000)
                for i in np.flatnonzero(many):
                    own = slice(first[i], first[i + 1])
                    alone(queries[low + i], bound[i], all_at[own], all_w[own], rest[own])
                hits[many] = 0
                turn = (np.cumsum(hits) // hits_at_a_time).astype("int64")
                for some_turn in np.unique(turn):
                    now = np.flatnonzero((n > 0) & ((turn == some_turn) & ~many)[owner])
                    owners, some, sums, left = added(owner[now], at[now], n[now], w[now], after[now])
                    near = np.flatnonzero(sums + left >= least[owners] - slack)
                    for i, own, _ in each(owners[near], some[near]):
                        keep(queries[low + i], own, least[i])
        return pa.table({name: np.concatenate(parts) for name, parts in out.items()})

    return best


def kth_best(scores: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """``(key, bound)``: the k-th largest score, only for keys that have k of them."""
    window = Window.partitionBy(key).orderBy(F.desc(score))
    return (
        scores.withColumn("rn", F.row_number().over(window))
        .filter(F.col("rn") <= k)
        .groupBy(key)
        .agg(F.min(score).alias("bound"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == k)
        .select(key, "bound")
    )


def top_k(scores: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    """The first k rows per key with their rank; Spark limits each map task's group first."""
    window = Window.partitionBy(key).orderBy(*order)
    return scores.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def vote(neighbours: DataFrame, references: DataFrame, key: str = "query") -> DataFrame:
    """Weighted category vote of each query's neighbours.

    ``references`` gives ``reference, category, purity``.  A neighbour weighs
    similarity times purity; confidence is the best similarity inside the
    winning category times that category's share of all weight.
    """
    voted = (
        neighbours.join(references.select("reference", "category", "purity"), "reference")
        .withColumn("weight", F.col("similarity") * F.col("purity"))
        .groupBy(key, "category")
        .agg(
            F.round(F.sum("weight"), DIGITS).alias("votes"),
            F.max("similarity").alias("top"),
            F.min("rank").alias("nearest"),
        )
    )
    best = F.max_by(
        F.struct("category", "votes", "top"), F.struct("votes", (-F.col("nearest")).alias("n"))
    )
    share = F.col("best.votes") / F.col("total")
    return (
        voted.groupBy(key)
        .agg(best.alias("best"), F.sum("votes").alias("total"))
        .filter("total > 0")
        .select(
            key,
            F.col("best.category").alias("sem_category"),
            (F.col("best.top") * share).alias("sem_confidence"),
            F.col("best.top").alias("sem_top_similarity"),
        )
    )


# ------------------------------------------------------------------ dense neighbours


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def unit_vector(v: Column) -> Column:
    """The vector at length 1; NULL for a vector of zeros, which has no direction."""
    size = F.sqrt(dot(v, v))
    return F.when(size > 0, F.transform(v, lambda x: x.cast("double") / size))


@dataclass(frozen=True)
class Centres:
    """A tree of two levels of unit vectors: ``top`` centres, and below each ``leaves`` of its own (a leaf's number is top * width + place)."""

    top: np.ndarray
    leaves: np.ndarray  # tops x width x dimensions


def _spherical_means(vectors: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """``n`` unit centres of unit vectors, begun with the first ones; fewer vectors repeat."""
    centres = vectors[np.arange(n) % len(vectors)].copy()
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        size = np.linalg.norm(sums, axis=1)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def train_centres(references: DataFrame, leaves: int, sample: int = CENTRE_SAMPLE) -> Centres | None:
    """Centres from at most ``sample`` references chosen by hash; None without references.

    The sample only decides where the centres lie.  Every reference belongs to a leaf and every bound holds for all of a
    leaf's references, so the search is exact whatever the sample.
    """
    # Thinned and cut on the executors: a collected first-rows plan would send so many rows of each partition to the driver.
    share = 2 * sample / max(references.count(), 1)
    thin = references if share >= 1 else references.filter(F.pmod(F.xxhash64("reference"), F.lit(THINNING)) < int(share * THINNING) + 1)
    rows = materialized(thin.orderBy(F.xxhash64("reference"), "reference").limit(sample).select("vector"), "centre-sample").toArrow()
    if not rows.num_rows:
        return None
    vectors = np.stack(rows["vector"].combine_chunks().to_numpy(zero_copy_only=False)).astype(float)
    width = max(1, math.ceil(math.sqrt(min(leaves, MOST_LEAVES))))
    top = _spherical_means(vectors, width)
    nearest = (vectors @ top.T).argmax(1)
    own = [vectors[nearest == i] for i in range(width)]
    return Centres(top, np.stack([_spherical_means(v if len(v) else top[i : i + 1], width) for i, v in enumerate(own)]))


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(float)


def place_vectors(references: DataFrame, centres: Centres) -> DataFrame:
    """``reference``, ``rv``, its leaf ``cell``, and its angles to the leaf's centre and to the one above."""
    kind = dict(references.dtypes)

    def place(batches):
        for batch in batches:
            if batch.empty:
                continue
            vectors = _stacked(batch["vector"])
            up = vectors @ centres.top.T
            top = up.argmax(1)
            leaf, down = np.zeros(len(top), int), np.zeros(len(top))
            for i in np.unique(top):
                below = vectors[top == i] @ centres.leaves[i].T
                leaf[top == i], down[top == i] = below.argmax(1), below.max(1)
            cell = top * len(centres.top) + leaf
            yield pd.DataFrame({"reference": batch["reference"], "rv": batch["vector"], "cell": cell, "angle": _angle(down), "top_angle": _angle(up.max(1))})

    return references.select("reference", "vector").mapInPandas(
        place, f"reference {kind['reference']}, rv {kind['vector']}, cell int, angle double, top_angle double"
    )


def _reach(angle: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The greatest cosine that anything within ``radius`` of a centre can have at ``angle`` to it; below all where there is nothing."""
    return np.where(radius < 0, -2.0, np.cos(np.maximum(angle - radius, 0.0)))


def reachable_cells(asked: DataFrame, centres: Centres, tops: np.ndarray, radii: np.ndarray, first: int | None = None) -> DataFrame:
    """``(query, cell)``: the ``first`` most promising leaves of each query, or all that can reach its ``bound``.

    Leaves are looked at only below centres that can still reach the bound themselves.
    """
    kind = dict(asked.dtypes)["query"]
    width = len(centres.top)

    def cells(batches):
        for batch in batches:
            if batch.empty:
                continue
            vectors = _stacked(batch["vector"])
            above = _reach(_angle(vectors @ centres.top.T), tops[None, :])
            if first:
                # Only leaves below the most promising centres come first; others have their turn with the bound.
                near = np.argsort(-above, axis=1, kind="stable")[:, :first]
                wanted = np.zeros(above.shape, bool)
                np.put_along_axis(wanted, near, True, 1)
                wanted &= above > -2.0
            else:
                bound = batch["bound"].fillna(-1.0 - EPS).to_numpy() - EPS
                wanted = above >= bound[:, None]
            rows, found, reach = [], [], []
            for i in np.flatnonzero(wanted.any(0)):
                own = np.flatnonzero(wanted[:, i])
                below = _reach(_angle(vectors[own] @ centres.leaves[i].T), radii[i][None, :])
                row, leaf = np.nonzero(below > -2.0 if first else below >= bound[own][:, None])
                rows.append(own[row])
                found.append(i * width + leaf)
                reach.append(below[row, leaf])
            if not rows:
                continue
            out = pd.DataFrame({"row": np.concatenate(rows), "cell": np.concatenate(found), "reach": np.concatenate(reach)})
            if first:
                out = out.sort_values(["row", "reach", "cell"], ascending=[True, False, True]).groupby("row").head(first)
            yield pd.DataFrame({"query": batch["query"].to_numpy()[out["row"]], "cell": out["cell"].to_numpy()})

    return asked.mapInPandas(cells, f"query {kind}, cell int")


def nearest_vectors(queries: DataFrame, references: DataFrame, k: int = 5, leaves: int = 64) -> DataFrame:
    """``(query, reference, similarity, rank)`` of unit vectors by cosine.

    ``queries`` has ``query, vector`` and ``references`` has ``reference,
    vector``.  References lie in the leaves of a tree of trained centres (about ``leaves`` of them, ``MOST_LEAVES`` at most);
    only leaves whose angle bound can still reach a query's k-th best similarity are compared with it.  A NULL vector is no
    reference and finds none.
    """
    queries, references = queries.filter("vector is not null"), references.filter("vector is not null")
    wanted = wanted_cells(queries, references, k, leaves)
    if wanted is None:
        empty = queries.join(references.withColumnRenamed("vector", "rv"), F.lit(False))
        return empty.select(
            "query", "reference", F.lit(0.0).alias("similarity"), F.lit(1).alias("rank")
        )
    refs, tried, more = wanted
    scores = tried.unionByName(_dense_scores(more, queries, refs, k)).withColumn(
        "similarity", F.round("similarity", DIGITS)
    )
    return top_k(scores, "query", [F.desc("similarity"), F.asc("reference")], k)


def wanted_cells(queries: DataFrame, references: DataFrame, k: int, leaves: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The placed references, the scores of the first leaves, and ``(query, cell, rows)`` of the leaves to compare as well."""
    centres = train_centres(references, leaves)
    if centres is None:
        return None
    refs = materialized(place_vectors(references, centres), "dense-refs")
    # A row for each leaf with references: bounded by the tree, whatever the number of references.
    cells = materialized(refs.groupBy("cell").agg(F.max("angle").alias("radius"), F.max("top_angle").alias("top_radius"), F.count(F.lit(1)).alias("rows")), "cells")
    width = len(centres.top)
    radii, tops = np.full((width, width), -1.0), np.full(width, -1.0)
    for r in cells.collect():
        i, j = divmod(r.cell, width)
        radii[i, j], tops[i] = r.radius, max(tops[i], r.top_radius)
    sizes = F.broadcast(cells.select("cell", "rows"))
    first = materialized(reachable_cells(queries.select("query", "vector"), centres, tops, radii, FIRST_CELLS), "dense-first")
    tried = materialized(_dense_scores(first.join(sizes, "cell"), queries, refs, k), "dense-scores")
    bound = kth_best(tried, "query", "similarity", k)
    more = reachable_cells(queries.select("query", "vector").join(bound, "query", "left"), centres, tops, radii)
    more = materialized(more.join(first, ["query", "cell"], "left_anti").join(sizes, "cell"), "dense-more")
    return refs, tried, more


def _dense_scores(wanted: DataFrame, queries: DataFrame, refs: DataFrame, k: int) -> DataFrame:
    """The k best similarities (and ties) of queries in each bucket of the wanted cells.

    Crowded cells are cut into buckets by reference; a crowd of queries is cut likewise.  Each
    pair of buckets is one matrix product, and only its best rows leave the task.
    """
    crowd = wanted.groupBy("cell").agg(
        F.count(F.lit(1)).alias("uses"), F.max("rows").alias("rows")
    )

    def parts(n: str) -> Column:
        return F.greatest(F.ceil(F.col(n) / BUCKET_ROWS), F.lit(1)).cast("int")

    left = (
        wanted.select("query", "cell")
        .join(F.broadcast(crowd), "cell")
        .withColumn("qs", F.pmod(F.xxhash64("query"), parts("uses")).cast("int"))
        .withColumn("rs", F.explode(F.sequence(F.lit(0), parts("rows") - 1)))
        .select("query", "cell", "qs", "rs")
        .join(queries.select("query", "vector"), "query")
    )
    right = (
        refs.join(F.broadcast(crowd), "cell")
        .withColumn("rs", F.pmod(F.xxhash64("reference"), parts("rows")).cast("int"))
        .withColumn("qs", F.explode(F.sequence(F.lit(0), parts("uses") - 1)))
        .select("reference", "rv", "cell", "qs", "rs")
    )
    kinds = {f.name: f.dataType.simpleString() for f in (*queries.schema.fields, *refs.schema.fields)}

    def product(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or known.empty:
            return pd.DataFrame({"query": asked["query"][:0], "reference": known["reference"][:0], "similarity": []})
        block = np.stack(asked["vector"].to_numpy()).astype(float) @ np.stack(known["rv"].to_numpy()).astype(float).T
        at = max(block.shape[1] - k, 0)
        least = np.partition(block, at, axis=1)[:, at]
        rows, columns = np.nonzero(block >= least[:, None] - EPS)
        return pd.DataFrame(
            {
                "query": asked["query"].to_numpy()[rows],
                "reference": known["reference"].to_numpy()[columns],
                "similarity": block[rows, columns],
            }
        )

    keys = ["cell", "qs", "rs"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        product, f"query {kinds['query']}, reference {kinds['reference']}, similarity double"
    )


def default_leaves(rows: int) -> int:
    """About the square root of the reference count."""
    return max(1, int(math.sqrt(rows)))
