"""Benchmark decontamination by spaced seeds.

Texts are cut into lower-cased words of letters and digits.  Fixed masks choose five of up
to eight consecutive words and ignore the rest; a seed is the hash of the chosen words.
Seeds of documents and of benchmark items are joined, and each hit places an item against
a document.  An item counts as leaked if, so placed, some window of 13 of its words (or
the whole item, if it is shorter) lies in the document with at most a fifth of the words
substituted.  The masks are chosen so that every such window of 8 to 13 words, with the
substitutions anywhere, shares a seed with the document: no leak is missed.

Only built-in expressions run.  Item seeds are broadcast if they are counted to be few,
else joined by a shuffle; hits are reduced to distinct placements before anything is
verified, so a passage that a third of all documents hold costs one placement for each.

Items of 1 to 7 words have no window for the masks: they are looked for whole and unchanged, by the hash of all
their words at every place.

Defined results: null and empty texts have no words; items without words are not looked for; items with the same words count once, under their smallest id; documents
with one doc_id (null included) are judged together; repeated rows stay repeated.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import broadcast_if_small, unused
from tallyspark.session import materialized

# For 8 and 9 words with one substitution, and for 10 to 13 with two, one of these masks always fits.
MASKS = [(0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4)]
WINDOW = 13
LEAST_ITEM = 8
TOLERATED = 0.2
#: Item seeds are broadcast up to this many rows.
SEED_ROWS = 200_000


def words(text: Column) -> Column:
    """Hashes of the lower-cased words of letters and digits."""
    found = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(found, lambda w: F.xxhash64(w))


def with_seeds(df: DataFrame, hashes: str) -> DataFrame:
    """One row for every mask at every place ``at`` of the array ``hashes``, with its ``seed``; null past the end."""
    held = df.withColumn(hashes, F.explode(F.array(hashes)))  # computed once, not for each use
    placed = held.withColumn("at", F.explode(F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(1))))

    def seed(number: int, mask: tuple[int, ...]) -> Column:
        chosen = [F.get(hashes, F.col("at") + k) for k in mask]
        return F.when(F.col("at") + mask[-1] < F.size(hashes), F.xxhash64(F.lit(number), *chosen))

    return placed.withColumn("seed", F.explode(F.array(*[seed(number, mask) for number, mask in enumerate(MASKS)])))


def _run(hashes: str, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(-n), *[F.get(hashes, at + k) for k in range(n)])


def with_short(df: DataFrame, hashes: str, lengths: Sequence[int]) -> DataFrame:
    """One row for every run of one of these numbers of words at every place ``at``, with its ``seed``."""
    held = df.withColumn(hashes, F.explode(F.array(hashes)))
    placed = held.withColumn("at", F.explode(F.sequence(F.lit(0), F.size(hashes) - 1, F.lit(1))))

    def seed(n: int) -> Column:
        return F.when(F.col("at") + n <= F.size(hashes), _run(hashes, F.col("at"), n))

    return placed.withColumn("seed", F.explode(F.array(*map(seed, lengths)))).dropna(subset=["seed"])


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long"), words(F.col("text").cast("string")).alias("item_words"))
    return (
        items.filter(F.size("item_words") > 0)
        .groupBy("item_words")
        .agg(F.min("item_id").alias("item"))
        .withColumn("item_key", F.monotonically_increasing_id())
    )


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified leaks: ``doc_key`` (the doc_id as text, or ``null``), ``item``, ``matched`` and ``needed`` words."""
    items = materialized(_items(benchmark), "leak-items")
    long, short = items.filter(F.size("item_words") >= LEAST_ITEM), items.filter(F.size("item_words").between(1, LEAST_ITEM - 1))
    item_seeds = with_seeds(long, "item_words").select("item_key", "seed", F.col("at").alias("item_at")).dropna()
    # At most LEAST_ITEM - 1 lengths.
    lengths = sorted(r["n"] for r in short.select(F.size("item_words").alias("n")).distinct().collect())
    if lengths:
        runs = functools.reduce(lambda c, n: c.when(F.size("item_words") == n, _run("item_words", F.lit(0), n)), lengths, F)
        item_seeds = item_seeds.union(short.select("item_key", runs.alias("seed"), F.lit(0).alias("item_at")))
    item_seeds = broadcast_if_small(materialized(item_seeds, "leak-seeds"), SEED_ROWS)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")).alias("doc_key"), F.col("text").cast("string").alias("text")
    )
    hashed = keyed.select("doc_key", words(F.col("text")).alias("doc_words"))
    hashed_words = hashed.filter(F.size("doc_words") > 0)
    doc_seeds = with_seeds(hashed_words, "doc_words").select("doc_key", "seed", "at")
    if lengths:
        doc_seeds = doc_seeds.union(with_short(hashed_words, "doc_words", lengths).select("doc_key", "seed", "at"))
    placements = (
        doc_seeds.join(item_seeds, "seed")
        .select("doc_key", "item_key", (F.col("at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    placements = materialized(placements, "leak-placements")
    to_check = broadcast_if_small(placements)
    item_words = broadcast_if_small(items)
    placed = (
        hashed.join(to_check, "doc_key").select("doc_key", "doc_words", "item_key", "shift").join(item_words, "item_key")
    )
    first = F.greatest(F.lit(0), -F.col("shift"))
    last = F.least(F.size("item_words"), F.size("doc_words") - F.col("shift")) - 1
    same = F.when(
        last >= first,
        F.transform(
            F.sequence(first, last), lambda j: (F.get("item_words", j) == F.get("doc_words", j + F.col("shift"))).cast("int")
        ),
    ).otherwise(F.array().cast("array<int>"))
    length = F.least(F.lit(WINDOW), F.size("item_words"))
    sums = F.when(
        F.size("same") >= F.col("length"),
        F.transform(
            F.sequence(F.lit(1), F.size("same") - F.col("length") + 1),
            lambda j: F.aggregate(F.slice("same", j, F.col("length")), F.lit(0), lambda a, b: a + b),
        ),
    )
    checked = (
        placed.select("doc_key", "item", length.alias("length"), same.alias("same"))
        .select("doc_key", "item", "length", F.array_max(sums).alias("matched"))
        .withColumn("needed", F.col("length") - F.floor(F.col("length") * TOLERATED).cast("int"))
    )
    return (
        checked.filter(F.col("matched") >= F.col("needed"))
        .groupBy("doc_key", "item")
        .agg(F.max("matched").alias("matched"), F.max("needed").alias("needed"))
    )


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each document with its leaks: ``doc_id``, ``contaminated``, ``n_items``, ``items`` (sorted)."""
    found = (
        leaks(docs, benchmark)
        .groupBy("doc_key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    found = broadcast_if_small(materialized(found, "leaks"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id")).withColumn("doc_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    none = F.array().cast("array<bigint>")
    return keyed.join(found, "doc_key", "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.size(F.coalesce("items", none)).alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no leaked item, with all their columns."""
    name = unused(docs, "leaked")
    found = materialized(leaks(docs, benchmark).select(F.col("doc_key").alias(name)).distinct(), "leaks")
    key = F.coalesce(docs["doc_id"].cast("long").cast("string"), F.lit("null"))
    found = broadcast_if_small(found)
    return docs.join(found, key == F.col(name), "left_anti")
