"""Joins of fact rows with a lookup by a key that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import BROADCAST_ROWS, materialized

#: A key of at least so many rows is hot; at most one in ``BROADCAST_ROWS`` of all rows is asked for, so there are never more hot keys than that.
HOT_ROWS = 1_000_000


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """``key``s with very many rows, found by one partial count: ``most`` keys at most, whatever the table."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    return counts.filter(F.col("_n") >= F.greatest(F.lit(hot_rows), F.ceil(total / most))).select(key)


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left", hot_rows: int = HOT_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` joined with ``table``, which has a row for a key at most (any number for semi and anti joins).

    ``rows`` should be a written table: it is read again for its hot keys, if the lookup is too large for a broadcast.
    Rows with a hot key, and those without a key, stay where they are and meet the few lookup rows of hot keys by broadcast; only the
    others are shuffled by key.  ``how`` is left, inner, left_semi or left_anti.
    """
    only_keys = how in ("left_semi", "left_anti")
    table = table.select(key).distinct() if only_keys else table
    if table.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(table), key, how)
    hot = materialized(hot_keys(rows, key, hot_rows, most), "hot-keys")
    if hot.isEmpty():
        return rows.join(table, key, how)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    stays = F.col("_hot").isNotNull() | F.col(key).isNull()
    few = table.join(F.broadcast(hot), key, "left_semi")
    here = marked.filter(stays).drop("_hot").join(F.broadcast(few), key, how)
    return here.unionByName(marked.filter(~stays).drop("_hot").join(table, key, how))
