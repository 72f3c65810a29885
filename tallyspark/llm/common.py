"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.session import forget, let_go, scratch_path, written  # noqa: F401

#: A side is broadcast only if a count has shown that it has at most this many rows.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to have at most ``rows`` rows, else as it is.

    ``df`` should be a written table or another cheap plan of narrow rows: it is counted here.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front of it so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def by_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]):
    """A function for ``mapInArrow`` that prepares once per task and then maps batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return run
