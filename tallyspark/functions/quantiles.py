"""Exact quantiles at any size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import materialized

# Up to this many distinct values the built-in exact percentile fits in one aggregate buffer.
DISTINCT_LIMIT = 1_000_000
BINS = 4_096
MOST = 1.7976931348623157e308


def exact_quantiles(
    df: DataFrame, column: str, qs: Sequence[float], distinct_limit: int = DISTINCT_LIMIT
) -> list[float | None]:
    """Linearly interpolated quantiles of a numeric column; NULL and NaN do not count.

    With many distinct values the wanted ranks are located by counting ever
    narrower value ranges, so no task ever holds the values themselves.  The values
    are written once: ``df`` is evaluated a single time, however many ranges are counted.
    """
    number = F.nullif(F.col(column).cast("double"), F.lit(float("nan"))).alias("value")
    df = materialized(df.select(number).filter(F.col("value").isNotNull()), "quantile-values")
    value = F.col("value")
    facts = df.agg(
        F.count(value).alias("n"),
        F.approx_count_distinct(value).alias("d"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
    ).first()
    if not facts.n:
        return [None for _ in qs]
    if facts.d <= distinct_limit:
        return list(
            df.agg(F.percentile(value, F.array(*[F.lit(float(q)) for q in qs]))).first()[0]
        )
    found: dict[int, float] = {}

    def at(rank: int) -> float:
        if rank not in found:
            found[rank] = _value_at(df, value, rank, facts.lo, facts.hi)
        return found[rank]

    out = []
    for q in qs:
        position = (facts.n - 1) * q
        low = math.floor(position)
        part = position - low
        out.append(at(low) if part == 0 else at(low) * (1 - part) + at(low + 1) * part)
    return out


def _value_at(df: DataFrame, value, rank: int, lo: float, hi: float) -> float:
    """The value with the given 0-based rank: refine a histogram until one value is left."""
    while lo < hi:
        if math.isinf(lo) or math.isinf(hi):
            # An infinite end is counted by itself; the finite rest is refined.
            ends = df.agg(
                F.count(F.when(value == -math.inf, 1)).alias("below"),
                F.count(F.when(value.between(-MOST, MOST), 1)).alias("finite"),
                F.min(F.when(value.between(-MOST, MOST), value)).alias("lo"),
                F.max(F.when(value.between(-MOST, MOST), value)).alias("hi"),
            ).first()
            if rank < ends.below:
                return -math.inf
            rank -= ends.below
            if rank >= ends.finite:
                return math.inf
            lo, hi = ends.lo, ends.hi
            continue
        width = (hi / BINS) - (lo / BINS)  # no overflow at the ends of the range
        if not width:
            width = math.ulp(0.0)
        bin_of = F.least(F.floor((value - lo) / width), F.lit(BINS - 1))
        bins = (
            df.filter(value.between(lo, hi))
            .groupBy(bin_of.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
            .orderBy("bin")
            .collect()  # at most BINS rows
        )
        for b in bins:
            if rank < b.n:
                lo, hi = b.lo, b.hi
                break
            rank -= b.n
    return lo
