"""Rows dealt into blocks along the order of an integer key, without a sort of the whole table."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEGMENTS = 128  # quantile segments of the key; their bounds are the only values the driver reads


def _segment(key: Column, bounds: list[int], low: int, high: int) -> Column:
    """Number of bounds that are <= key, as a balanced tree of comparisons."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key < F.lit(bounds[middle]), _segment(key, bounds, low, middle)).otherwise(
        _segment(key, bounds, middle + 1, high)
    )


def ordered_block(df: DataFrame, key: str, rows_per_block: int) -> tuple[Column, int]:
    """An expression that numbers blocks of about ``rows_per_block`` rows along ``key``, and the number of rows.

    Quantiles cut the keys into segments of like size, so that a few outlying
    keys can't push all others into one block; equal widths cut each segment.
    Block numbers never decrease with the key; null keys come first, in block -1.
    One narrow scan; the driver reads SEGMENTS numbers.
    """
    known = df.select(F.col(key).cast("bigint").alias("k"))
    n, low, high = known.agg(F.count(F.lit(1)), F.min("k"), F.max("k")).first()
    if low is None:
        return F.lit(-1).cast("bigint"), n
    segments = min(SEGMENTS, max(1, n // rows_per_block))
    shares = [i / segments for i in range(1, segments)]
    cuts = sorted({int(x) for x in known.approxQuantile("k", shares, 1 / (4 * SEGMENTS))} - {low}) if shares else []
    starts = [low, *cuts]
    ends = [*cuts, high + 1]
    per_segment = max(1, ceil(n / len(starts) / rows_per_block))
    widths = [max(1, ceil((end - start) / per_segment)) for start, end in zip(starts, ends)]
    value = F.col(key).cast("bigint")
    segment = _segment(value, cuts, 0, len(cuts))

    def look_up(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), segment + 1)

    inside = F.floor((value - look_up(starts)) / look_up(widths))
    block = segment.cast("bigint") * per_segment + F.least(inside, F.lit(per_segment - 1)).cast("bigint")
    return F.when(value.isNull(), F.lit(-1).cast("bigint")).otherwise(block), n
