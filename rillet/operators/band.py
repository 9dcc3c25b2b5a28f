"""Joins on a band ``low <= right - left <= high``, as equality on buckets of the band's width.

The semi and anti join need no pair of rows: of each bucket of the right side only its least
and its greatest value matter. A band as wide as a bucket begins in one bucket and ends in
the next, so a left row has a partner if the greatest value of the first bucket reaches
its lower bound, or the least of the second lies within its upper bound. The right side
is one row a key and bucket after a partial aggregate, whatever share of rows one key holds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .panes import floor_div


def band_semi_join(left: DataFrame, right: DataFrame, left_at: Column, right_at: Column, low: int, high: int,
                   on: Iterable[str] = (), anti: bool = False) -> DataFrame:
    """The rows of ``left`` for which ``right`` has a row (with ``anti``: no row) equal in the
    columns ``on`` and with ``left_at + low <= right_at <= left_at + high``.

    The positions are longs (such as microseconds); nulls there or in ``on`` match nothing.
    Rows of ``left`` come once each; repeated ones stay repeated.
    """
    if high < low:
        raise ValueError("the band's upper bound lies under its lower one")
    width, on = high - low + 1, list(on)
    at, bucket = "__rillet_at", "__rillet_bucket"
    held = (right.select(*on, right_at.cast("long").alias(at)).filter(F.col(at).isNotNull())
            .groupBy(*on, floor_div(F.col(at), width).alias(bucket))
            .agg(F.min(at).alias("__rillet_least"), F.max(at).alias("__rillet_most")))
    # each bucket under its own number (for bands that begin in it) and under the one before
    # (for bands that end in it): a left row then meets both in one lookup
    numbers = F.explode(F.array(
        F.struct(F.col(bucket).alias("b"), F.col("__rillet_most").alias("most"), F.lit(None).cast("long").alias("least")),
        F.struct((F.col(bucket) - 1).alias("b"), F.lit(None).cast("long").alias("most"), F.col("__rillet_least").alias("least"))))
    near = (held.select(*on, numbers.alias("__n"))
            .groupBy(*on, F.col("__n.b").alias(bucket))
            .agg(F.max("__n.most").alias("__rillet_most"), F.min("__n.least").alias("__rillet_least")))
    begin = left_at.cast("long") + F.lit(low)
    rows = left.withColumn(at, begin).withColumn(bucket, floor_div(F.col(at), width))
    joined = rows.join(near, [*on, bucket], "left")
    met = F.coalesce((F.col("__rillet_most") >= F.col(at))
                     | (F.col("__rillet_least") <= F.col(at) + F.lit(width - 1)), F.lit(False))
    return joined.filter(~met if anti else met).select(*[f"`{c}`" for c in left.columns])
