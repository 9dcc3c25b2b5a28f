"""Sliding windows over panes without a copy of anything for each window that holds it.

Rows are first aggregated per pane, gcd(length, slide) wide. A window of m panes then is the
end of one block of m panes and the beginning of the next, so two running aggregates a
block (from its start on, and up to its end) answer every window with two values, however
many windows overlap: the rows behind the pane step are as many as panes and windows, not
panes times length / slide. Nothing is subtracted, so it serves anything that merges (sums,
minima, sketches, bitmaps) and sums of doubles lose nothing to cancellation. A block is
one group of a window function: m panes (and key) at most, whatever the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PANE = "_pane"
_SLOT = "_k"


def floor_div(x: Column, d: int) -> Column:
    """Exact floor division of a long by a positive constant (also before 1970)."""
    return ((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("long")


def pane_of(micros: Column, length_us: int, slide_us: int, start_us: int) -> Column:
    return floor_div(micros - F.lit(start_us), math.gcd(length_us, slide_us))


def window_parts(panes: DataFrame, keys: Iterable[str], merges: Mapping[str, Callable[[Column], Column]],
                 length_us: int, slide_us: int) -> DataFrame:
    """At most two rows for each window and key: ``_k`` (the window's number), the keys, and
    each column of ``merges`` merged over the panes of the window in one block.

    ``panes`` has one row a pane (``_pane``) and key; ``merges`` names the columns with
    the aggregate that merges them.
    """
    g = math.gcd(length_us, slide_us)
    m, q = length_us // g, slide_us // g
    keys = list(keys)
    block = "_block"
    p, first = F.col(PANE), F.col(block) * F.lit(m)
    by = Window.partitionBy(block, *keys).orderBy(PANE)
    up_to, from_on = (by.rowsBetween(*frame) for frame in ((Window.unboundedPreceding, 0), (0, Window.unboundedFollowing)))
    running = panes.withColumn(block, floor_div(p, m)).select(
        PANE, block, *keys, F.lag(PANE).over(by).alias("_before"), F.lead(PANE).over(by).alias("_after"),
        *[merge(F.col(c)).over(up_to).alias(f"_to_{c}") for c, merge in merges.items()],
        *[merge(F.col(c)).over(from_on).alias(f"_from_{c}") for c, merge in merges.items()])
    # a pane's "from" value is that of the windows that begin behind the pane before it, its
    # "to" value that of those that began in the block before and end before the next pane
    begin = -floor_div(-F.greatest(F.coalesce(F.col("_before") + 1, first), first), q)
    begins = F.struct(begin.alias("lo"), floor_div(p, q).alias("hi"), *[F.col(f"_from_{c}").alias(c) for c in merges])
    last = F.least(F.coalesce(F.col("_after") - 1, first + F.lit(m - 2)), first + F.lit(m - 2))
    ends = F.struct((-floor_div(-(p - F.lit(m - 1)), q)).alias("lo"), floor_div(last - F.lit(m - 1), q).alias("hi"),
                    *[F.col(f"_to_{c}").alias(c) for c in merges])
    return (running.select(*keys, F.inline(F.array(begins, ends))).filter("lo <= hi")
            .select(F.explode(F.sequence("lo", "hi")).alias(_SLOT), *keys, *merges))


def merged_windows(panes: DataFrame, keys: Iterable[str], merges: Mapping[str, Callable[[Column], Column]],
                   length_us: int, slide_us: int) -> DataFrame:
    """One row for each window that holds a pane, and key: ``_k``, the keys, the merged columns."""
    keys = list(keys)
    return (window_parts(panes, keys, merges, length_us, slide_us).groupBy(_SLOT, *keys)
            .agg(*[merge(F.col(c)).alias(c) for c, merge in merges.items()]))


def window_bounds(length_us: int, slide_us: int, start_us: int, at: Callable[[Column], Column]) -> list[Column]:
    """``window_start`` and ``window_end`` of window ``_k``."""
    begin = F.col(_SLOT) * F.lit(slide_us) + F.lit(start_us)
    return [at(begin).alias("window_start"), at(begin + F.lit(length_us)).alias("window_end")]


def distinct_panes_exact(df: DataFrame, pane: Column, value: str, by: Iterable[str]) -> DataFrame:
    """Bitmaps of an integer column's values per pane: one row a pane, key and run of 32,768
    values. Nulls count for nothing, but their pane has a row. For dense numbers such as ids."""
    dtype = df.schema[value].dataType
    if not isinstance(dtype, T.IntegralType):
        raise ValueError(f"exact distinct counts need an integer column, {value!r} is {dtype.simpleString()}")
    v = F.col(value).cast("long")
    return (df.groupBy(pane.alias(PANE), *by, F.bitmap_bucket_number(v).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(v)).alias("_bits")).filter(f"{PANE} IS NOT NULL"))


def distinct_panes_sketch(df: DataFrame, pane: Column, value: str, by: Iterable[str], lg_k: int) -> DataFrame:
    """A HyperLogLog sketch of a column's values per pane and key. Nulls count for nothing."""
    return (df.groupBy(pane.alias(PANE), *by).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("_sketch"))
            .filter(f"{PANE} IS NOT NULL"))
