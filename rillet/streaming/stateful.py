"""Stateful streaming operators whose state expires: DISTINCT and the join of both views.

Both need a watermark: how late a line may be. A line later than that may be lost to
them, as Spark drops state behind the watermark; within it, what a stream gives in all is
what a bounded replay of the same lines gives, restarts included.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import WINDOW_END, WINDOW_START, duration_us, explode_windows, micros_of, wall_clock

_AT = "__rillet_at"


def _instants(rows: DataFrame, time_col: str, name: str) -> DataFrame:
    """``rows`` with the arrival as an instant, which a watermark needs, under ``name``. A
    wall-clock time is read as UTC, so no session time zone comes in."""
    at = F.timestamp_micros(micros_of(rows, time_col))
    return rows.withColumn(name, at)


def stream_distinct(rows: DataFrame, columns: Iterable[str], time_col: str, within) -> DataFrame:
    """DISTINCT over ``columns`` of a stream: of rows equal in them and at most ``within`` apart
    in time, one. The state of a value ends ``within`` after its row, so it is bounded by
    the values of that span, not of the whole stream. Values that come again later
    than that come out again: put the period they are to be distinct in (a day, say)
    among the columns, and let ``within`` be as long."""
    columns = list(columns)
    delay = f"{duration_us(within)} microseconds"
    return (_instants(rows, time_col, _AT).withWatermark(_AT, delay)
            .dropDuplicatesWithinWatermark(columns).select(*[F.col(f"`{c}`") for c in columns]))


def stream_join_in_windows(left: DataFrame, right: DataFrame, on: Mapping[str, str], time_col: str, length, slide=None,
                           start=None, lateness=None, suffix: str = "_right") -> DataFrame:
    """Inner join of two streams within sliding windows: each pair of rows equal in ``on`` (left
    name to right name) once for every window that holds both, with ``window_start`` and
    ``window_end``. Columns of the right that the left has too get ``suffix``.

    Rows further apart than ``length`` share no window; with the watermark (``lateness``)
    this bound lets the state of a row end. Pairs come out as soon as both rows are there.
    """
    ntz = isinstance(left.schema[time_col].dataType, T.TimestampNTZType)
    delay = f"{duration_us(lateness)} microseconds" if lateness else "0 seconds"
    span = f"INTERVAL '{duration_us(length) / 1e6:.6f}' SECOND"
    taken = set(left.columns)
    renamed = {c: f"{c}{suffix}" if c in taken else c for c in right.columns}
    left_at, right_at = f"{_AT}_left", f"{_AT}_right"
    a = _instants(left, time_col, left_at).withWatermark(left_at, delay)
    b = _instants(right, time_col, right_at).withColumnsRenamed(renamed).withWatermark(right_at, delay)
    cond = [F.col(f"`{x}`") == F.col(f"`{renamed[y]}`") for x, y in on.items()]
    near = (F.col(right_at) > F.col(left_at) - F.expr(span)) & (F.col(right_at) < F.col(left_at) + F.expr(span))
    for c in cond:
        near = near & c
    pairs = explode_windows(a.join(b, near), left_at, length, slide, start)
    both = pairs.where((F.col(right_at) >= F.col(WINDOW_START)) & (F.col(right_at) < F.col(WINDOW_END)))
    both = both.drop(left_at, right_at)
    if ntz:
        for c in (WINDOW_START, WINDOW_END):
            both = both.withColumn(c, wall_clock(F.unix_micros(F.col(c))))
    return both

