"""Sliding windows over a time column, and SQL over window contents.

Windows are half-open ``[start, end)``; starts are multiples of the slide
(plus an optional offset), as in :func:`pyspark.sql.functions.window`; only
windows holding at least one row exist. Four ways to compute over them:

* :func:`window_stats` / :func:`window_agg` (path N): ``groupBy(window)``
  with partial aggregation before the shuffle; a single hot window costs
  one partial row per task. Works on streams with a watermark.
* :func:`explode_windows` (path A): each row tagged with every window that
  holds it (``window_start``, ``window_end``), so SQL that groups or joins on
  the window columns computes all windows in one job.
* :func:`sql_per_window` (path L): the unchanged SQL text over the rows of each window, as
  a correlated subquery, so that one job computes all windows (a LIMIT becomes a ranking by
  window, an aggregate a grouping). For the texts that :func:`runs_each` takes.
* :class:`SlideStage` (path S): rows written once to the shared scratch folder,
  partitioned by slide bucket, for streams: an emit reads only the buckets of its windows
  (a partition filter) and runs the text over them as path L. Texts that path L cannot
  take run once per window, a chunk of windows a job.
"""

from __future__ import annotations

import datetime as dt
import math
import re
from collections.abc import Callable, Iterable, Mapping
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir
from ..sinks.window_results import WEND as _WEND
from ..sinks.window_results import WindowResults
from ..types import SchemaError
from .panes import (PANE, distinct_panes_exact, distinct_panes_sketch, floor_div, merged_windows, pane_of,
                    window_bounds)
from .render import render
from .sql_stage import ansi_mode, borrowed_views, run_sql, run_sql_each, runs_each

WINDOW_START = "window_start"
WINDOW_END = "window_end"
BUCKET = "_bucket"
_KEY = "__rillet_window_key"
_EPOCH = dt.datetime(1970, 1, 1)
_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def duration_us(d) -> int:
    """Microseconds of a duration: an ``int`` of milliseconds (as in settings
    files), a ``timedelta``, or text such as ``"18 hours"`` / ``"6000 milliseconds"``."""
    if isinstance(d, timedelta):
        us = d // timedelta(microseconds=1)
    elif isinstance(d, int):
        us = d * 1_000
    else:
        us = 0
        parts = re.findall(r"(-?\d+)\s*([a-zA-Z]+)", str(d))
        if not parts or re.sub(r"(-?\d+)\s*([a-zA-Z]+)", "", str(d)).strip():
            raise SchemaError(f"cannot read duration {d!r}")
        for n, unit in parts:
            unit = unit.lower().rstrip("s")
            if unit not in _UNITS_US:
                raise SchemaError(f"unknown time unit in {d!r}")
            us += int(n) * _UNITS_US[unit]
    if us <= 0:
        raise SchemaError(f"duration {d!r} must be positive")
    return us


def _interval(us: int) -> str:
    return f"{us} microseconds"


def window_column(time_col: str, length, slide=None, start=None) -> Column:
    slide = length if slide is None else slide
    return F.window(time_col, _interval(duration_us(length)), _interval(duration_us(slide)),
                    _interval(duration_us(start)) if start else None)


def explode_windows(df: DataFrame, time_col: str, length, slide=None, start=None) -> DataFrame:
    """Every row once per window that holds it, with ``window_start``/``window_end``."""
    w = "__rillet_window"
    return (df.withColumn(w, window_column(time_col, length, slide, start))
            .select("*", F.col(f"{w}.start").alias(WINDOW_START), F.col(f"{w}.end").alias(WINDOW_END))
            .drop(w))


def window_agg(df: DataFrame, time_col: str, length, slide=None, start=None,
               aggs: Iterable[Column] = (), by: Iterable[str] = ()) -> DataFrame:
    """``aggs`` per window (and ``by`` keys), flattened to ``window_start``/``window_end``."""
    w = "__rillet_window"
    by = list(by)
    grouped = df.groupBy(window_column(time_col, length, slide, start).alias(w), *by).agg(*aggs)
    rest = [c for c in grouped.columns if c != w and c not in by]
    return grouped.select(F.col(f"{w}.start").alias(WINDOW_START),
                          F.col(f"{w}.end").alias(WINDOW_END), *by, *rest)


def window_stats(df: DataFrame, value_col: str, time_col: str, length, slide=None,
                 start=None, panes: bool | None = None) -> DataFrame:
    """The default statistics per window: sum, count of rows, min and max of one field.

    ``panes`` (default: when a row falls into more than 4 windows) aggregates
    per pane of width gcd(length, slide) first and merges running aggregates of the
    panes (see :mod:`rillet.operators.panes`), so nothing is multiplied by the number of
    windows per row. Both plans pre-aggregate before every shuffle.
    """
    length_us = duration_us(length)
    slide_us = duration_us(length if slide is None else slide)
    if panes is None:
        panes = -(-length_us // slide_us) > 4
    v = F.col(value_col)
    names = (f"sum_{value_col}", "n", f"min_{value_col}", f"max_{value_col}")
    if not panes:
        return window_agg(df, time_col, length, slide, start, aggs=[
            F.sum(v).alias(names[0]), F.count(F.lit(1)).alias(names[1]),
            F.min(v).alias(names[2]), F.max(v).alias(names[3])])
    start_us = duration_us(start) if start else 0
    pane = pane_of(micros_of(df, time_col), length_us, slide_us, start_us)
    per_pane = (df.groupBy(pane.alias(PANE))
                .agg(F.sum(v).alias("_s"), F.count(F.lit(1)).alias("_n"),
                     F.min(v).alias("_lo"), F.max(v).alias("_hi")).filter(F.col(PANE).isNotNull()))
    per_window = merged_windows(per_pane, [], {"_s": F.sum, "_n": F.sum, "_lo": F.min, "_hi": F.max}, length_us, slide_us)
    return per_window.select(*window_bounds(length_us, slide_us, start_us, _clock(df, time_col)),
                             *[F.col(c).alias(n) for c, n in zip(("_s", "_n", "_lo", "_hi"), names)])


def window_distinct(df: DataFrame, value_col: str, time_col: str, length, slide=None, start=None,
                    by: Iterable[str] = (), lg_k: int | None = None) -> DataFrame:
    """The number of distinct values of one column per window (and ``by`` keys), as ``n_distinct``.

    Exact for an integer column, by bitmaps. With ``lg_k`` of any column, by HyperLogLog
    sketches of 2**lg_k registers, whose standard error is about 1.04 / sqrt(2**lg_k) of
    the number. Both are kept per pane and merged (see :mod:`rillet.operators.panes`), so
    a value is looked at once, not once a window. Nulls do not count; a window (and key)
    that holds rows with nulls only has 0.
    """
    length_us = duration_us(length)
    slide_us = duration_us(length if slide is None else slide)
    start_us = duration_us(start) if start else 0
    by = list(by)
    pane = pane_of(micros_of(df, time_col), length_us, slide_us, start_us)
    if lg_k is None:
        panes = distinct_panes_exact(df, pane, value_col, by)
        merged = merged_windows(panes, [*by, "_bucket"], {"_bits": F.bitmap_or_agg}, length_us, slide_us)
        counts = merged.groupBy("_k", *by).agg(F.sum(F.bitmap_count("_bits")).alias("n_distinct"))
    else:
        panes = distinct_panes_sketch(df, pane, value_col, by, lg_k)
        merged = merged_windows(panes, by, {"_sketch": F.hll_union_agg}, length_us, slide_us)
        counts = merged.select("_k", *by, F.hll_sketch_estimate("_sketch").alias("n_distinct"))
    return counts.select(*window_bounds(length_us, slide_us, start_us, _clock(df, time_col)), *by, "n_distinct")


def _clock(df: DataFrame, time_col: str) -> Callable[[Column], Column]:
    ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    return lambda us: _ts_from_micros(us, ntz)


def _ts_from_micros(us: Column, ntz: bool) -> Column:
    return wall_clock(us) if ntz else F.timestamp_micros(us)


def wall_clock(us: Column) -> Column:
    """A ``timestamp_ntz`` from microseconds since the epoch (no time zone involved)."""
    return F.timestamp_add("MICROSECOND", us, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def windowed_sql(views: Mapping[str, DataFrame], text: str, time_col: str, length, slide=None,
                 start=None, ansi: bool = False) -> DataFrame:
    """Path A: ``text`` over exploded views; it should group or join on the window columns."""
    exploded = {n: explode_windows(d, time_col, length, slide, start) for n, d in views.items()}
    return run_sql(exploded, text, ansi=ansi)


def windows_of(df: DataFrame, time_col: str, length, slide=None, start=None) -> DataFrame:
    """The windows that hold a row: ``window_start``, ``window_end``."""
    w = "__rillet_window"
    return (df.select(window_column(time_col, length, slide, start).alias(w)).distinct()
            .select(F.col(f"{w}.start").alias(WINDOW_START), F.col(f"{w}.end").alias(WINDOW_END)))


def _keyed(df: DataFrame, time_col: str, length, slide=None, start=None) -> DataFrame:
    """Every row once per window that holds it, with the window's start under a private name."""
    w = "__rillet_window"
    return (df.withColumn(w, window_column(time_col, length, slide, start))
            .select("*", F.col(f"{w}.start").alias(_KEY)).drop(w))


def sql_per_window(views: Mapping[str, DataFrame], text: str, time_col: str, length, slide=None, start=None,
                   ansi: bool = False, windows: DataFrame | None = None) -> DataFrame:
    """Path L: ``text`` over each window's rows of ``views``, in one job. ``windows`` (default:
    those that hold a row of the first view) has ``window_start`` and ``window_end``."""
    if windows is None:
        windows = windows_of(next(iter(views.values())), time_col, length, slide, start)
    keyed = {n: _keyed(d, time_col, length, slide, start) for n, d in views.items()}
    return run_sql_each(windows.withColumn(_KEY, F.col(WINDOW_START)), keyed, _KEY, text, ansi)


def micros_of(df: DataFrame, time_col: str) -> Column:
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                                F.col(time_col))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(time_col))
    raise SchemaError(f"time column {time_col!r} must be a timestamp, not {dtype}")


def ts_literal(us: int, ntz: bool) -> Column:
    if ntz:
        text = (_EPOCH + timedelta(microseconds=us)).isoformat(sep=" ")
        return F.expr(f"TIMESTAMP_NTZ'{text}'")
    return F.timestamp_micros(F.lit(us))


class SlideStage:
    """Rows of named views staged by slide bucket, for per-window SQL (path S).

    Buckets are ``gcd(length, slide)`` wide, so every window is a whole range
    of buckets. Writes go to a folder under ``spark.checkpoint.dir``, which
    also cuts the lineage of the staged rows.
    """

    def __init__(self, spark: SparkSession, time_col: str, length, slide=None, start=None,
                 root: str | None = None):
        self.spark = spark
        self.time_col = time_col
        self.length_us = duration_us(length)
        self.slide_us = duration_us(length if slide is None else slide)
        self.start_us = duration_us(start) if start else 0
        self.bucket_us = math.gcd(self.length_us, self.slide_us)
        self.root = root or scratch_dir(spark, "stage")
        self.ntz: bool | None = None
        self.names: list[str] = []
        self._read: dict[str, DataFrame] = {}
        # views computed per window from the staged ones: name -> fn(views) -> DataFrame
        self.derived: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {}
        self.direct: dict[str, DataFrame] = {}
        self._counts: dict[str, dict[int, int]] = {}  # rows per bucket per staged view
        self._schemas: dict[str, T.StructType] = {}  # staged schema incl. partition columns
        self._last: dict[str, int] = {}  # the latest batch id staged: only that one can come again
        self._cold: int | None = None    # buckets before it are not tracked any more
        self._results: dict[str, WindowResults] = {}
        self._each: dict[tuple, bool] = {}  # texts tried: can they run for all windows at once

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def append(self, name: str, df: DataFrame, batch_id: int | None = None,
               stage: bool = True, track: bool = False,
               counts: dict[int, int] | None = None) -> None:
        """Add rows of view ``name``.

        Staged (the default): written once by slide bucket; with ``batch_id``
        a re-run of the same batch replaces its own files. ``track`` records
        the rows written per bucket (one small aggregate; use it on a
        persisted micro-batch) so a stream never re-lists its history.

        ``stage=False`` keeps ``df`` as it is and filters it by each window's
        time range, which the scan turns into row-group (or partition)
        pruning: the right choice for a large source already clustered by
        time, which would otherwise be rewritten whole.
        """
        ntz = isinstance(df.schema[self.time_col].dataType, T.TimestampNTZType)
        if self.ntz is None:
            self.ntz = ntz
        elif self.ntz != ntz:
            raise SchemaError("all views need the same timestamp type")
        if name not in self.names:
            self.names.append(name)
        if not stage:
            self.direct[name] = df
            return
        out = df.withColumn(BUCKET, self._bucket_of(df))
        parts = [BUCKET]
        if batch_id is not None:
            out = out.withColumn("_batch", F.lit(int(batch_id)).cast("long"))
            parts.append("_batch")
        written = counts
        if written is None and track:
            written = {r[0]: r[1] for r in out.groupBy(BUCKET).count().collect()}
        if written is not None:
            written = {b: n for b, n in written.items() if b is not None}
        # Rows of one bucket go to one writer task (few files per bucket, not
        # one per task and bucket); AQE splits a hot bucket over several tasks.
        # Without a batch id rows are added; with one, the batch's own files are replaced.
        (out.hint("rebalance", BUCKET).write.mode("append" if batch_id is None else "overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts).parquet(self.path(name)))
        self._schemas[name] = out.schema
        self._read.pop(name, None)
        if written is not None and name in self._counts:
            # a replayed batch id rewrites its own rows: add only new batches
            if batch_id is None or batch_id > self._last.get(name, -1):
                for b, n in written.items():
                    if self._cold is None or b >= self._cold:
                        self._counts[name][b] = self._counts[name].get(b, 0) + n
        else:
            self._counts.pop(name, None)   # counted again when next needed
        if batch_id is not None:
            self._last[name] = max(batch_id, self._last.get(name, -1))

    def _exists(self, path: str) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def restore(self, name: str, schema: T.StructType) -> bool:
        """Take up view ``name`` (rows of ``schema``) as an earlier run staged it, with
        its tracked buckets and their row counts; False if nothing was staged."""
        if not self._exists(self.path(name)):
            return False
        self.ntz = isinstance(schema[self.time_col].dataType, T.TimestampNTZType)
        if name not in self.names:
            self.names.append(name)
        self._schemas[name] = T.StructType([*schema.fields, T.StructField(BUCKET, T.LongType()),
                                            T.StructField("_batch", T.LongType())])
        self._read[name] = self.spark.read.schema(self._schemas[name]).parquet(self.path(name))
        staged = self._read[name]
        self._last[name] = staged.agg(F.max("_batch")).first()[0] or 0
        tracked = staged if self._cold is None else staged.where(F.col(BUCKET) >= self._cold)
        self._counts[name] = {r[0]: r[1] for r in tracked.groupBy(BUCKET).count().collect() if r[0] is not None}
        return True

    def forget(self, before_us: int) -> None:
        """Stop tracking the buckets that end at or before ``before_us``: no window still to come
        holds them, so what the driver knows does not grow with the time span. Their rows
        stay; a window that late rows open again looks for its buckets in the folder."""
        cutoff = (before_us - self.start_us) // self.bucket_us
        if self._cold is None or cutoff > self._cold:
            self._cold = cutoff
            for counts in self._counts.values():
                for b in [b for b in counts if b < cutoff]:
                    del counts[b]

    def bucket_of(self, df: DataFrame) -> Column:
        """The slide bucket of each row of ``df`` (a long)."""
        return self._bucket_of(df)

    def _bucket_of(self, df: DataFrame) -> Column:
        return floor_div(micros_of(df, self.time_col) - F.lit(self.start_us), self.bucket_us)

    def staged(self, name: str) -> DataFrame:
        """The staged rows of one view; listed once until the next append."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]

    def view_counts(self, name: str) -> dict[int, int]:
        """Rows per non-empty bucket of a staged view: tracked, or one count
        grouped by the partition column (parquet answers it from metadata)."""
        if name not in self._counts:
            rows = self.staged(name)
            if self._cold is not None:
                rows = rows.where(F.col(BUCKET) >= self._cold)
            self._counts[name] = {r[0]: r[1] for r in rows.groupBy(BUCKET).count().collect()
                                  if r[0] is not None}   # rows without a time: no window
        return self._counts[name]

    def expire(self, before_us: int) -> int:
        """Delete staged buckets that end at or before ``before_us``: once every
        window holding them has run they are never read again. Keeps a
        long-running stream's staging bounded. Returns the buckets removed."""
        cutoff = (before_us - self.start_us) // self.bucket_us
        jvm = self.spark.sparkContext._jvm
        hconf = self.spark.sparkContext._jsc.hadoopConfiguration()
        removed = 0
        for name in self.names:
            if name in self.direct:
                continue
            for b in [b for b in self.view_counts(name) if b < cutoff]:
                path = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/{BUCKET}={b}")
                path.getFileSystem(hconf).delete(path, True)
                del self._counts[name][b]
                removed += 1
        return removed

    def view_buckets(self, name: str) -> set[int]:
        return set(self.view_counts(name))

    def buckets(self) -> list[int]:
        """Non-empty buckets of all views: staged views from tracking or the
        file listing (no data read); direct views by one small aggregate."""
        found = set()
        for name in self.names:
            if name in self.direct:
                df = self.direct[name]
                found.update(r[0] for r in df.select(self._bucket_of(df).alias("b"))
                             .distinct().collect())
            else:
                found |= self.view_buckets(name)
        return sorted(b for b in found if b is not None)

    def windows(self, buckets: Iterable[int] | None = None) -> list[tuple[int, int]]:
        """``(start_us, end_us)`` of every window that holds a non-empty bucket."""
        starts = set()
        for b in self.buckets() if buckets is None else buckets:
            lo = self.start_us + b * self.bucket_us
            hi = lo + self.bucket_us
            first = -((self.length_us + self.start_us - hi) // self.slide_us)   # ceil
            last = (lo - self.start_us) // self.slide_us                        # floor
            for k in range(first, last + 1):
                starts.add(self.start_us + k * self.slide_us)
        return [(s, s + self.length_us) for s in sorted(starts)]

    def window_views(self, window: tuple[int, int]) -> dict[str, DataFrame]:
        """Each view restricted to one window: a partition filter on the bucket
        (staged views) or a time-range filter (direct views); then derived views."""
        views = {n: self._direct(n, *window) if n in self.direct else self._staged(n, self._range(window))
                 for n in self.names}
        for name, fn in self.derived.items():
            views[name] = fn(views)
        return views

    def _direct(self, name: str, lo: int, hi: int) -> DataFrame:
        t = F.col(self.time_col)
        return self.direct[name].where((t >= ts_literal(lo, bool(self.ntz))) & (t < ts_literal(hi, bool(self.ntz))))

    def _staged(self, name: str, buckets: Iterable[int]) -> DataFrame:
        """Rows of these buckets of a staged view, with a partition filter. With a known
        schema only the folders of buckets that hold rows are listed, no footer is read."""
        buckets = sorted(buckets)
        schema = self._schemas.get(name)
        if schema is None:
            rows = self.staged(name)
        else:
            counts = self.view_counts(name)
            present = [b for b in buckets if b in counts or self._cold is not None and b < self._cold
                       and self._exists(f"{self.path(name)}/{BUCKET}={b}")]
            if not present:
                return self.spark.createDataFrame([], schema).drop(BUCKET, "_batch")
            rows = (self.spark.read.schema(schema).option("basePath", self.path(name))
                    .parquet(*[f"{self.path(name)}/{BUCKET}={b}" for b in present]))
        if buckets:
            rows = rows.where(F.col(BUCKET).between(buckets[0], buckets[-1]))
        return rows.drop(BUCKET, "_batch")

    def run(self, text: str, windows: Iterable[tuple[int, int]] | None = None,
            out: str | None = None, ansi: bool = False, chunk: int = 16,
            text_out: str | None = None, read: bool = True) -> DataFrame | None:
        """Run ``text`` over each window; results land in ``out`` as a versioned set
        (:class:`~rillet.sinks.window_results.WindowResults`).

        Running a window again replaces its result, also by none: then it is not read any
        more. ``text_out`` also holds each result row as a ``[a,b]`` text line (the result
        columns, without the window columns), partitioned by window end. Returns the
        results of these windows read back, or None when no window holds a row or
        they are not to be ``read``.
        """
        windows = list(self.windows() if windows is None else windows)
        if not windows:
            return None
        out = out or f"{self.root}/_results"
        results = self._results.setdefault(out, WindowResults(self.spark, out))
        ends = [w[1] for w in windows]
        if self.runs_each(text, ansi):
            rows = self._per_window(text, windows, ansi)
            counts = results.write(rows, ends)
        else:
            counts = {}
            for i in range(0, len(windows), chunk):
                rows = self._chunk(text, windows[i:i + chunk], ansi)
                counts |= results.write(rows, ends[i:i + chunk])
        if not read and not text_out:
            return None
        schema = T.StructType([f for f in rows.schema.fields if f.name != _WEND])
        found = results.read(ends, schema)
        if text_out:
            self._write_text(found, text_out, counts)
        return found

    def _write_text(self, found: DataFrame, text_out: str, counts: Mapping[int, int]) -> None:
        cols = [c for c in found.columns if c not in (WINDOW_START, WINDOW_END)]
        lines = render(found.withColumn(_WEND, micros_of(found, WINDOW_END)), "row", cols, keep=[_WEND])
        (lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(_WEND).text(text_out))
        # windows without a row any more: their lines of an earlier run go
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(text_out).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for end, n in counts.items():
            if not n:
                fs.delete(path(f"{text_out}/{_WEND}={end}"), True)

    def runs_each(self, text: str, ansi: bool) -> bool:
        """Whether the text can run for all windows at once (tried once per text)."""
        if (text, ansi) not in self._each:
            empty = self.window_views((self.start_us, self.start_us + self.length_us))
            self._each[text, ansi] = runs_each({n: d.schema for n, d in empty.items()}, text, self.spark, ansi)
        return self._each[text, ansi]

    def _per_window(self, text: str, windows: list[tuple[int, int]], ansi: bool) -> DataFrame:
        """The text over these windows as one plan, from their buckets alone."""
        lo, hi = min(w[0] for w in windows), max(w[1] for w in windows)
        wanted = {b for w in windows for b in self._range(w)}
        views = {}
        for name in self.names:
            views[name] = self._direct(name, lo, hi) if name in self.direct else self._staged(name, wanted)
        for name, fn in self.derived.items():
            views[name] = fn(views)
        rows = self.spark.createDataFrame([(w[0],) for w in windows], "_start long")
        due = rows.select(_ts_from_micros(F.col("_start"), bool(self.ntz)).alias(WINDOW_START),
                          _ts_from_micros(F.col("_start") + F.lit(self.length_us), bool(self.ntz)).alias(WINDOW_END))
        start = _interval(self.start_us) if self.start_us else None
        res = sql_per_window(views, text, self.time_col, _interval(self.length_us), _interval(self.slide_us),
                             start, ansi, due)
        return res.withColumn(_WEND, micros_of(res, WINDOW_END))

    def _range(self, window: tuple[int, int]) -> range:
        """The buckets of a window."""
        return range((window[0] - self.start_us) // self.bucket_us, (window[1] - self.start_us) // self.bucket_us)

    def _chunk(self, text: str, windows: list[tuple[int, int]], ansi: bool) -> DataFrame:
        """The text analysed for each of a few windows, and the union of these plans."""
        parts = []
        with borrowed_views(self.spark, [*self.names, *self.derived]), ansi_mode(self.spark, ansi):
            for w in windows:
                for name, df in self.window_views(w).items():
                    df.createOrReplaceTempView(name)
                res = self.spark.sql(text)
                parts.append(res.select(ts_literal(w[0], bool(self.ntz)).alias(WINDOW_START),
                                        ts_literal(w[1], bool(self.ntz)).alias(WINDOW_END),
                                        *res.columns, F.lit(w[1]).cast("long").alias(_WEND)))
        # every part has the text's columns in the same order
        while len(parts) > 1:
            parts = [parts[i].union(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                     for i in range(0, len(parts), 2)]
        return parts[0]


def staged_windowed_sql(views: Mapping[str, DataFrame], text: str, time_col: str, length,
                        slide=None, start=None, ansi: bool = False, chunk: int = 16,
                        stage: bool = True) -> DataFrame | None:
    """Path S for bounded input: the unchanged ``text`` over each window of staged views.
    ``stage=False`` filters the views by time range instead of staging them."""
    spark = next(iter(views.values())).sparkSession
    st = SlideStage(spark, time_col, length, slide, start)
    for name, df in views.items():
        st.append(name, df, stage=stage)
    return st.run(text, ansi=ansi, chunk=chunk)
