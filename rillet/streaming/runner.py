"""Running a :class:`~rillet.plans.LogFlow` on Structured Streaming.

:class:`FlowStream` is a ``foreachBatch`` driver. Per micro-batch it

1. parses the batch once and persists the typed rows (several outputs read them);
2. parses, derives and runs the per-batch SQL (``extraInput``);
3. writes the final rows as text lines into partition ``batch_id=N`` of
   ``output_path`` (dynamic overwrite: a replayed batch replaces itself), and
   quarantined lines into ``bad_path``;
4. stages ``input`` rows (and ``output`` rows when per-batch SQL is set;
   otherwise they are derived per window) by slide bucket, and runs the
   window SQL for every window that closed (window end <= latest arrival -
   lateness), writing a versioned set to ``sql_output_path`` (read it with
   :meth:`FlowStream.results` or ``read_window_results``) and, with
   ``sql_text_path``, the same rows as ``[a,b]`` text lines.

No record is lost by default: without ``lateness``, a window that already ran is run
again when a later batch brings rows for it, and staged rows stay. With ``lateness``, a
window is final once the latest arrival is that far past its end and staged rows expire;
lines that come later still are counted (``late_rows``) and written to ``late_path``.

Empty batches write nothing. :meth:`FlowStream.flush` runs the windows still
open when the input ends; they are provisional, a later run completes them. Spark's
checkpoint (``checkpoint``) makes the source offsets recoverable; staged rows and a
progress mark, written only after all windows of an emit, are taken up again after a
restart. A batch replayed after a failure replaces its own rows, and window results count
only once they are committed: a window that is run again, after late rows or a failure,
has the result of its last run, or none if that gave no row.

:func:`stream_window_stats` is the native alternative for the default
statistics query: ``withWatermark`` + ``groupBy(window)``, with one aggregate
per open window in the state store instead of staged rows.
"""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import ERRORS_COL, bad_rows, good_rows
from ..operators.render import render
from ..operators.windows import SlideStage, duration_us, micros_of, wall_clock, window_stats
from ..sinks import echo
from ..sinks.window_results import WindowResults
from ..plans.flow import DEFAULT_BATCH_SECONDS, INPUT, OUTPUT, LogFlow
from ..session import scratch_dir


NEVER = -(2**62)


class _Stats(NamedTuple):
    n: int
    first: int | None
    last: int | None


class BatchCounts(NamedTuple):
    """Rows of one micro-batch; ``rows_out`` is None where nothing was written."""
    batch_id: int
    rows_in: int
    rows_bad: int
    rows_out: int | None


def _observed(seen: Observation) -> int:
    """The rows counted; 0 where Spark saw on the way that there are none and counted nothing."""
    try:
        return seen.get.get("rows", 0)
    except Py4JJavaError:
        return 0


class FlowStream:
    """See the module's text. ``counts`` holds the :class:`BatchCounts` of the last 1,000
    batches, taken while their rows are read and written, without a job of their own;
    ``on_batch`` is called with each."""

    def __init__(self, flow: LogFlow, lines: DataFrame, output_path: str | None = None,
                 sql_output_path: str | None = None, checkpoint: str | None = None,
                 trigger_seconds: float = DEFAULT_BATCH_SECONDS, lateness=None,
                 output_form: str = "list", stage_root: str | None = None,
                 echo_rows: int = 0, bad_path: str | None = None, expire: bool = True,
                 sql_text_path: str | None = None, late_path: str | None = None,
                 on_batch: Callable[[BatchCounts], None] | None = None):
        self.flow = flow
        self.lines = lines
        self.output_path = output_path
        self.sql_output_path = sql_output_path
        self.spark = lines.sparkSession
        self.checkpoint = checkpoint or scratch_dir(self.spark, "stream")
        self.trigger_seconds = trigger_seconds
        self.lateness_us = duration_us(lateness) if lateness is not None else None
        self.late_path = late_path or f"{self.checkpoint}/late"
        self.late_rows = 0
        self.counts: deque[BatchCounts] = deque(maxlen=1000)
        self.on_batch = on_batch
        self.output_form = output_form
        self.echo_rows = echo_rows
        self.bad_path = bad_path
        self.expire = expire
        self.sql_text_path = sql_text_path
        self.stage = None
        self.needed: set[str] = set()
        if flow.window_sql and sql_output_path:
            self.stage = SlideStage(self.spark, flow.time_col, flow.window_length,
                                    flow.window_slide, flow.window_start,
                                    root=stage_root or f"{self.checkpoint}/stage")
            WindowResults(self.spark, sql_output_path).clean()  # what a crash left uncommitted
            # stage only what the window text reads; without per-batch SQL the
            # derived rows are a row-wise function of the input: derive per window
            typed_schema = flow.parse(self.spark.createDataFrame([], lines.schema))
            self.needed = flow.needed_views(typed_schema, flow.window_sql)
            if OUTPUT in self.needed and flow.extra_sql is None:
                self.stage.derived[OUTPUT] = lambda views: flow.derive(views[INPUT])
        self.closed_until, self.last_seen = self._progress()
        if self.stage is not None:
            empty = self.spark.createDataFrame([], typed_schema.schema)
            if self.lateness_us is None and self.closed_until > NEVER:
                self.stage.forget(self._open_from())
            if self._stages(INPUT):
                self.stage.restore(INPUT, typed_schema.schema)
            if self._stages(OUTPUT):
                self.stage.restore(OUTPUT, flow.finalize(flow.derive(empty), batch_time_us=0).schema)
        self.query: StreamingQuery | None = None
        self._lock = threading.RLock()

    def start(self, available_now: bool = False) -> StreamingQuery:
        writer = (self.lines.writeStream.foreachBatch(self.process_batch)
                  .option("checkpointLocation", f"{self.checkpoint}/offsets"))
        if available_now:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=f"{self.trigger_seconds} seconds")
        self.query = writer.start()
        return self.query

    def run(self) -> None:
        """Start on the processing-time trigger and run until stopped.

        Between micro-batches, windows closed by the wall clock are emitted
        even when no new line arrives (see :meth:`tick`)."""
        query = self.start()
        while not query.awaitTermination(self.trigger_seconds):
            self.tick()

    def _stages(self, name: str) -> bool:
        if name == INPUT:
            return INPUT in self.needed or self.flow.extra_sql is None
        return OUTPUT in self.needed and self.flow.extra_sql is not None

    def tick(self, now_us: int | None = None) -> None:
        """Emit the windows that ended before ``now_us`` (default: the wall
        clock) minus the lateness, if the last trigger found no new lines."""
        if self.stage is None or not self.stage.names:
            return
        if self.query is not None:
            last = self.query.lastProgress
            if last is None or last["numInputRows"]:
                return  # lines are still coming in: their arrival times close windows
        if now_us is None:
            now_us = time.time_ns() // 1000
        with self._lock:
            self._emit(now_us - (self.lateness_us or 0), set())

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        with self._lock:
            self._process_batch(batch, batch_id)

    def _process_batch(self, batch: DataFrame, batch_id: int) -> None:
        flow = self.flow
        # each line is parsed once per batch; good and bad rows come from the cache
        quarantine = flow.on_error == "quarantine"
        stats = None
        parsed = (flow.parse_checked(batch) if quarantine else flow.parse(batch)).persist()
        typed = good_rows(parsed) if quarantine else parsed
        try:
            # one small job: good and bad rows, first and last arrival, rows per slide bucket
            good = F.col(ERRORS_COL).isNull() if quarantine else F.lit(True)
            micros = F.when(good, micros_of(parsed, flow.time_col))
            key = F.when(good, self.stage.bucket_of(parsed)) if self.stage is not None else F.lit(0)
            per_bucket = (parsed.groupBy(key.alias("b"))
                          .agg(F.count_if(good).alias("n"), F.count_if(~good).alias("bad"),
                               F.min(micros).alias("first"), F.max(micros).alias("last")).collect())
            stats = _Stats(sum(r.n for r in per_bucket),
                           min((r.first for r in per_bucket if r.first is not None), default=None),
                           max((r.last for r in per_bucket if r.last is not None), default=None))
            bad = sum(r.bad for r in per_bucket)
            if self.bad_path and quarantine:
                (bad_rows(parsed).withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
                    .parquet(self.bad_path))
            if stats.n == 0:
                self._count(batch_id, bad, bad, None)
                return
            final = flow.finalize(flow.derive(typed), batch_time_us=stats.first)
            if flow.extra_sql is not None:
                final = final.persist()  # several outputs read it; the text runs once
            # counted by the first write; an echo reads a few rows only
            written = Observation()
            counted = final.observe(written, F.count(F.lit(1)).alias("rows"))
            cols = [c for c in final.columns if c != flow.time_col]
            if self.echo_rows:
                echo(batch.select("value"), self.echo_rows, f"batch {batch_id} lines:")
                echo(final.select(*cols), self.echo_rows, f"batch {batch_id} rows:")
            if self.output_path:
                lines = render(counted, self.output_form, cols).withColumn(
                    "batch_id", F.lit(int(batch_id)))
                (lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                      .partitionBy("batch_id").text(self.output_path))
            if self.stage is not None:
                self._keep_late(typed, batch_id)
                if self._stages(INPUT):
                    self.stage.append(INPUT, typed, batch_id, track=True,
                                      counts={r.b: r.n for r in per_bucket})
                if self._stages(OUTPUT):
                    self.stage.append(OUTPUT, final if self.output_path else counted, batch_id, track=True)
                if stats.last is not None:
                    self.last_seen = max(self.last_seen, stats.last)
                    self._emit(self.last_seen - (self.lateness_us or 0),
                               {r.b for r in per_bucket if r.b is not None})
            wrote = bool(self.output_path or (self.stage is not None and self._stages(OUTPUT)))
        finally:
            if flow.extra_sql is not None and stats is not None and stats.n:
                final.unpersist()
            parsed.unpersist()
        self._count(batch_id, stats.n + bad, bad, _observed(written) if wrote else None)

    def _count(self, batch_id: int, rows_in: int, rows_bad: int, rows_out: int | None) -> None:
        self.counts.append(BatchCounts(batch_id, rows_in, rows_bad, rows_out))
        if self.on_batch is not None:
            self.on_batch(self.counts[-1])

    def _keep_late(self, typed: DataFrame, batch_id: int) -> None:
        """With a lateness: rows of windows that are final go to the late rows' table."""
        if self.lateness_us is None or self.closed_until <= NEVER:
            return
        # the first window of a row is final if it ended by then
        start, slide, length = self.stage.start_us, self.stage.slide_us, self.stage.length_us
        at = micros_of(typed, self.flow.time_col) - F.lit(start)
        last_start = at - F.pmod(at, F.lit(slide))
        first_end = last_start - F.lit((length - 1) // slide * slide) + F.lit(length)
        first_end = F.when(first_end > at, first_end).otherwise(first_end + F.lit(slide)) + F.lit(start)
        late = typed.where(first_end <= F.lit(self.closed_until))
        n = late.count()
        if n:
            self.late_rows += n
            (late.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.late_path))

    def flush(self) -> None:
        """Run every window that is not final, those still open included. They count as
        provisional: rows of a later batch or run complete them."""
        if self.stage is not None and self.stage.names:
            with self._lock:
                due = [w for w in self.stage.windows() if w[1] > self.closed_until]
                self._run(due)

    def _emit(self, closed_before_us: int, touched: set[int]) -> None:
        again: set[tuple[int, int]] = set()
        if self.lateness_us is None and touched:
            again = {w for w in self.stage.windows(touched) if w[1] <= self.closed_until}
        due = sorted(again.union(w for w in self.stage.windows() if self.closed_until < w[1] <= closed_before_us))
        if not due:
            return
        self._run(due)
        last = max(w[1] for w in due)
        if last > self.closed_until:
            self.closed_until = last
            self._mark_progress()
            if self.lateness_us is None:
                self.stage.forget(self._open_from())
            elif self.expire:
                self.stage.expire(self._open_from())

    def _open_from(self) -> int:
        """The start of the earliest window still to come."""
        return self.closed_until - self.stage.length_us + self.stage.slide_us

    def _run(self, due: list[tuple[int, int]]) -> None:
        if not due:
            return
        res = self.stage.run(self.flow.window_sql, due, out=self.sql_output_path,
                             ansi=self.flow.ansi, text_out=self.sql_text_path, read=bool(self.echo_rows))
        if self.echo_rows and res is not None:
            echo(res, self.echo_rows, "window results:")

    def results(self) -> DataFrame:
        """The current results of the window SQL."""
        return WindowResults(self.spark, self.sql_output_path).read()

    def _mark_progress(self) -> None:
        """After all windows up to ``closed_until`` are written; marks only grow."""
        (self.spark.range(1).select(F.lit(self.closed_until).alias("closed"), F.lit(self.last_seen).alias("seen"))
             .write.mode("append").json(f"{self.checkpoint}/progress"))

    def _progress(self) -> tuple[int, int]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}/progress")
        if not path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return NEVER, NEVER
        row = (self.spark.read.schema("closed long, seen long").json(f"{self.checkpoint}/progress")
               .agg(F.max("closed"), F.max("seen")).first())
        return (NEVER, NEVER) if row[0] is None else (row[0], row[1])


def stream_window_stats(flow: LogFlow, lines: DataFrame, value_field: str,
                        watermark: str | None = "0 seconds") -> DataFrame:
    """Path N on a stream: per-window sum, count, min, max of one input field.

    Write it with ``outputMode("update")`` for early results, or ``"append"``
    for one final row per window once the watermark passes its end. ``watermark=None``
    (update mode only) loses no row however late; state is one aggregate a window for ever.
    """
    typed = flow.parse(lines)
    ntz = isinstance(typed.schema[flow.time_col].dataType, T.TimestampNTZType)
    if ntz:
        # the watermark needs instants: read the wall-clock time as UTC (no
        # session time zone involved), and turn window bounds back afterwards
        typed = typed.withColumn(flow.time_col, F.timestamp_micros(micros_of(typed, flow.time_col)))
    if watermark is not None:
        typed = typed.withWatermark(flow.time_col, watermark)
    # one event-time window aggregation, so the watermark can expire its state
    stats = window_stats(typed, value_field, *flow.window_args(), panes=False)
    if ntz:
        for c in ("window_start", "window_end"):
            stats = stats.withColumn(c, wall_clock(F.unix_micros(F.col(c))))
    return stats


def write_window_updates(stats: DataFrame, path: str, checkpoint: str,
                         available_now: bool = False,
                         trigger_seconds: float = DEFAULT_BATCH_SECONDS) -> StreamingQuery:
    """Sink for streaming window aggregates (e.g. :func:`stream_window_stats`).

    Update mode: each micro-batch carries only the windows it changed, and
    writes them into their own partitions (``_wend``, the window end) with
    dynamic overwrite. The table always holds the latest value of every
    window, state stays bounded by the watermark, and a replayed batch
    rewrites the same partitions.
    """
    writer = (stats.writeStream.outputMode("update")
              .foreachBatch(lambda df, batch_id: write_window_batch(df, path))
              .option("checkpointLocation", checkpoint))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=f"{trigger_seconds} seconds"))
    return writer.start()


def write_window_batch(updated: DataFrame, path: str) -> None:
    """Write the windows of one update: each into its own ``_wend`` partition,
    replacing only the partitions of these windows."""
    (updated.withColumn("_wend", micros_of(updated, "window_end")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("_wend").parquet(path))
