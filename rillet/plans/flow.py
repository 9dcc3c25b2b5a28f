"""The composed flow: raw lines -> typed ``input`` -> derived rows ->
optional per-batch SQL -> ``output``, and SQL over sliding windows of both.

:class:`LogFlow` only builds lazy DataFrame plans; the same object drives a
bounded replay (:meth:`LogFlow.views`) and a stream
(:class:`rillet.streaming.FlowStream`). Besides their declared fields, the
tables carry the arrival time column (``arrival_ts``), which windows use.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import FunctionRegistry
from ..operators.parse import bad_rows, good_rows, parse_lines
from ..operators.rules import compile_rules, parse_rules
from ..operators.sql_stage import (borrowed_views, is_row_wise, referenced_views, run_sql, run_sql_rows,
                                   runs_each)
from ..operators.windows import (WINDOW_END, WINDOW_START, SlideStage, explode_windows, sql_per_window,
                                 staged_windowed_sql, ts_literal, window_stats, windowed_sql, windows_of)
from ..session import scratch_dir
from ..sources.lines import ARRIVAL
from ..types import SchemaError, as_schema

EXTRA_INPUT = "extraInput"
INPUT = "input"
OUTPUT = "output"
# The default per-batch SQL, and the shipped window settings
# (batch 2 s, window 18 s sliding by 6 s).
DEFAULT_EXTRA_SQL = "SELECT * FROM extraInput"
DEFAULT_BATCH_SECONDS = 2
DEFAULT_WINDOW_MS = 18000
DEFAULT_SLIDE_MS = 6000


@dataclass
class LogFlow:
    """One configured flow.

    * ``input_schema`` / ``output_schema``: declared fields (dict, pairs, JSON text);
    * ``rules``: rule texts (``out:Class:function:args``) or :class:`~rillet.operators.Rule`s;
    * ``fmt`` (``separator`` | ``json`` | ``xml``), ``separator`` (a regex),
      ``on_error`` (``fail`` | ``null`` | ``quarantine``), ``strict_keys``, ``xml_any_depth``;
    * ``extra_sql``: per-batch SQL over ``extraInput`` (None: derived rows pass through),
      optionally checked against ``extra_sql_schema``;
    * ``window_sql``: SQL over ``input`` / ``output`` per window of ``window_length``
      sliding by ``window_slide`` (ints are milliseconds), offset by ``window_start``;
    * ``ansi``: ANSI mode for the user SQL (off: lenient coercion);
    * ``registry``: rule functions (default: the shipped ones);
    * ``time_col``: the arrival time column of the raw lines;
    * ``batch_interval``: in a bounded replay, the micro-batch length (int: milliseconds) that
      per-batch SQL without a time of its own is run for.
    """

    input_schema: object
    output_schema: object
    rules: object
    fmt: str = "separator"
    separator: str = "\t"
    on_error: str = "fail"
    extra_sql: str | None = None
    window_sql: str | None = None
    window_length: object = DEFAULT_WINDOW_MS
    window_slide: object = DEFAULT_SLIDE_MS
    window_start: object = None
    ansi: bool = False
    registry: FunctionRegistry | None = None
    time_col: str = ARRIVAL
    strict_keys: bool = False
    xml_any_depth: bool = True
    extra_sql_schema: object = None
    batch_interval: object = None
    parsed_rules: list = field(init=False, repr=False)
    _compiled: list | None = field(init=False, repr=False, default=None)

    def __post_init__(self):
        self.input_schema = as_schema(self.input_schema)
        self.output_schema = as_schema(self.output_schema)
        self.parsed_rules = parse_rules(self.rules)
        if self.extra_sql_schema is not None:
            self.extra_sql_schema = as_schema(self.extra_sql_schema)
        for reserved in (self.time_col,):
            if reserved in self.input_schema or reserved in self.output_schema:
                raise SchemaError(f"field name {reserved!r} is reserved for the arrival time")

    # -- per-row stages ---------------------------------------------------
    def parse(self, raw: DataFrame) -> DataFrame:
        """Typed ``input`` rows: the declared input fields and the arrival time.
        With ``on_error="quarantine"`` only the good lines (see :meth:`bad_lines`)."""
        parsed = parse_lines(raw, self.input_schema, self.fmt, self.separator, self.on_error,
                             strict_keys=self.strict_keys, xml_any_depth=self.xml_any_depth)
        return good_rows(parsed) if self.on_error == "quarantine" else parsed

    def parse_checked(self, raw: DataFrame) -> DataFrame:
        """Every line with its parsed fields, ``_raw`` and ``_errors`` (null when
        good); split it with :func:`good_rows` / :func:`bad_rows`."""
        return parse_lines(raw, self.input_schema, self.fmt, self.separator, "quarantine",
                           strict_keys=self.strict_keys, xml_any_depth=self.xml_any_depth)

    def bad_lines(self, raw: DataFrame) -> DataFrame:
        """Rejected lines and their reasons (``on_error="quarantine"``)."""
        return bad_rows(self.parse_checked(raw))

    def derive(self, typed: DataFrame) -> DataFrame:
        """Derived rows: the declared output fields and the arrival time.
        The rules are compiled once per flow; the columns are unresolved
        expressions, reusable on any DataFrame with the input fields."""
        if self._compiled is None:
            self._compiled = compile_rules(self.parsed_rules, self.input_schema,
                                           self.output_schema, self.registry,
                                           "fail" if self.on_error == "fail" else "null")
        keep = [self.time_col] if self.time_col in typed.columns else []
        return typed.select(*self._compiled, *keep)

    def finalize(self, derived: DataFrame, batch_time_us: int | None = None) -> DataFrame:
        """Per-batch SQL over ``extraInput`` (when set) for one micro-batch. A result
        without the arrival time column is stamped with ``batch_time_us``
        (microseconds since the epoch)."""
        if self.extra_sql is None:
            return derived
        result = self._declared(run_sql({EXTRA_INPUT: derived}, self.extra_sql, ansi=self.ansi))
        if self.time_col in result.columns or self.time_col not in derived.columns:
            return result
        if batch_time_us is None:
            raise SchemaError(f"per-batch SQL returns no {self.time_col!r}: give the batch's time")
        ntz = isinstance(derived.schema[self.time_col].dataType, T.TimestampNTZType)
        return result.withColumn(self.time_col, ts_literal(batch_time_us, ntz))

    def _declared(self, result: DataFrame) -> DataFrame:
        """Optional check: the analysed result must have the declared columns."""
        if self.extra_sql_schema is None:
            return result
        got = [c for c in result.columns if c != self.time_col]
        if got != self.extra_sql_schema.names:
            raise SchemaError(f"per-batch SQL returns {got}, "
                              f"declared {self.extra_sql_schema.names}")
        return result.select(*[F.col(f"`{f.name}`").cast(f.data_type).alias(f.name)
                               for f in self.extra_sql_schema],
                             *[c for c in result.columns if c == self.time_col])

    def finalize_replay(self, derived: DataFrame) -> DataFrame:
        """Per-batch SQL (when set) in a bounded replay, where all batches come at once.

        A text that returns the arrival time is run as it is. One that handles each row by
        itself gives its arrival time to what it makes of it: such a text should return the
        arrival time itself where it filters, as Spark then needs no join of the rows with
        their results. Any other text is run for each ``batch_interval`` of the arrival
        time, whose rows get its start, and without one it is an error when the plan is built.
        """
        if self.extra_sql is None or self.time_col not in derived.columns:
            return self.finalize(derived)
        spark, text = derived.sparkSession, self.extra_sql
        empty = spark.createDataFrame([], derived.schema)
        with borrowed_views(spark, [EXTRA_INPUT]):
            if self.time_col in run_sql({EXTRA_INPUT: empty}, text, ansi=self.ansi).columns:
                return self.finalize(derived)
        if is_row_wise(EXTRA_INPUT, derived.schema, text, spark, self.ansi):
            result = run_sql_rows(derived, EXTRA_INPUT, self.time_col, text, self.ansi)
            return self._declared(result.select(*[f"`{c}`" for c in result.columns if c != self.time_col], self.time_col))
        if self.batch_interval is None:
            raise SchemaError(f"per-batch SQL that returns no {self.time_col!r} and combines rows needs "
                              "a batch_interval in a bounded replay")
        if runs_each({EXTRA_INPUT: derived.schema}, text, spark, self.ansi):
            result = sql_per_window({EXTRA_INPUT: derived}, text, self.time_col, self.batch_interval, ansi=self.ansi)
        else:
            result = staged_windowed_sql({EXTRA_INPUT: derived}, text, self.time_col,
                                         self.batch_interval, ansi=self.ansi)
            if result is None:  # no rows, so no batches
                return self.finalize(empty, batch_time_us=0)
        kept = [F.col(f"`{c}`") for c in result.columns if c not in (self.time_col, WINDOW_START, WINDOW_END)]
        return self._declared(result.select(*kept, F.col(WINDOW_START).alias(self.time_col)))

    def views(self, raw: DataFrame, materialize: bool = False) -> dict[str, DataFrame]:
        """``input`` and ``output`` for a bounded replay.

        Both views come from one parse plan, which Spark runs once per view a
        query reads. ``materialize`` parses once instead: the typed rows are
        written to the shared scratch folder (which also cuts the lineage)
        and both views read that table.
        """
        typed = self.parse(raw)
        if materialize:
            path = scratch_dir(typed.sparkSession, "typed")
            typed.write.parquet(path)
            typed = typed.sparkSession.read.schema(typed.schema).parquet(path)
        return {INPUT: typed, OUTPUT: self.finalize_replay(self.derive(typed))}

    # -- windows ----------------------------------------------------------
    def window_args(self) -> tuple:
        return (self.time_col, self.window_length, self.window_slide, self.window_start)

    def window_stats(self, raw: DataFrame, value_field: str) -> DataFrame:
        """Path N: sum, count, min and max of one input field per window."""
        return window_stats(self.parse(raw), value_field, *self.window_args())

    def exploded(self, raw: DataFrame) -> dict[str, DataFrame]:
        """Both views with ``window_start``/``window_end`` (path A)."""
        return {n: explode_windows(d, *self.window_args()) for n, d in self.views(raw).items()}

    def window_sql_grouped(self, raw: DataFrame, text: str | None = None) -> DataFrame:
        """Path A: SQL that groups or joins on the window columns, all windows in one job.
        Lines are parsed once: a text that reads more than one view (or one twice) reads
        the typed table written for it."""
        text = text or self.window_sql
        empty = {n: explode_windows(d, *self.window_args()) for n, d in self._stand_ins(self.parse(raw)).items()}
        both = len(referenced_views(empty, text, raw.sparkSession, self.ansi)) > 1
        return windowed_sql(self.views(raw, materialize=both), text, *self.window_args(), ansi=self.ansi)

    def window_sql_each(self, raw: DataFrame, text: str | None = None, chunk: int = 16) -> DataFrame | None:
        """The unchanged text over each window that holds a line.

        One job computes all windows (path L); lines are parsed once, or written typed
        where the text reads both views. A text that Spark cannot take as a correlated
        subquery runs once per window over staged rows (path S). There only the views the
        text reads are staged; without per-batch SQL the derived rows are a row-wise function
        of the input, so ``output`` is derived per window from the staged input.
        """
        text = text or self.window_sql
        typed = self.parse(raw)
        empty = self._stand_ins(typed)
        spark = typed.sparkSession
        needed = referenced_views(empty, text, spark, self.ansi)
        if runs_each({n: empty[n].schema for n in empty}, text, spark, self.ansi):
            views = self.views(raw, materialize=len(needed) > 1)
            # a quarantined line holds no row; any other line is one
            lines = typed if self.on_error == "quarantine" else raw
            return sql_per_window({n: d for n, d in views.items() if n in needed}, text, *self.window_args(),
                                  ansi=self.ansi, windows=windows_of(lines, *self.window_args())) if needed else \
                sql_per_window(views, text, *self.window_args(), ansi=self.ansi)
        stage = SlideStage(spark, *self.window_args())
        if INPUT in needed or (OUTPUT in needed and self.extra_sql is None):
            stage.append(INPUT, typed)
        if OUTPUT in needed:
            if self.extra_sql is None:
                stage.derived[OUTPUT] = lambda views: self.derive(views[INPUT])
            else:
                stage.append(OUTPUT, self.finalize_replay(self.derive(typed)))
        return stage.run(text, ansi=self.ansi, chunk=chunk)

    def _stand_ins(self, typed: DataFrame) -> dict[str, DataFrame]:
        """Empty views of the same schemas, with no plan of their own."""
        spark = typed.sparkSession
        empty = spark.createDataFrame([], typed.schema)
        output = self.finalize(self.derive(empty), batch_time_us=0)
        return {INPUT: empty, OUTPUT: spark.createDataFrame([], output.schema)}

    def needed_views(self, typed: DataFrame, text: str) -> set[str]:
        """Which of ``input`` / ``output`` the window text reads (analysis only)."""
        return referenced_views(self._stand_ins(typed), text, typed.sparkSession, self.ansi)
