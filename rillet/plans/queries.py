"""Registered queries over the driver tables, and their DuckDB oracle SQL.

Every query reads whole tables. Rows of ``events``, ``lineitem`` or
``orders`` are rendered as raw lines (separator, JSON or XML), parsed back
by the library, run through rules, SQL stages and windows; the oracle
computes the same result straight from the table columns, so it does not
share the parser. Double results are rounded on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import BUILTIN_NAMESPACE as NS
from ..operators.parse import ERRORS_COL, RAW_COL, bad_rows, parse_lines
from ..operators.render import list_line, row_line, tab_line
from ..operators.rules import apply_rules
from ..operators.sql_stage import run_sql, stringify
from ..operators.union import tagged_union
from ..operators.band import band_semi_join
from ..operators.windows import micros_of, window_agg, window_distinct, window_stats
from ..sinks.window_results import read_window_results
from ..sources.lines import ARRIVAL, table_lines, xml_entries, xml_line
from .flow import LogFlow

HOURS_18 = "18 hours"
HOURS_6 = "6 hours"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- shared flows -------------------------------------------------------------

EVENT_FIELDS = {"event_id": "Long", "user_id": "Integer", "event_type": "String",
                "value": "Double", "props": "String"}
SIZE_RULES = [f'contentSizeWithUnit:{NS}:add:$user_id,"KB"', f'size:{NS}:add:$user_id,"MB"']
SIZE_RULES_CONTENT = [f'contentSizeWithUnit:{NS}:add:$contentSize,"KB"',
                      f'size:{NS}:add:$contentSize,"MB"']
EVENT_OUTPUT = {"size": "String", "kind": "String", "n": "Integer"}
EVENT_RULES = [f'size:{NS}:add:$user_id,"MB"', f"kind:{NS}:getOriginalStr:$event_type",
               f"n:{NS}:addOne:$user_id"]

LINEITEM_FIELDS = {
    "l_orderkey": "Long", "l_partkey": "Long", "l_suppkey": "Long", "l_linenumber": "Integer",
    "l_quantity": "Double", "l_extendedprice": "Double", "l_discount": "Double",
    "l_tax": "Double", "l_returnflag": "String", "l_linestatus": "String",
    "l_shipdate": "String",
}

KEYED_FIELDS = {"uid": "String", "user_id": "Integer", "event_type": "String", "value": "Double"}
KEYED_OUTPUT = {"k": "String", "size": "String", "n": "String"}
KEYED_RULES = [f"k:{NS}:getOriginalStr:$uid", f'size:{NS}:add:$user_id,"MB"',
               f"n:{NS}:addOne:$user_id"]


def event_lines(spark, sf_dir, fmt="separator", fields=None, quote_all=False) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return table_lines(ev, fields or list(EVENT_FIELDS), fmt, time_col="ts", quote_all=quote_all)


def event_flow(**kw) -> LogFlow:
    args = dict(input_schema=EVENT_FIELDS, output_schema=EVENT_OUTPUT, rules=EVENT_RULES,
                window_length=HOURS_18, window_slide=HOURS_6)
    args.update(kw)
    return LogFlow(**args)


def keyed_lines(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events").withColumn("uid", F.col("event_id").cast("string"))
    return table_lines(ev, list(KEYED_FIELDS), time_col="ts")


def keyed_flow(**kw) -> LogFlow:
    args = dict(input_schema=KEYED_FIELDS, output_schema=KEYED_OUTPUT, rules=KEYED_RULES,
                window_length=HOURS_18, window_slide=HOURS_6)
    args.update(kw)
    return LogFlow(**args)


def lineitem_input(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return parse_lines(table_lines(li, list(LINEITEM_FIELDS)), LINEITEM_FIELDS)


# -- parsing ------------------------------------------------------------------

def q_parse_separator(spark, sf_dir):
    return lineitem_input(spark, sf_dir)


def q_parse_json(spark, sf_dir):
    # keys in another order than declared, user_id quoted like a string
    ev = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id").cast("string"))
    raw = table_lines(ev, ["props", "value", "user_id", "event_type", "event_id"], "json")
    schema = {"event_id": "Long", "user_id": "Long", "event_type": "String",
              "value": "Double", "props": "String"}
    return parse_lines(raw, schema, "json", strict_keys=True)


def q_parse_xml(spark, sf_dir):
    raw = table_lines(table(spark, sf_dir, "events"),
                      ["props", "value", "user_id", "event_type", "event_id"], "xml")
    schema = {"event_id": "Long", "user_id": "Long", "event_type": "String",
              "value": "Double", "props": "String"}
    return parse_lines(raw, schema, "xml", strict_keys=True)


def q_parse_separator_regex(spark, sf_dir):
    # a literal pipe between fields, read back with the escaped regex \\|
    fields = {"l_orderkey": "Long", "l_linenumber": "Integer", "l_returnflag": "String",
              "l_linestatus": "String", "l_quantity": "Double"}
    raw = table_lines(table(spark, sf_dir, "lineitem"), list(fields), separator="|")
    return parse_lines(raw, fields, separator="\\|")


def q_parse_xml_nested(spark, sf_dir):
    # two entries nested one level down, found with the any-depth reader
    ev = table(spark, sf_dir, "events")
    line = F.concat(F.lit("<xml><group>"), xml_entries(["event_id", "user_id"]),
                    F.lit("</group>"), xml_entries(["event_type", "value"]), F.lit("</xml>"))
    schema = {"event_id": "Long", "user_id": "Long", "event_type": "String", "value": "Double"}
    return parse_lines(ev.select(line.alias("value")), schema, "xml", xml_any_depth=True)


def q_parse_xml_bad_rows(spark, sf_dir):
    """Lines with something after the root element, each kind of event its own way."""
    ev = table(spark, sf_dir, "events")
    tail = F.expr("CASE event_type WHEN 'click' THEN '<xml/>' WHEN 'view' THEN ' <!-- end -->' "
                  "WHEN 'error' THEN 'text' WHEN 'purchase' THEN '<entry' ELSE '' END")
    line = F.concat(xml_line(["event_id", "user_id", "event_type", "value", "props", "ts"]), tail)
    schema = {"event_id": "Long", "user_id": "Long", "event_type": "String", "value": "Double",
              "props": "String", "ts": "String"}
    parsed = parse_lines(ev.select("event_id", "event_type", line.alias("value")).withColumnsRenamed(
        {"event_id": "id", "event_type": "kind"}), schema, "xml", on_error="quarantine", xml_any_depth=True)
    return parsed.select("id", "kind", "event_id", "user_id", "value", F.col(ERRORS_COL).alias("reason"))


def q_parse_null_mode(spark, sf_dir):
    # the user id of every error event arrives as "x" and is read as null
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("x")).otherwise(
            F.col("user_id").cast("string")).alias("user_id"),
        "event_type")
    schema = {"event_id": "Long", "user_id": "Integer", "event_type": "String"}
    return parse_lines(table_lines(ev, list(schema)), schema, on_error="null")


def q_coerce_types(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        ((F.col("event_id") % 200) - 100).alias("b"),
        F.col("user_id").alias("s"),
        F.col("event_id").alias("i"),
        (F.col("event_id") * 1000003).alias("l"),
        F.col("value").alias("f"),
        F.col("value").alias("d"),
        F.expr("CASE event_type WHEN 'click' THEN 'TRUE' WHEN 'view' THEN 'true' "
               "WHEN 'error' THEN 'yes' WHEN 'purchase' THEN ' true' ELSE 'false' END").alias("t"),
        F.substring("event_type", 1, 1).alias("c"),
        F.col("event_type").alias("str"),
    )
    schema = {"id": "Long", "b": "Byte", "s": "Short", "i": "int", "l": "long", "f": "Float",
              "d": "double", "t": "Boolean", "c": "char", "str": "String"}
    return parse_lines(table_lines(ev, list(schema)), schema)


def q_coerce_bad_rows(spark, sf_dir):
    # the user id of every error event arrives as "x"
    ev = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("x")).otherwise(
            F.col("user_id").cast("string")).alias("user_id"),
        "event_type")
    schema = {"event_id": "Long", "user_id": "Integer", "event_type": "String"}
    parsed = parse_lines(table_lines(ev, list(schema)), schema, on_error="quarantine")
    return bad_rows(parsed).select(F.col(RAW_COL).alias("line"),
                                   F.col(ERRORS_COL).alias("reason"))


# -- rules and functions --------------------------------------------------------

def _event_input(spark, sf_dir):
    return parse_lines(event_lines(spark, sf_dir), EVENT_FIELDS)


def _derive(spark, sf_dir, rules, output):
    return apply_rules(_event_input(spark, sf_dir), rules, output, EVENT_FIELDS)


def q_rules_project(spark, sf_dir):
    return _derive(spark, sf_dir, SIZE_RULES,
                   {"contentSizeWithUnit": "String", "size": "String"})


def q_rules_field_and_literal(spark, sf_dir):
    rules = [f"k:{NS}:getOriginalStr:$event_type", f's1:{NS}:add:$event_type,"x"',
             f"n1:{NS}:add:$user_id,3", f's2:{NS}:add:5,"KB"', f'u1:{NS}:toUpperCase:"abc"',
             f"n2:{NS}:addOne:41", f"n3:{NS}:add:-7,$user_id"]
    out = {"k": "String", "s1": "String", "n1": "Integer", "s2": "String", "u1": "String",
           "n2": "Integer", "n3": "Integer"}
    return _derive(spark, sf_dir, rules, out)


def q_rules_overloads(spark, sf_dir):
    rules = [f"a:{NS}:add:$user_id,$user_id", f"b:{NS}:add:$event_type,$event_type",
             f"c:{NS}:add:$user_id,$event_type"]
    return _derive(spark, sf_dir, rules, {"a": "Integer", "b": "String", "c": "String"})


def q_rules_typed_output(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn(
        "flag", F.when(F.col("event_type") == "click", "true").otherwise("no"))
    fields = {"user_id": "Integer", "flag": "String"}
    typed = parse_lines(table_lines(ev, list(fields)), fields)
    rules = [f"as_long:{NS}:addOne:$user_id", f"as_double:{NS}:addOne:$user_id",
             f"as_text:{NS}:addOne:$user_id", f"as_bool:{NS}:getOriginalStr:$flag"]
    out = {"as_long": "Long", "as_double": "Double", "as_text": "String", "as_bool": "Boolean"}
    return apply_rules(typed, rules, out, fields)


def q_rules_jvm_class(spark, sf_dir):
    """Rules that name classes on Spark's class path: their static methods run in the JVM,
    found by the argument types; results are read as the declared types."""
    return _derive(spark, sf_dir, ["hex:java.lang.Integer:toHexString:$user_id", "slot:java.lang.Math:floorMod:$user_id,7",
                                   "known:java.lang.Boolean:parseBoolean:$event_type", "kind:java.lang.String:valueOf:$event_id"],
                   {"hex": "String", "slot": "Integer", "known": "Boolean", "kind": "Long"})


def q_fn_upper(spark, sf_dir):
    return _derive(spark, sf_dir, [f"u:{NS}:toUpperCase:$event_type"], {"u": "String"})


def q_fn_add_one(spark, sf_dir):
    return apply_rules(lineitem_input(spark, sf_dir), [f"n:{NS}:addOne:$l_linenumber"],
                       {"n": "Integer"}, LINEITEM_FIELDS)


def q_fn_identity(spark, sf_dir):
    return _derive(spark, sf_dir, [f"e:{NS}:getOriginalStr:$event_type"], {"e": "String"})


# -- rendering ----------------------------------------------------------------------

def q_text_rows(spark, sf_dir):
    fields = {"o_orderkey": "Long", "o_custkey": "Long", "o_orderstatus": "String",
              "o_orderpriority": "String"}
    od = table(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.expr("nullif(o_orderstatus, 'F')"))
    # a null status is left out of the JSON line and read back as null
    typed = parse_lines(table_lines(od, list(fields), "json"), fields, "json")
    cols = list(fields)
    return typed.select(tab_line(cols).alias("tab_line"), list_line(cols).alias("list_line"),
                        row_line(cols).alias("row_line"))


# -- SQL stages -----------------------------------------------------------------------

def _extra_input(spark, sf_dir):
    flow = event_flow()
    return flow.derive(flow.parse(event_lines(spark, sf_dir))).drop(ARRIVAL)


def _extra_sql(spark, sf_dir, text):
    return run_sql({"extraInput": _extra_input(spark, sf_dir)}, text)


def q_extra_sql_project(spark, sf_dir):
    return _extra_sql(spark, sf_dir, (
        "SELECT size, upper(kind) AS kind_u, CAST(n AS BIGINT) * 2 AS n2, "
        "CASE WHEN n > 100 THEN 'big' ELSE 'small' END AS bucket FROM extraInput"))


def q_extra_sql_filter(spark, sf_dir):
    return _extra_sql(spark, sf_dir, (
        "SELECT size, kind, n FROM extraInput WHERE (kind IN ('click', 'view') "
        "AND n BETWEEN 10 AND 500 AND size LIKE '%1 MB') OR (kind RLIKE '^pur' AND NOT n IS NULL "
        "AND n < 20)"))


def q_extra_sql_agg(spark, sf_dir):
    return _extra_sql(spark, sf_dir, (
        "SELECT kind, COUNT(*) AS cnt, COUNT(DISTINCT size) AS n_sizes, SUM(n) AS sum_n, "
        "ROUND(AVG(n), 6) AS avg_n, MIN(size) AS min_size, MAX(size) AS max_size "
        "FROM extraInput GROUP BY kind HAVING COUNT(*) > 10"))


def q_stringify_result(spark, sf_dir):
    res = run_sql({"extraInput": _extra_input(spark, sf_dir)},
                  "SELECT n, kind, n > 50 AS big FROM extraInput")
    return stringify(res)


# -- windows -------------------------------------------------------------------------------

def q_window_stats(spark, sf_dir):
    stats = event_flow().window_stats(event_lines(spark, sf_dir), "value")
    return stats.withColumn("sum_value", F.round("sum_value", 2))


def q_window_stats_dense(spark, sf_dir):
    """250 hours sliding by 15 minutes: every row is in 1,000 windows, and no row is copied for them."""
    typed = event_flow().parse(event_lines(spark, sf_dir))
    return window_stats(typed, "value", ARRIVAL, "250 hours", "15 minutes").withColumn("sum_value", F.round("sum_value", 2))


def q_window_distinct(spark, sf_dir):
    """COUNT(DISTINCT user_id) of each window, exact, from bitmaps per pane."""
    typed = event_flow().parse(event_lines(spark, sf_dir))
    return window_distinct(typed, "user_id", ARRIVAL, HOURS_18, HOURS_6, by=["event_type"])


def q_window_distinct_sketch(spark, sf_dir):
    """The same from sketches of 4,096 registers: whether each number is within four standard
    errors (6.5 %) of the exact one, which stands beside it."""
    typed = event_flow().parse(event_lines(spark, sf_dir))
    near = window_distinct(typed, "user_id", ARRIVAL, HOURS_18, HOURS_6, lg_k=12).withColumnRenamed("n_distinct", "near")
    exact = window_distinct(typed, "user_id", ARRIVAL, HOURS_18, HOURS_6)
    return exact.join(near, ["window_start", "window_end"]).select(
        "window_start", "window_end", "n_distinct",
        (F.abs(F.col("near") - F.col("n_distinct")) <= F.col("n_distinct") * 0.065).alias("within"))


def q_sql_band_semi_join(spark, sf_dir):
    """Left semi join on a theta condition: rows up to a day after an error of the same user,
    WHERE EXISTS (SELECT 1 FROM input e WHERE e.user_id = i.user_id AND e.event_type = 'error'
    AND i.arrival_ts - e.arrival_ts BETWEEN INTERVAL 1 SECOND AND INTERVAL 24 HOURS)."""
    typed = event_flow().views(event_lines(spark, sf_dir), materialize=True)["input"]
    errors = typed.where("event_type = 'error'")
    day = 24 * 3600 * 1_000_000
    at = micros_of(typed, ARRIVAL)
    return band_semi_join(typed, errors, at, at, -day, -1_000_000, on=["user_id"]).select("event_id", "user_id", "event_type")


def q_window_tumbling(spark, sf_dir):
    typed = event_flow().parse(event_lines(spark, sf_dir))
    res = window_agg(typed, ARRIVAL, HOURS_6, by=["event_type"],
                     aggs=[F.count(F.lit(1)).alias("cnt"), F.sum("value").alias("sum_value")])
    return res.withColumn("sum_value", F.round("sum_value", 2))


WINDOW_INPUT_SQL = ("SELECT SUM(user_id) AS sum_user, COUNT(*) AS cnt, MIN(user_id) AS min_user, "
                    "MAX(user_id) AS max_user FROM input")


def q_window_sql_input(spark, sf_dir):
    return event_flow().window_sql_each(event_lines(spark, sf_dir), WINDOW_INPUT_SQL)


def q_window_sql_topn(spark, sf_dir):
    """The three largest values of each window: the text's LIMIT becomes a ranking by window."""
    return event_flow().window_sql_each(event_lines(spark, sf_dir), (
        "SELECT event_id, value FROM input ORDER BY value DESC, event_id LIMIT 3"))


def q_extra_sql_batches(spark, sf_dir):
    """Per-batch SQL that combines rows, run for each six hours of a bounded replay."""
    flow = event_flow(extra_sql="SELECT kind, COUNT(*) AS cnt, SUM(n) AS sum_n FROM extraInput GROUP BY kind",
                      batch_interval=HOURS_6)
    return flow.views(event_lines(spark, sf_dir))["output"].withColumnRenamed(ARRIVAL, "batch_start")


def q_window_sql_grouped(spark, sf_dir):
    text = ("SELECT window_start, window_end, event_type, COUNT(*) AS cnt, "
            "ROUND(SUM(value), 2) AS sum_value FROM input "
            "GROUP BY window_start, window_end, event_type")
    return event_flow().window_sql_grouped(event_lines(spark, sf_dir), text)


def q_window_sql_output(spark, sf_dir):
    text = ("SELECT window_start, window_end, SUM(size) AS sum_size, SUM(n) AS sum_n, "
            "COUNT(*) AS cnt, MIN(size) AS min_size, MAX(size) AS max_size FROM output "
            "GROUP BY window_start, window_end")
    return keyed_flow().window_sql_grouped(keyed_lines(spark, sf_dir), text)


def q_window_sql_join(spark, sf_dir):
    text = ("SELECT i.window_start, i.window_end, COUNT(*) AS pairs, "
            "COUNT(DISTINCT o.size) AS sizes, ROUND(SUM(i.value), 2) AS sum_value "
            "FROM input i JOIN output o ON i.window_start = o.window_start AND i.uid = o.k "
            "GROUP BY i.window_start, i.window_end")
    return keyed_flow().window_sql_grouped(keyed_lines(spark, sf_dir), text)


# The per-batch SQL and the window statistics text of the shipped settings,
# run as they are: XML input, the two size rules, one derived column kept.
SHIPPED_EXTRA_SQL = "SELECT size FROM extraInput"
SHIPPED_WINDOW_SQL = "SELECT SUM(size), COUNT(*), MIN(size), MAX(size) FROM output"


def q_shipped_settings_flow(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumnRenamed("user_id", "contentSize")
    raw = table_lines(ev, ["event_id", "contentSize", "event_type"], "xml", time_col="ts")
    flow = LogFlow(
        input_schema={"event_id": "Long", "contentSize": "Integer", "event_type": "String"},
        output_schema={"contentSizeWithUnit": "String", "size": "String"},
        rules=SIZE_RULES_CONTENT, fmt="xml",
        extra_sql=SHIPPED_EXTRA_SQL, xml_any_depth=True,
        window_sql=SHIPPED_WINDOW_SQL, window_length=HOURS_18, window_slide=HOURS_6)
    return flow.window_sql_each(raw)


def _line_files(spark, lines, root, *order) -> DataFrame:
    """``lines`` written as files (as many as their size asks for) by ``order`` and read as
    a stream in several micro-batches."""
    lines.repartitionByRange(*order).write.parquet(f"{root}/src")
    return _line_stream(spark, lines, root)


def _line_stream(spark, lines, root) -> DataFrame:
    files = len(spark.read.schema(lines.schema).parquet(f"{root}/src").inputFiles())
    return (spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", str(-(-files // 4)))
            .parquet(f"{root}/src"))


def _run_stream(stream, root, flush=True, text=WINDOW_INPUT_SQL):
    from ..streaming import FlowStream
    runner = FlowStream(event_flow(window_sql=text), stream, sql_output_path=f"{root}/windows",
                        checkpoint=f"{root}/checkpoint")
    query = runner.start(available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if flush:
        runner.flush()


def _stream_root(spark):
    from ..session import scratch_dir
    return scratch_dir(spark, "stream-query")


def q_stream_flow_windows(spark, sf_dir):
    """The streaming runner on the whole ``events`` table: lines are written once
    as files, read back as a stream in several micro-batches (parse, stage per
    batch id); windows run as arrival times close them, the last ones at the end."""
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    _run_stream(_line_files(spark, lines, root, F.col(ARRIVAL)), root)
    return read_window_results(spark, f"{root}/windows")


def q_stream_late_rows(spark, sf_dir):
    """The runner on lines dealt to the micro-batches by a hash: every batch brings rows of
    windows that ran before, which are completed."""
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    _run_stream(_line_files(spark, lines, root, F.xxhash64("value")), root)
    return read_window_results(spark, f"{root}/windows")


WINDOW_HAVING_SQL = "SELECT COUNT(*) AS n, SUM(user_id) AS sum_user FROM input HAVING COUNT(*) % 2 = 0"


def q_stream_late_having(spark, sf_dir):
    """Late rows that take results away: every batch brings rows of windows that ran before,
    and a window has a result only while it holds an even number of rows."""
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    _run_stream(_line_files(spark, lines, root, F.xxhash64("value")), root, text=WINDOW_HAVING_SQL)
    return read_window_results(spark, f"{root}/windows")


def q_stream_restart(spark, sf_dir):
    """The runner on half of the lines, flushed and gone; a second one takes up its
    checkpoint and staged rows when the other half has arrived, out of order."""
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    _run_stream(_line_files(spark, lines.where(half == 0), root, F.col(ARRIVAL)), root)
    lines.where(half == 1).repartitionByRange(F.col(ARRIVAL)).write.mode("append").parquet(f"{root}/src")
    _run_stream(_line_stream(spark, lines, root), root)
    return read_window_results(spark, f"{root}/windows")


def q_sink_rows(spark, sf_dir):
    """The text sink of a stream read back: derived rows of every batch as ``[a, b]`` lines;
    per-batch SQL keeps none in the batches without an error event."""
    from ..streaming import FlowStream
    root = _stream_root(spark)
    flow = event_flow(extra_sql="SELECT size, kind, n FROM extraInput WHERE kind = 'error'")
    query = FlowStream(flow, _line_files(spark, event_lines(spark, sf_dir), root, F.col(ARRIVAL)),
                       output_path=f"{root}/rows", checkpoint=f"{root}/checkpoint").start(available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema("value string").text(f"{root}/rows").select("value")


def q_stream_counts(spark, sf_dir):
    """The counters of a stream's batches, summed: lines in, lines rejected (the user id of every
    error event is "x") and rows out of a per-batch SQL that keeps views."""
    from ..streaming import FlowStream
    root, ev = _stream_root(spark), table(spark, sf_dir, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_type") == "error", "x").otherwise(F.col("user_id").cast("string")))
    lines = table_lines(ev, list(EVENT_FIELDS), time_col="ts")
    flow = event_flow(extra_sql="SELECT size, kind FROM extraInput WHERE kind = 'view'", on_error="quarantine")
    runner = FlowStream(flow, _line_files(spark, lines, root, F.col(ARRIVAL)), output_path=f"{root}/rows",
                        bad_path=f"{root}/bad", checkpoint=f"{root}/checkpoint")
    query = runner.start(available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    counts = spark.createDataFrame(list(runner.counts), "batch_id long, rows_in long, rows_bad long, rows_out long")
    stored = spark.read.text(f"{root}/rows").count(), spark.read.schema("_raw string").parquet(f"{root}/bad").count()
    return counts.agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_bad").alias("rows_bad"), F.sum("rows_out").alias("rows_out")
                      ).withColumns({"lines_written": F.lit(stored[0]).cast("long"), "lines_rejected": F.lit(stored[1]).cast("long")})


def q_stream_trigger(spark, sf_dir):
    """The runner on its processing-time trigger: micro-batches a second apart until the files
    are read, then the wall clock closes the windows that no line closes."""
    from ..streaming import FlowStream
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    runner = FlowStream(event_flow(window_sql=WINDOW_INPUT_SQL), _line_files(spark, lines, root, F.col(ARRIVAL)),
                        sql_output_path=f"{root}/windows", checkpoint=f"{root}/checkpoint", trigger_seconds=1)
    query = runner.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    runner.query = None
    runner.tick()
    return runner.results()


def q_sink_guard(spark, sf_dir):
    """The empty guard: a partition is written for each kind that has rows, none for the kinds
    that have none; what was written is read back and counted."""
    from ..sinks import write_if_rows, write_partition
    root = _stream_root(spark)
    rows = event_flow().parse(event_lines(spark, sf_dir)).select("event_id", "event_type")
    for kind in ("click", "error", "nothing", "purchase", "signup", "view", "void"):
        write_if_rows(rows.where(F.col("event_type") == kind), write_partition, f"{root}/kinds", "kind", kind)
    return spark.read.parquet(f"{root}/kinds").groupBy("kind").agg(F.count(F.lit(1)).alias("cnt"))


def q_stream_native_window_stats(spark, sf_dir):
    """Native streaming statistics on the whole ``events`` table: lines as a file
    stream, ``groupBy(window)`` in the state store, update mode written per window
    end. Without a watermark no line is late whatever order the files are read in."""
    from ..streaming import stream_window_stats, write_window_updates
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    stats = stream_window_stats(event_flow(), _line_files(spark, lines, root, F.col(ARRIVAL)), "value", watermark=None)
    query = write_window_updates(stats, f"{root}/windows", f"{root}/native", available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    res = spark.read.parquet(f"{root}/windows").drop("_wend")
    return res.withColumn("sum_value", F.round("sum_value", 2))


def _run_to_end(frame, path, checkpoint):
    query = (frame.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def q_stream_distinct(spark, sf_dir):
    """SELECT DISTINCT event_type, day, hour over a stream of all lines. Files come to the
    micro-batches in any order, so the watermark is as long as the table's span."""
    from ..streaming import stream_distinct
    root, lines = _stream_root(spark), event_lines(spark, sf_dir)
    typed = event_flow().parse(_line_files(spark, lines, root, F.col(ARRIVAL)))
    keyed = typed.withColumn("day", F.dayofyear(ARRIVAL)).withColumn("hour", F.hour(ARRIVAL))
    _run_to_end(stream_distinct(keyed, ["event_type", "day", "hour"], ARRIVAL, "40 days"), f"{root}/rows", f"{root}/ck")
    return spark.read.schema("event_type string, day int, hour int").parquet(f"{root}/rows")


def q_stream_join(spark, sf_dir):
    """The join of ``input`` and ``output`` in each window on streams, stopped half way and taken
    up again from its checkpoint; the pairs it wrote are counted per window at the end."""
    from ..streaming import stream_join_in_windows
    root, lines, flow = _stream_root(spark), keyed_lines(spark, sf_dir), keyed_flow()

    def run():
        typed, again = (flow.parse(_line_stream(spark, lines, root)) for _ in range(2))
        pairs = stream_join_in_windows(typed, flow.derive(again), {"uid": "k"}, *flow.window_args(), lateness="40 days")
        _run_to_end(pairs.select("window_start", "window_end", "value", "size"), f"{root}/pairs", f"{root}/ck")

    half = F.dayofyear(ARRIVAL) < 16
    lines.where(half).repartitionByRange(F.col(ARRIVAL)).write.parquet(f"{root}/src")
    run()
    lines.where(~half).repartitionByRange(F.col(ARRIVAL)).write.mode("append").parquet(f"{root}/src")
    run()
    pairs = spark.read.parquet(f"{root}/pairs")
    return pairs.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("pairs"), F.countDistinct("size").alias("sizes"), F.round(F.sum("value"), 2).alias("sum_value"))


def q_tagged_union(spark, sf_dir):
    views = keyed_flow().views(keyed_lines(spark, sf_dir), materialize=True)
    both = tagged_union(views["input"], views["output"])
    return window_agg(both, ARRIVAL, HOURS_18, HOURS_6, by=["tag"],
                      aggs=[F.count(F.lit(1)).alias("cnt")])


# -- delegated SQL conformance ----------------------------------------------------------

def q_sql_distinct(spark, sf_dir):
    return run_sql({"input": lineitem_input(spark, sf_dir)},
                   "SELECT DISTINCT l_returnflag, l_linestatus FROM input")


def q_sql_semi_join(spark, sf_dir):
    views = keyed_flow().views(keyed_lines(spark, sf_dir), materialize=True)
    return run_sql(views, "SELECT uid, event_type FROM input "
                          "WHERE uid IN (SELECT k FROM output WHERE size LIKE '1%')")


def q_sql_outer_joins(spark, sf_dir):
    views = keyed_flow().views(keyed_lines(spark, sf_dir), materialize=True)
    return run_sql(views, (
        "SELECT 'left' AS kind, COUNT(*) AS n, COUNT(o.k) AS matched FROM input i "
        "LEFT JOIN (SELECT k FROM output WHERE size LIKE '1%') o ON i.uid = o.k "
        "UNION ALL SELECT 'right', COUNT(*), COUNT(i.uid) FROM "
        "(SELECT uid FROM input WHERE event_type = 'view') i "
        "RIGHT JOIN (SELECT k FROM output WHERE size LIKE '2%') o ON i.uid = o.k "
        "UNION ALL SELECT 'full', COUNT(*), COUNT(i.uid) + COUNT(o.k) FROM "
        "(SELECT uid FROM input WHERE event_type = 'click') i "
        "FULL JOIN (SELECT k FROM output WHERE size LIKE '3%') o ON i.uid = o.k"))


def q_sql_set_ops(spark, sf_dir):
    views = keyed_flow().views(keyed_lines(spark, sf_dir), materialize=True)
    return run_sql(views, (
        "SELECT 'union' AS op, x FROM (SELECT event_type AS x FROM input "
        "UNION SELECT upper(event_type) FROM input) "
        "UNION ALL SELECT 'intersect', x FROM (SELECT CAST(user_id AS STRING) AS x FROM input "
        "INTERSECT SELECT n FROM output) "
        "UNION ALL SELECT 'except', x FROM (SELECT CAST(user_id AS STRING) AS x FROM input "
        "EXCEPT SELECT n FROM output)"))


def q_sql_topk(spark, sf_dir):
    return run_sql({"input": lineitem_input(spark, sf_dir)}, (
        "SELECT l_orderkey, l_linenumber, l_extendedprice FROM input "
        "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10"))


def q_sql_scalars(spark, sf_dir):
    return run_sql({"input": _event_input(spark, sf_dir)}, (
        "SELECT event_id, UPPER(event_type) AS u, LOWER(UPPER(event_type)) AS l, "
        "SUBSTR(event_type, 2, 3) AS s, ABS(value - 100) AS a, ROUND(SQRT(value), 6) AS r, "
        "COALESCE(NULLIF(event_type, 'click'), 'C') AS c, IF(value > 100, 'hi', 'lo') AS f "
        "FROM input"))


QUERIES = {
    "parse_separator": q_parse_separator,
    "parse_json": q_parse_json,
    "parse_xml": q_parse_xml,
    "parse_separator_regex": q_parse_separator_regex,
    "parse_xml_nested": q_parse_xml_nested,
    "parse_xml_bad_rows": q_parse_xml_bad_rows,
    "parse_null_mode": q_parse_null_mode,
    "coerce_types": q_coerce_types,
    "coerce_bad_rows": q_coerce_bad_rows,
    "rules_project": q_rules_project,
    "rules_field_and_literal": q_rules_field_and_literal,
    "rules_overloads": q_rules_overloads,
    "rules_typed_output": q_rules_typed_output,
    "rules_jvm_class": q_rules_jvm_class,
    "fn_upper": q_fn_upper,
    "fn_add_one": q_fn_add_one,
    "fn_identity": q_fn_identity,
    "text_rows": q_text_rows,
    "extra_sql_project": q_extra_sql_project,
    "extra_sql_filter": q_extra_sql_filter,
    "extra_sql_agg": q_extra_sql_agg,
    "stringify_result": q_stringify_result,
    "window_stats": q_window_stats,
    "window_stats_dense": q_window_stats_dense,
    "window_distinct": q_window_distinct,
    "window_distinct_sketch": q_window_distinct_sketch,
    "window_tumbling": q_window_tumbling,
    "window_sql_input": q_window_sql_input,
    "window_sql_topn": q_window_sql_topn,
    "extra_sql_batches": q_extra_sql_batches,
    "window_sql_grouped": q_window_sql_grouped,
    "window_sql_output": q_window_sql_output,
    "window_sql_join": q_window_sql_join,
    "shipped_settings_flow": q_shipped_settings_flow,
    "stream_flow_windows": q_stream_flow_windows,
    "stream_late_rows": q_stream_late_rows,
    "stream_late_having": q_stream_late_having,
    "stream_restart": q_stream_restart,
    "sink_rows": q_sink_rows,
    "stream_native_window_stats": q_stream_native_window_stats,
    "sink_guard": q_sink_guard,
    "stream_counts": q_stream_counts,
    "stream_trigger": q_stream_trigger,
    "stream_distinct": q_stream_distinct,
    "stream_join": q_stream_join,
    "tagged_union": q_tagged_union,
    "sql_distinct": q_sql_distinct,
    "sql_semi_join": q_sql_semi_join,
    "sql_band_semi_join": q_sql_band_semi_join,
    "sql_outer_joins": q_sql_outer_joins,
    "sql_set_ops": q_sql_set_ops,
    "sql_topk": q_sql_topk,
    "sql_scalars": q_sql_scalars,
}
