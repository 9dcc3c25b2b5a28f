"""DuckDB SQL computing each registered query's result straight from the tables.

Sliding windows (18 h sliding by 6 h) are expanded with ``UNNEST`` of the
three window starts that hold a row; tumbling windows use ``time_bucket``.
"""

from __future__ import annotations


def _starts(ts: str = "ts") -> str:
    b = f"time_bucket(INTERVAL 6 HOUR, {ts})"
    return f"UNNEST([{b}, {b} - INTERVAL 6 HOUR, {b} - INTERVAL 12 HOUR])"


def _win(cols: str, source: str = "events") -> str:
    """Rows of ``source`` once per 18 h window, with the window start as ``ws``."""
    return f"(SELECT {cols}, {_starts()} AS ws FROM {source})"


_WIN_COLS = "ws AS window_start, ws + INTERVAL 18 HOUR AS window_end"

# Derived event rows: size = add($user_id,"MB"), kind = event_type, n = addOne($user_id).
_EXTRA = ("(SELECT CAST(user_id AS VARCHAR) || ' MB' AS size, event_type AS kind, "
          "CAST(user_id + 1 AS INTEGER) AS n FROM events) extraInput")

_LINE_STATUS = "COALESCE(NULLIF(o_orderstatus, 'F'), 'null')"


def _joined(sep: str) -> str:
    return (f"CAST(o_orderkey AS VARCHAR) || {sep} || CAST(o_custkey AS VARCHAR) || {sep} || "
            f"{_LINE_STATUS} || {sep} || o_orderpriority")


ORACLE_SQL = {
    "parse_separator": (
        "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
        "l_discount, l_tax, l_returnflag, l_linestatus, "
        "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem"),
    "parse_json": "SELECT event_id, user_id, event_type, value, props FROM events",
    "parse_xml": "SELECT event_id, user_id, event_type, value, props FROM events",
    "parse_separator_regex": (
        "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem"),
    "parse_xml_nested": "SELECT event_id, user_id, event_type, value FROM events",
    "parse_xml_bad_rows": (
        "SELECT event_id AS id, event_type AS kind, CASE WHEN ok THEN event_id END AS event_id, "
        "CASE WHEN ok THEN CAST(user_id AS BIGINT) END AS user_id, CASE WHEN ok THEN value END AS value, "
        "CASE WHEN NOT ok THEN 'malformed xml' END AS reason "
        "FROM (SELECT *, event_type NOT IN ('click', 'error', 'purchase') AS ok FROM events)"),
    "parse_null_mode": (
        "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL "
        "ELSE CAST(user_id AS INTEGER) END AS user_id, event_type FROM events"),
    "coerce_types": (
        "SELECT event_id AS id, CAST((event_id % 200) - 100 AS TINYINT) AS b, "
        "CAST(user_id AS SMALLINT) AS s, CAST(event_id AS INTEGER) AS i, "
        "event_id * 1000003 AS l, CAST(value AS FLOAT) AS f, value AS d, "
        "event_type IN ('click', 'view') AS t, substr(event_type, 1, 1) AS c, "
        "event_type AS str FROM events"),
    "coerce_bad_rows": (
        "SELECT CAST(event_id AS VARCHAR) || chr(9) || 'x' || chr(9) || event_type AS line, "
        "'bad Integer value for user_id' AS reason FROM events WHERE event_type = 'error'"),
    "rules_project": (
        "SELECT CAST(user_id AS VARCHAR) || ' KB' AS contentSizeWithUnit, "
        "CAST(user_id AS VARCHAR) || ' MB' AS size FROM events"),
    "rules_field_and_literal": (
        "SELECT event_type AS k, event_type || ' x' AS s1, CAST(user_id + 3 AS INTEGER) AS n1, "
        "'5 KB' AS s2, 'ABC' AS u1, CAST(42 AS INTEGER) AS n2, "
        "CAST(user_id - 7 AS INTEGER) AS n3 FROM events"),
    "rules_overloads": (
        "SELECT CAST(user_id * 2 AS INTEGER) AS a, event_type || ' ' || event_type AS b, "
        "CAST(user_id AS VARCHAR) || ' ' || event_type AS c FROM events"),
    "rules_typed_output": (
        "SELECT CAST(user_id + 1 AS BIGINT) AS as_long, CAST(user_id + 1 AS DOUBLE) AS as_double, "
        "CAST(user_id + 1 AS VARCHAR) AS as_text, event_type = 'click' AS as_bool FROM events"),
    "fn_upper": "SELECT upper(event_type) AS u FROM events",
    "fn_add_one": "SELECT CAST(l_linenumber + 1 AS INTEGER) AS n FROM lineitem",
    "fn_identity": "SELECT event_type AS e FROM events",
    "text_rows": (
        f"SELECT {_joined('chr(9)')} AS tab_line, '[' || {_joined(chr(39) + ', ' + chr(39))} "
        f"|| ']' AS list_line, '[' || {_joined(chr(39) + ',' + chr(39))} || ']' AS row_line "
        "FROM orders"),
    "extra_sql_project": (
        "SELECT size, upper(kind) AS kind_u, CAST(n AS BIGINT) * 2 AS n2, "
        f"CASE WHEN n > 100 THEN 'big' ELSE 'small' END AS bucket FROM {_EXTRA}"),
    "extra_sql_filter": (
        f"SELECT size, kind, n FROM {_EXTRA} WHERE (kind IN ('click', 'view') "
        "AND n BETWEEN 10 AND 500 AND size LIKE '%1 MB') OR "
        "(regexp_matches(kind, '^pur') AND NOT n IS NULL AND n < 20)"),
    "extra_sql_agg": (
        "SELECT kind, COUNT(*) AS cnt, COUNT(DISTINCT size) AS n_sizes, "
        "CAST(SUM(n) AS BIGINT) AS sum_n, ROUND(AVG(n), 6) AS avg_n, MIN(size) AS min_size, "
        f"MAX(size) AS max_size FROM {_EXTRA} GROUP BY kind HAVING COUNT(*) > 10"),
    "stringify_result": (
        f"SELECT CAST(n AS VARCHAR) AS n, kind, CAST(n > 50 AS VARCHAR) AS big FROM {_EXTRA}"),
    "window_stats": (
        f"SELECT {_WIN_COLS}, ROUND(SUM(value), 2) AS sum_value, COUNT(*) AS n, "
        f"MIN(value) AS min_value, MAX(value) AS max_value FROM {_win('value')} GROUP BY ws"),
    "stream_native_window_stats": (
        f"SELECT {_WIN_COLS}, ROUND(SUM(value), 2) AS sum_value, COUNT(*) AS n, "
        f"MIN(value) AS min_value, MAX(value) AS max_value FROM {_win('value')} GROUP BY ws"),
    "window_stats_dense": (
        "SELECT ws AS window_start, ws + INTERVAL 250 HOUR AS window_end, ROUND(SUM(value), 2) AS sum_value, "
        "COUNT(*) AS n, MIN(value) AS min_value, MAX(value) AS max_value FROM (SELECT value, "
        "UNNEST(generate_series(time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * 999, "
        "time_bucket(INTERVAL 15 MINUTE, ts), INTERVAL 15 MINUTE)) AS ws FROM events) GROUP BY ws"),
    "window_distinct": (
        f"SELECT {_WIN_COLS}, event_type, COUNT(DISTINCT user_id) AS n_distinct "
        f"FROM {_win('user_id, event_type')} GROUP BY ws, event_type"),
    "window_distinct_sketch": (
        f"SELECT {_WIN_COLS}, COUNT(DISTINCT user_id) AS n_distinct, true AS within "
        f"FROM {_win('user_id')} GROUP BY ws"),
    "stream_distinct": (
        "SELECT DISTINCT event_type, CAST(dayofyear(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events"),
    "sql_band_semi_join": (
        "SELECT event_id, CAST(user_id AS INTEGER) AS user_id, event_type FROM events i WHERE EXISTS (SELECT 1 FROM events e "
        "WHERE e.user_id = i.user_id AND e.event_type = 'error' AND e.ts >= i.ts - INTERVAL 24 HOUR "
        "AND e.ts <= i.ts - INTERVAL 1 SECOND)"),
    "rules_jvm_class": (
        "SELECT lower(to_hex(user_id)) AS hex, CAST(user_id % 7 AS INTEGER) AS slot, false AS known, "
        "event_id AS kind FROM events"),
    "stream_counts": (
        "SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (event_type = 'error') AS rows_bad, "
        "COUNT(*) FILTER (event_type = 'view') AS rows_out, COUNT(*) FILTER (event_type = 'view') AS lines_written, "
        "COUNT(*) FILTER (event_type = 'error') AS lines_rejected FROM events"),
    "sink_guard": "SELECT event_type AS kind, COUNT(*) AS cnt FROM events GROUP BY event_type",
    "sink_rows": (
        "SELECT '[' || CAST(user_id AS VARCHAR) || ' MB, error, ' || CAST(user_id + 1 AS VARCHAR) || ']' AS value "
        "FROM events WHERE event_type = 'error'"),
    "window_tumbling": (
        "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS window_start, "
        "time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, event_type, "
        "COUNT(*) AS cnt, ROUND(SUM(value), 2) AS sum_value FROM events GROUP BY 1, 2, 3"),
    "window_sql_input": (
        f"SELECT {_WIN_COLS}, CAST(SUM(user_id) AS BIGINT) AS sum_user, COUNT(*) AS cnt, "
        "CAST(MIN(user_id) AS INTEGER) AS min_user, CAST(MAX(user_id) AS INTEGER) AS max_user "
        f"FROM {_win('user_id')} GROUP BY ws"),
    "window_sql_topn": (
        f"SELECT {_WIN_COLS}, event_id, value FROM {_win('event_id, value')} QUALIFY "
        "row_number() OVER (PARTITION BY ws ORDER BY value DESC, event_id) <= 3"),
    "extra_sql_batches": (
        "SELECT event_type AS kind, COUNT(*) AS cnt, CAST(SUM(user_id + 1) AS BIGINT) AS sum_n, "
        "time_bucket(INTERVAL 6 HOUR, ts) AS batch_start FROM events GROUP BY 1, 4"),
    "window_sql_grouped": (
        f"SELECT {_WIN_COLS}, event_type, COUNT(*) AS cnt, ROUND(SUM(value), 2) AS sum_value "
        f"FROM {_win('event_type, value')} GROUP BY ws, event_type"),
    "window_sql_output": (
        f"SELECT {_WIN_COLS}, SUM(TRY_CAST(size AS DOUBLE)) AS sum_size, "
        "SUM(TRY_CAST(n AS DOUBLE)) AS sum_n, COUNT(*) AS cnt, MIN(size) AS min_size, "
        "MAX(size) AS max_size FROM "
        + _win("CAST(user_id AS VARCHAR) || ' MB' AS size, CAST(user_id + 1 AS VARCHAR) AS n")
        + " GROUP BY ws"),
    "window_sql_join": (
        f"SELECT {_WIN_COLS}, COUNT(*) AS pairs, "
        "COUNT(DISTINCT CAST(user_id AS VARCHAR) || ' MB') AS sizes, "
        f"ROUND(SUM(value), 2) AS sum_value FROM {_win('user_id, value')} GROUP BY ws"),
    "stream_flow_windows": (
        f"SELECT {_WIN_COLS}, CAST(SUM(user_id) AS BIGINT) AS sum_user, COUNT(*) AS cnt, "
        "CAST(MIN(user_id) AS INTEGER) AS min_user, CAST(MAX(user_id) AS INTEGER) AS max_user "
        f"FROM {_win('user_id')} GROUP BY ws"),
    "shipped_settings_flow": (
        f"SELECT {_WIN_COLS}, SUM(TRY_CAST(size AS DOUBLE)) AS \"sum(size)\", "
        "COUNT(*) AS \"count(1)\", MIN(size) AS \"min(size)\", MAX(size) AS \"max(size)\" FROM "
        + _win("CAST(user_id AS VARCHAR) || ' MB' AS size") + " GROUP BY ws"),
    "tagged_union": (
        f"SELECT {_WIN_COLS}, tag, COUNT(*) AS cnt FROM "
        + _win("tag", "(SELECT 1 AS tag, ts FROM events UNION ALL SELECT 2, ts FROM events)")
        + " GROUP BY ws, tag"),
    "sql_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "sql_semi_join": (
        "SELECT CAST(event_id AS VARCHAR) AS uid, event_type FROM events "
        "WHERE CAST(user_id AS VARCHAR) || ' MB' LIKE '1%'"),
    "sql_outer_joins": (
        "SELECT 'left' AS kind, COUNT(*) AS n, "
        "COUNT(*) FILTER (WHERE CAST(user_id AS VARCHAR) LIKE '1%') AS matched FROM events "
        "UNION ALL SELECT 'right', COUNT(*) FILTER (WHERE CAST(user_id AS VARCHAR) LIKE '2%'), "
        "COUNT(*) FILTER (WHERE CAST(user_id AS VARCHAR) LIKE '2%' AND event_type = 'view') "
        "FROM events "
        "UNION ALL SELECT 'full', "
        "COUNT(*) FILTER (WHERE event_type = 'click' OR CAST(user_id AS VARCHAR) LIKE '3%'), "
        "COUNT(*) FILTER (WHERE event_type = 'click') "
        "+ COUNT(*) FILTER (WHERE CAST(user_id AS VARCHAR) LIKE '3%') FROM events"),
    "sql_set_ops": (
        "SELECT 'union' AS op, x FROM (SELECT event_type AS x FROM events "
        "UNION SELECT upper(event_type) FROM events) "
        "UNION ALL SELECT 'intersect', x FROM (SELECT CAST(user_id AS VARCHAR) AS x FROM events "
        "INTERSECT SELECT CAST(user_id + 1 AS VARCHAR) FROM events) "
        "UNION ALL SELECT 'except', x FROM (SELECT CAST(user_id AS VARCHAR) AS x FROM events "
        "EXCEPT SELECT CAST(user_id + 1 AS VARCHAR) FROM events)"),
    "sql_topk": (
        "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem "
        "ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10"),
    "sql_scalars": (
        "SELECT event_id, upper(event_type) AS u, lower(upper(event_type)) AS l, "
        "substr(event_type, 2, 3) AS s, abs(value - 100) AS a, round(sqrt(value), 6) AS r, "
        "COALESCE(NULLIF(event_type, 'click'), 'C') AS c, "
        "CASE WHEN value > 100 THEN 'hi' ELSE 'lo' END AS f FROM events"),
}

ORACLE_SQL["stream_late_having"] = (
    f"SELECT {_WIN_COLS}, COUNT(*) AS n, CAST(SUM(user_id) AS BIGINT) AS sum_user "
    f"FROM {_win('user_id')} GROUP BY ws HAVING COUNT(*) % 2 = 0")
ORACLE_SQL["stream_join"] = ORACLE_SQL["window_sql_join"]
# late rows, restarts and triggers must not change any window
ORACLE_SQL["stream_late_rows"] = ORACLE_SQL["stream_trigger"] = ORACLE_SQL["stream_restart"] = ORACLE_SQL["stream_flow_windows"]
