"""Physical-plan properties that matter at scale."""

import datetime as dt
import re

from pyspark.sql import functions as F

from access_log import SF_SMALL
from rillet.plans import queries as Q


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_aggregation_is_partial_before_the_shuffle(spark):
    p = plan_of(Q.q_window_stats(spark, SF_SMALL))
    assert "partial_sum" in p and "Expand" in p
    assert p.index("partial_sum") > p.index("Exchange")   # partial aggregate below the exchange


def test_parse_runs_once_under_pushed_filters(spark):
    views = Q.keyed_flow().views(Q.keyed_lines(spark, SF_SMALL))
    df = Q.run_sql(views, "SELECT uid, event_type FROM input "
                          "WHERE uid IN (SELECT k FROM output WHERE size LIKE '1%')")
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # each scan's parse appears once (in a Project feeding a Generate), not inlined in filters
    assert p.count("split(") == 2 and "Generate" in p


def test_filters_on_passthrough_columns_reach_the_scan(spark):
    lines = Q.event_lines(spark, SF_SMALL)
    typed = Q.event_flow().parse(lines).where(F.col("arrival_ts") >= F.lit(dt.datetime(2024, 1, 15)))
    p = typed._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p


def test_no_static_broadcast_and_no_python(spark):
    p = plan_of(Q.q_window_sql_join(spark, SF_SMALL))
    assert "Python" not in p and "CartesianProduct" not in p and "NestedLoop" not in p


def test_a_line_source_reads_the_line_columns_and_a_projection_one(spark):
    p = Q.q_window_tumbling(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double,props:string>" in p
    lite = Q.table(spark, SF_SMALL, "orders").select("o_orderkey")
    assert "ReadSchema: struct<o_orderkey:bigint>" in lite._jdf.queryExecution().executedPlan().toString()


def test_queries_of_both_views_parse_once(spark):
    for q in (Q.q_sql_semi_join, Q.q_tagged_union, Q.q_window_sql_join, Q.q_sql_set_ops, Q.q_sql_outer_joins):
        p = q(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "split(" not in p and "events.parquet" not in p  # the typed table is read, not the lines


def test_plain_window_aggregates_are_one_job_over_all_windows(spark):
    for q in (Q.q_window_sql_input, Q.q_shipped_settings_flow):
        p = plan_of(q(spark, SF_SMALL))
        assert "Expand" in p and "partial_" in p and "NestedLoop" not in p and "Cartesian" not in p
        # the rows are read once; the list of windows needs the time column alone
        scans = re.findall(r"ReadSchema: struct<([^>]*)>", p)
        assert sorted(s == "ts:timestamp_ntz" for s in scans)[:2] == [False, True]
        assert p.index("partial_") > p.index("Exchange")


def test_a_limit_per_window_is_a_ranking_with_a_bound_before_the_shuffle(spark):
    df = Q.q_window_sql_topn(spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "Cartesian" not in p and "row_number()" in p
    # a window's rows are cut to three in each task before they meet
    assert p.index("WindowGroupLimit") < p.rindex("Exchange") < p.rindex("WindowGroupLimit")
