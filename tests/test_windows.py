import datetime as dt

import pytest
from pyspark.sql import functions as F

from access_log import ACCESS_FIELDS, ACCESS_LINES
from rillet.operators.parse import parse_lines
from rillet.sinks.window_results import read_window_results
from rillet.operators.windows import (SlideStage, duration_us, explode_windows,
                                      staged_windowed_sql, window_agg, window_stats)

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_durations():
    assert duration_us(18000) == 18_000_000
    assert duration_us("18 hours") == 18 * 3600 * 10**6
    assert duration_us(dt.timedelta(seconds=6)) == 6_000_000
    with pytest.raises(ValueError):
        duration_us("soon")


def test_sample_rows_in_every_window_that_holds_them(lines):
    typed = parse_lines(lines([(v, at(1)) for v in ACCESS_LINES], with_time=True), ACCESS_FIELDS)
    stats = window_stats(typed, "contentSize", "arrival_ts", 18000, 6000)
    got = sorted((r.window_start, tuple(r)[2:]) for r in stats.collect())
    assert [w for w, _ in got] == [at(-12), at(-6), at(0)]
    assert {v for _, v in got} == {(7000, 7, 1000, 1000)}


def test_boundaries_partial_windows_and_tumbling(spark):
    df = spark.createDataFrame([(at(0), 1), (at(6), 1), (at(30), 1)], "arrival_ts timestamp, v int")
    sliding = {r.window_start: r.n for r in
               window_stats(df, "v", "arrival_ts", 18000, 6000).collect()}
    assert sliding == {at(-12): 1, at(-6): 2, at(0): 2, at(6): 1, at(18): 1, at(24): 1,
                       at(30): 1}
    tumbling = {r.window_start: r.n for r in window_stats(df, "v", "arrival_ts", 6000).collect()}
    assert tumbling == {at(0): 1, at(6): 1, at(30): 1}


def test_explode_matches_groupby(spark):
    df = spark.createDataFrame([(at(s), s) for s in range(0, 60, 5)], "arrival_ts timestamp, v int")
    a = window_agg(df, "arrival_ts", 10000, 4000, aggs=[F.sum("v").alias("s")])
    b = (explode_windows(df, "arrival_ts", 10000, 4000)
         .groupBy("window_start", "window_end").agg(F.sum("v").alias("s")))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("stage", [True, False])
@pytest.mark.parametrize("length,slide", [(18000, 6000), (10000, 4000), (6000, 6000)])
def test_staged_equals_exploded(spark, length, slide, stage):
    rows = [(at(s), s % 7) for s in list(range(0, 40, 3)) + list(range(100, 120, 5))]
    df = spark.createDataFrame(rows, "arrival_ts timestamp, v int")
    text = "SELECT SUM(v) AS s, COUNT(*) AS n, MAX(v) AS hi FROM input"
    staged = staged_windowed_sql({"input": df}, text, "arrival_ts", length, slide, chunk=3,
                                 stage=stage)
    expected = window_agg(df, "arrival_ts", length, slide,
                          aggs=[F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"),
                                F.max("v").alias("hi")])
    key = ["window_start", "window_end", "s", "n", "hi"]
    assert sorted(tuple(r[k] for k in key) for r in staged.collect()) == \
        sorted(tuple(r[k] for k in key) for r in expected.collect())


def test_staged_text_can_order_and_limit_per_window(spark):
    df = spark.createDataFrame([(at(s), s) for s in range(0, 30)], "arrival_ts timestamp, v int")
    res = staged_windowed_sql({"input": df}, "SELECT v FROM input ORDER BY v DESC LIMIT 2",
                              "arrival_ts", 18000, 6000)
    top = {}
    for r in res.collect():
        top.setdefault(r.window_start, []).append(r.v)
    assert sorted(top[at(0)]) == [16, 17]
    assert sorted(top[at(24)]) == [28, 29]


def test_stage_prunes_partitions_and_reruns_idempotently(spark, tmp_path):
    df = spark.createDataFrame([(at(s), s) for s in range(0, 60, 2)], "arrival_ts timestamp, v int")
    stage = SlideStage(spark, "arrival_ts", 18000, 6000, root=str(tmp_path / "stage"))
    stage.append("input", df)
    w = stage.windows()[3]
    plan = stage.window_views(w)["input"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_bucket" in plan
    out = str(tmp_path / "res")
    text = "SELECT COUNT(*) AS n FROM input"
    first = sorted(map(tuple, stage.run(text, out=out).collect()))
    rerun = stage.run(text, stage.windows()[:4], out=out)
    assert rerun.count() == 4
    again = sorted(map(tuple, read_window_results(spark, out).collect()))
    assert first == again


@pytest.mark.parametrize("stage", [True, False])
def test_timestamp_ntz_windows(spark, stage):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:01' AS ts, 5 AS v")
    res = staged_windowed_sql({"input": df}, "SELECT SUM(v) AS s FROM input", "ts", 18000, 6000,
                              stage=stage)
    starts = sorted(r.window_start for r in res.collect())
    assert starts == [at(-12), at(-6), at(0)]
    assert dict(res.dtypes)["window_start"] == "timestamp_ntz"


def test_direct_views_push_the_time_range_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([(at(s), s) for s in range(0, 60, 2)],
                          "arrival_ts timestamp, v int").write.parquet(path)
    stage = SlideStage(spark, "arrival_ts", 18000, 6000, root=str(tmp_path / "stage"))
    stage.append("input", spark.read.parquet(path), stage=False)
    w = stage.windows()[3]
    plan = stage.window_views(w)["input"]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(arrival_ts" in plan
    assert not any(p.name == "stage" for p in tmp_path.iterdir())   # nothing was written


@pytest.mark.parametrize("length,slide", [(18000, 6000), (10000, 4000), (60000, 2000), (6000, 6000)])
def test_pane_statistics_equal_expanded(spark, length, slide):
    rows = [(at(s), float(s % 11) if s % 5 else None) for s in range(-40, 200, 3)]
    df = spark.createDataFrame(rows, "arrival_ts timestamp, v double")
    a = window_stats(df, "v", "arrival_ts", length, slide, panes=True)
    b = window_stats(df, "v", "arrival_ts", length, slide, panes=False)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    ntz = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:05' AS ts, 2.0 AS v")
    assert sorted(map(tuple, window_stats(ntz, "v", "ts", length, slide, panes=True).collect())) == \
        sorted(map(tuple, window_stats(ntz, "v", "ts", length, slide, panes=False).collect()))


@pytest.mark.parametrize("stage", [True, False])
def test_start_offset_is_honoured_by_every_path(spark, stage):
    rows = [(at(s), s) for s in range(0, 50, 3)]
    df = spark.createDataFrame(rows, "arrival_ts timestamp, v int")
    text = "SELECT SUM(v) AS s, COUNT(*) AS n FROM input"
    staged = staged_windowed_sql({"input": df}, text, "arrival_ts", 12000, 4000, start=1000,
                                 stage=stage)
    expected = window_agg(df, "arrival_ts", 12000, 4000, start=1000,
                          aggs=[F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")])
    key = ["window_start", "window_end", "s", "n"]
    got = sorted(tuple(r[k] for k in key) for r in staged.collect())
    assert got == sorted(tuple(r[k] for k in key) for r in expected.collect())
    assert all(w.second % 4 == 1 for w, *_ in got)          # starts at 1 s past the slide grid
    panes = window_stats(df, "v", "arrival_ts", 12000, 4000, start=1000, panes=True)
    flat = window_stats(df, "v", "arrival_ts", 12000, 4000, start=1000, panes=False)
    assert sorted(map(tuple, panes.collect())) == sorted(map(tuple, flat.collect()))


def test_offset_puts_window_ends_on_slide_multiples(spark):
    df = spark.createDataFrame([(at(s), 1) for s in range(0, 30, 3)], "arrival_ts timestamp, v int")
    res = window_stats(df, "v", "arrival_ts", 10000, 4000, start=10000 % 4000)
    assert all(r.window_end.second % 4 == 0 for r in res.collect())


def test_rows_without_time_belong_to_no_window(spark, tmp_path):
    df = spark.createDataFrame([(at(1), 1), (None, 2), (at(7), 3)], "arrival_ts timestamp, v int")
    stage = SlideStage(spark, "arrival_ts", 18000, 6000, root=str(tmp_path / "stage"))
    stage.append("input", df)
    assert None not in stage.view_counts("input")
    res = stage.run("SELECT SUM(v) AS s FROM input")
    # windows [-12,6) [-6,12) [0,18) [6,24) s around the rows at 1 s and 7 s
    assert sorted(r.s for r in res.collect()) == [1, 3, 4, 4]
    assert stage.expire(0) == 0
