import datetime as dt
import os
import time

from access_log import ACCESS_FIELDS, ACCESS_LINES, ACCESS_OUTPUT, ACCESS_RULES
from rillet.plans import LogFlow
from rillet.sinks import write_if_rows, write_lines, write_partition
from rillet.sinks.window_results import read_window_results
from rillet.sources import table_lines, text_lines
from rillet.streaming import FlowStream, stream_window_stats

WINDOW_SQL = ("SELECT SUM(contentSize) AS total, COUNT(*) AS n, MIN(contentSize) AS lo, "
              "MAX(contentSize) AS hi FROM input")


def flow(**kw):
    return LogFlow(ACCESS_FIELDS, ACCESS_OUTPUT, ACCESS_RULES, extra_sql="SELECT size FROM extraInput",
                   window_sql=WINDOW_SQL, window_length=18000, window_slide=6000, **kw)


def test_partition_writes_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_partition(df, path, "batch_id", 0)
    write_partition(df, path, "batch_id", 0)
    write_partition(df.limit(1), path, "batch_id", 1)
    assert spark.read.parquet(path).count() == 3
    write_lines(df, str(tmp_path / "lines"), "batch_id", 7, form="row")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == [
        "[1,a]", "[2,b]"]
    assert write_if_rows(df.where("k > 5"), write_partition, str(tmp_path / "e"), "b", 0) is False
    assert not os.path.exists(tmp_path / "e")


def _write_files(folder, groups, start):
    folder.mkdir()
    for i, group in enumerate(groups):
        p = folder / f"part-{i}.txt"
        p.write_text("\n".join(group) + "\n")
        t = start + 6 * i + 1
        os.utime(p, (t, t))


def test_stream_matches_bounded_replay(spark, tmp_path):
    start = time.mktime(dt.datetime(2024, 1, 1).timetuple())
    groups = [ACCESS_LINES[:2], ACCESS_LINES[2:3], ACCESS_LINES[3:6], ACCESS_LINES[6:]]
    src = tmp_path / "src"
    _write_files(src, groups, start)
    out, sql_out = str(tmp_path / "rows"), str(tmp_path / "windows")
    runner = FlowStream(flow(), text_lines(spark, str(src), max_files_per_trigger=1), out,
                        sql_out, checkpoint=str(tmp_path / "ck"),
                        sql_text_path=str(tmp_path / "window_lines"))
    q = runner.start(available_now=True)
    q.awaitTermination(120)
    runner.flush()
    streamed = sorted(tuple(r) for r in read_window_results(spark, sql_out).collect())
    bounded = flow().window_sql_each(text_lines(spark, str(src), streaming=False))
    assert streamed == sorted(tuple(r) for r in bounded.collect())
    assert len(streamed) >= 4
    text_rows = spark.read.text(str(tmp_path / "window_lines"))
    assert text_rows.count() == len(streamed)
    assert "[6000,6,1000,1000]" in {r.value for r in text_rows.collect()}
    rows = spark.read.text(out)
    assert rows.count() == 7 and {r.value for r in rows.collect()} == {"[1000 MB]"}
    assert sorted(r.batch_id for r in rows.select("batch_id").distinct().collect()) == [0, 1, 2, 3]
    # a replayed batch id changes nothing
    runner.process_batch(text_lines(spark, str(src / "part-0.txt"), streaming=False), 0)
    assert spark.read.text(out).count() == 7
    again = sorted(tuple(r) for r in read_window_results(spark, sql_out).collect())
    assert again == streamed


def test_native_window_stats_on_a_stream(spark, tmp_path):
    start = time.mktime(dt.datetime(2024, 1, 1).timetuple())
    src = tmp_path / "src"
    _write_files(src, [ACCESS_LINES[:3], ACCESS_LINES[3:]], start)
    stats = stream_window_stats(flow(), text_lines(spark, str(src)), "contentSize")
    q = (stats.writeStream.outputMode("complete").format("memory").queryName("native_stats")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.window_start: (r.sum_contentSize, r.n) for r in spark.table("native_stats").collect()}
    # rows at +1 s (3) and +7 s (4): windows [-12,6) [-6,12) [0,18) [6,24) hold 3, 7, 7, 4
    assert sorted(got.values()) == [(3000, 3), (4000, 4), (7000, 7), (7000, 7)]


def test_table_lines_round_trip(spark):
    df = spark.createDataFrame([(1, "a<b", None)], "k long, s string, t string")
    for fmt in ("separator", "json", "xml"):
        line = table_lines(df, ["k", "s", "t"], fmt).first().value
        assert "a" in line
    assert table_lines(df, ["k", "s"], "xml").first().value == (
        '<xml><entry key="k">1</entry><entry key="s">a&lt;b</entry></xml>')
    assert table_lines(df, ["k", "s"], "json", quote_all=True).first().value == '{"k":"1","s":"a<b"}'


def test_flow_from_a_settings_file(spark, tmp_path, lines):
    from access_log import ACCESS_XML
    from rillet.plans.settings import flow_from_settings
    import json
    (tmp_path / "in.json").write_text(json.dumps(ACCESS_FIELDS, indent=1))
    (tmp_path / "out.json").write_text(json.dumps(ACCESS_OUTPUT))
    (tmp_path / "rules").write_text("\n".join(ACCESS_RULES) + "\n")
    (tmp_path / "settings.xml").write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n<property>\n'
        '<entry key="stream.input.format">xml</entry>\n'
        '<entry key="stream.input.separator">&#009;</entry>\n'
        '<entry key="stream.extraSQL.enable">true</entry>\n'
        '<entry key="stream.extraSQL.command">SELECT size FROM extraInput</entry>\n'
        '<entry key="stream.sql.command">SELECT SUM(size), COUNT(*), MIN(size), MAX(size) FROM output\n    </entry>\n'
        '<entry key="stream.input.formatFilePath">in.json</entry>\n'
        '<entry key="stream.output.formatFilePath">out.json</entry>\n'
        '<entry key="rule.filePath">rules</entry>\n'
        '<entry key="stream.batchInterval">2</entry>\n'
        '<entry key="stream.window.length">18000</entry>\n'
        '<entry key="stream.window.slide">6000</entry>\n</property>\n')
    st = flow_from_settings(str(tmp_path / "settings.xml"))
    assert st.flow.fmt == "xml" and st.flow.separator == "\t" and st.batch_seconds == 2.0
    raw = lines([(ACCESS_XML, dt.datetime(2024, 1, 1, 0, 0, 1))], with_time=True)
    views = st.flow.views(raw)
    assert [tuple(r) for r in views["output"].drop("arrival_ts").collect()] == [("1000 MB",)]
    res = st.flow.window_sql_each(raw)
    assert {tuple(r)[2:] for r in res.collect()} == {(None, 1, "1000 MB", "1000 MB")}


def test_extra_sql_schema_check(lines):
    import pytest
    from rillet.types import SchemaError
    raw = lines([(ACCESS_LINES[0], dt.datetime(2024, 1, 1))], with_time=True)
    ok = flow(extra_sql_schema={"size": "String"})
    assert ok.views(raw)["output"].columns == ["size", "arrival_ts"]
    bad = flow(extra_sql_schema={"other": "String"})
    with pytest.raises(SchemaError):
        bad.views(raw)


def test_empty_batches_and_late_rows(spark, tmp_path):
    f = flow()
    empty = spark.createDataFrame([], "value string, arrival_ts timestamp")
    out, sql_out = str(tmp_path / "rows"), str(tmp_path / "windows")
    runner = FlowStream(f, empty, out, sql_out, checkpoint=str(tmp_path / "ck"), lateness=6000)
    runner.process_batch(empty, 0)
    assert not os.path.exists(out)
    mk = lambda secs: spark.createDataFrame(
        [(ACCESS_LINES[0], dt.datetime(2024, 1, 1) + dt.timedelta(seconds=secs))],
        "value string, arrival_ts timestamp")
    runner.process_batch(mk(1), 1)
    runner.process_batch(mk(13), 2)     # latest 13 s - 6 s lateness: windows ending <= 7 s closed
    ends = sorted(r.window_end for r in read_window_results(spark, sql_out).collect())
    assert ends == [dt.datetime(2024, 1, 1, 0, 0, 6)]
    runner.process_batch(mk(5), 3)      # a late row inside lateness: its open windows still see it
    runner.flush()
    got = {r.window_end: r.n for r in read_window_results(spark, sql_out).collect()}
    assert got[dt.datetime(2024, 1, 1, 0, 0, 12)] == 2 and got[dt.datetime(2024, 1, 1, 0, 0, 18)] == 3


def test_expired_buckets_do_not_change_results(spark, tmp_path):
    f = flow()
    out = str(tmp_path / "windows")
    runner = FlowStream(f, spark.createDataFrame([], "value string, arrival_ts timestamp"),
                        sql_output_path=out, checkpoint=str(tmp_path / "ck"), lateness="1 second")
    mk = lambda secs: spark.createDataFrame(
        [(ACCESS_LINES[0], dt.datetime(2024, 1, 1) + dt.timedelta(seconds=secs))],
        "value string, arrival_ts timestamp")
    for i, secs in enumerate([1, 7, 13, 19, 25, 31, 60]):
        runner.process_batch(mk(secs), i)
    runner.flush()
    staged = os.listdir(tmp_path / "ck" / "stage" / "input")
    assert len([d for d in staged if d.startswith("_bucket=")]) < 7   # old buckets removed
    got = {r.window_end: r.n for r in read_window_results(spark, out).collect()}
    # every row in its 3 windows: 7 rows, 21 memberships
    assert sum(got.values()) == 21
    assert got[dt.datetime(2024, 1, 1, 0, 0, 18)] == 3


def test_materialized_views_equal_lazy_ones(lines):
    raw = lines([(v, dt.datetime(2024, 1, 1, 0, 0, i)) for i, v in enumerate(ACCESS_LINES)],
                with_time=True)
    lazy = flow().views(raw)
    mat = flow().views(raw, materialize=True)
    for name in ("input", "output"):
        assert sorted(map(tuple, lazy[name].collect())) == sorted(map(tuple, mat[name].collect()))
    assert "FileScan parquet" in mat["input"]._jdf.queryExecution().executedPlan().toString()


def test_app_runs_a_settings_file(spark, tmp_path):
    import json
    from rillet.streaming.app import main
    (tmp_path / "in.json").write_text(json.dumps(ACCESS_FIELDS))
    (tmp_path / "out.json").write_text(json.dumps(ACCESS_OUTPUT))
    (tmp_path / "rules").write_text("\n".join(ACCESS_RULES))
    rows, sql = tmp_path / "rows", tmp_path / "sql"
    (tmp_path / "settings.xml").write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n<property>\n'
        '<entry key="stream.input.format">separator</entry>\n'
        '<entry key="stream.input.separator">&#009;</entry>\n'
        '<entry key="stream.extraSQL.enable">false</entry>\n'
        f'<entry key="stream.output.savePath">{rows}</entry>\n'
        f'<entry key="stream.sql.savePath">{sql}</entry>\n'
        '<entry key="stream.sql.command">SELECT SUM(contentSize), COUNT(*), MIN(contentSize), '
        'MAX(contentSize) FROM input</entry>\n'
        '<entry key="stream.input.formatFilePath">in.json</entry>\n'
        '<entry key="stream.output.formatFilePath">out.json</entry>\n'
        '<entry key="rule.filePath">rules</entry>\n'
        '<entry key="stream.batchInterval">2</entry>\n'
        '<entry key="stream.window.length">18000</entry>\n'
        '<entry key="stream.window.slide">6000</entry>\n</property>\n')
    start = time.mktime(dt.datetime(2024, 1, 1).timetuple())
    _write_files(tmp_path / "src", [ACCESS_LINES], start)
    main(["--settings", str(tmp_path / "settings.xml"), "--checkpoint", str(tmp_path / "ck"),
          "--text-dir", str(tmp_path / "src"), "--available-now"])
    assert spark.read.text(str(rows)).count() == 7
    assert {r.value for r in spark.read.text(str(sql / "lines")).collect()} == {"[7000,7,1000,1000]"}


def test_stream_quarantines_bad_lines(spark, tmp_path):
    f = flow(on_error="quarantine")
    batch = spark.createDataFrame(
        [(ACCESS_LINES[0], dt.datetime(2024, 1, 1, 0, 0, 1)),
         ("1.1.1.1\tGET\t/x\tHTTP/1.1\tnot-a-number\t5", dt.datetime(2024, 1, 1, 0, 0, 2))],
        "value string, arrival_ts timestamp")
    runner = FlowStream(f, batch, str(tmp_path / "rows"), checkpoint=str(tmp_path / "ck"),
                        bad_path=str(tmp_path / "bad"))
    runner.process_batch(batch, 0)
    assert spark.read.text(str(tmp_path / "rows")).count() == 1
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [r._errors for r in bad] == ["bad Integer value for responseCode"]


def test_tick_emits_windows_without_new_lines(spark, tmp_path):
    out = str(tmp_path / "windows")
    runner = FlowStream(flow(), spark.createDataFrame([], "value string, arrival_ts timestamp"),
                        sql_output_path=out, checkpoint=str(tmp_path / "ck"))
    t0 = dt.datetime(2024, 1, 1)
    runner.process_batch(spark.createDataFrame([(ACCESS_LINES[0], t0 + dt.timedelta(seconds=1))],
                                               "value string, arrival_ts timestamp"), 0)
    assert not os.path.exists(out)                      # no window has closed yet
    epoch_us = lambda d: int((d - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    runner.tick(epoch_us(t0 + dt.timedelta(seconds=12)))  # wall clock passes two window ends
    ends = sorted(r.window_end for r in read_window_results(spark, out).collect())
    assert ends == [t0 + dt.timedelta(seconds=6), t0 + dt.timedelta(seconds=12)]


def test_kafka_source_names_the_kafka_connector(spark):
    import pytest
    from pyspark.errors import PySparkException
    from rillet.sources import kafka_lines
    with pytest.raises(PySparkException, match="(?i)kafka"):
        kafka_lines(spark, "localhost:9092", "logs", min_partitions=8)


def test_readme_example_runs(spark):
    import pathlib
    import re
    text = (pathlib.Path(__file__).parent.parent / "README.md").read_text()
    code = re.search(r"```python\n(.*?)```", text, re.S).group(1)
    scope = {}
    exec(code, scope)  # noqa: S102 - the README's own example
    assert scope["views"]["output"].count() > 0
    assert scope["stats"].count() > 0
    assert 0 < scope["per_window"].count() <= scope["stats"].count()


def test_echo_is_bounded(spark, tmp_path, capsys):
    f = flow()
    batch = spark.createDataFrame([(v, dt.datetime(2024, 1, 1)) for v in ACCESS_LINES],
                                  "value string, arrival_ts timestamp")
    runner = FlowStream(f, batch, checkpoint=str(tmp_path / "ck"), echo_rows=2)
    runner.process_batch(batch, 0)
    out = capsys.readouterr().out
    assert "batch 0 lines:" in out and "batch 0 rows:" in out
    assert "only showing top 2 rows" in out


def test_window_updates_replace_only_their_windows(spark, tmp_path):
    from rillet.streaming import write_window_batch
    path = str(tmp_path / "w")
    mk = lambda rows: spark.createDataFrame(
        rows, "window_start timestamp, window_end timestamp, n long")
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    write_window_batch(mk([(t(0), t(18), 1), (t(6), t(24), 1)]), path)
    write_window_batch(mk([(t(6), t(24), 2), (t(12), t(30), 1)]), path)   # update + new window
    write_window_batch(mk([(t(6), t(24), 2), (t(12), t(30), 1)]), path)   # the same batch replayed
    got = {r.window_end: r.n for r in spark.read.parquet(path).collect()}
    assert got == {t(18): 1, t(24): 2, t(30): 1}


def test_per_batch_sql_in_a_replay_keeps_or_needs_a_time(lines):
    import pytest
    from rillet.types import SchemaError
    at = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (1, 30, 31)]
    raw = lines([(f"{i}\tx", t) for i, t in enumerate(at)], with_time=True)

    def out(text, **kw):
        f = LogFlow({"a": "Integer", "b": "String"}, {"n": "String"}, ["n:MyFunctions:getOriginalStr:$b"],
                    extra_sql=text, **kw)
        return sorted((r.n, r.arrival_ts) for r in f.views(raw)["output"].collect())

    assert out("SELECT n FROM extraInput") == [("x", t) for t in at]
    with pytest.raises(SchemaError):
        out("SELECT MAX(n) AS n FROM extraInput")
    starts = [dt.datetime(2024, 1, 1, 0, 0, s) for s in (0, 30)]
    assert out("SELECT MAX(n) AS n FROM extraInput", batch_interval="10 seconds") == [("x", t) for t in starts]
    assert out("SELECT n FROM extraInput ORDER BY n LIMIT 1", batch_interval=10_000) == [("x", t) for t in starts]


def test_batches_are_counted_as_they_are_read_and_written(spark, tmp_path):
    mk = lambda *vs: spark.createDataFrame([(v, dt.datetime(2024, 1, 1)) for v in vs], "value string, arrival_ts timestamp")
    seen = []
    runner = FlowStream(flow(on_error="quarantine"), mk(), str(tmp_path / "rows"), checkpoint=str(tmp_path / "ck"),
                        echo_rows=1, on_batch=seen.append)
    runner.process_batch(mk(*ACCESS_LINES[:3], "broken"), 0)
    runner.process_batch(mk("broken", "broken"), 1)
    runner.process_batch(mk(), 2)
    assert [tuple(c) for c in seen] == [(0, 4, 1, 3), (1, 2, 2, None), (2, 0, 0, None)] == [tuple(c) for c in runner.counts]


def test_run_until_stopped_on_the_processing_time_trigger(spark, tmp_path):
    """run() blocks, reads what comes, and closes windows by the wall clock in between."""
    import threading
    src = tmp_path / "src"
    mk = lambda secs: spark.createDataFrame(
        [(ACCESS_LINES[0], dt.datetime(2024, 1, 1) + dt.timedelta(seconds=secs))], "value string, arrival_ts timestamp")
    mk(1).write.parquet(str(src))
    lines = spark.readStream.schema("value string, arrival_ts timestamp").parquet(str(src))
    runner = FlowStream(flow(), lines, sql_output_path=str(tmp_path / "w"), checkpoint=str(tmp_path / "ck"), trigger_seconds=0.5)
    thread = threading.Thread(target=runner.run)
    thread.start()
    try:
        for more, n in ((None, 3), (7, 4)):
            if more is not None:
                mk(more).write.mode("append").parquet(str(src))
            for _ in range(240):
                time.sleep(0.5)
                try:
                    if len(read_window_results(spark, str(tmp_path / "w")).collect()) == n:
                        break
                except Exception:  # noqa: BLE001 - nothing committed yet, or replaced while it was read
                    pass
            else:
                raise AssertionError("windows were not emitted")
    finally:
        runner.query.stop()
        thread.join(60)
    assert not thread.is_alive()
    assert sorted(r.n for r in runner.results().collect()) == [1, 1, 2, 2]
