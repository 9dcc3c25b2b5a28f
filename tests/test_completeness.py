"""No record is lost: late rows, restarts, ticks, re-runs; and the session stays as it was."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rillet.functions import default_registry
from rillet.operators.sql_stage import referenced_views
from rillet.operators.windows import SlideStage
from rillet.plans.flow import LogFlow
from rillet.sinks.window_results import WindowResults, read_window_results
from rillet.streaming import FlowStream
from rillet.types import SchemaError

T0 = datetime(2024, 1, 1)
TEXT = "SELECT COUNT(*) AS n FROM INPUT"


def flow(**kw):
    return LogFlow(input_schema={"name": "String", "v": "Integer"}, output_schema={"name": "String"},
                   rules=["name:MyFunctions:getOriginalStr:$name"], window_length=kw.pop("length", 18000),
                   window_slide=kw.pop("slide", 6000), window_sql=kw.pop("text", TEXT), **kw)


class Source:
    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, f"{root}/src", 0

    def rows(self, *seconds):
        data = [(f"a\t{i}", None if s is None else T0 + timedelta(seconds=s)) for i, s in enumerate(seconds)]
        return self.spark.createDataFrame(data, "value string, arrival_ts timestamp")

    def add(self, *seconds):
        self.rows(*seconds).coalesce(1).write.mode("append").parquet(self.root)

    def stream(self):
        return (self.spark.readStream.schema("value string, arrival_ts timestamp")
                .option("maxFilesPerTrigger", "1").parquet(self.root))


def runner(source, root, text=TEXT, **kw):
    return FlowStream(flow(text=text), source.stream(), sql_output_path=f"{root}/windows", checkpoint=f"{root}/ck", **kw)


def counts(spark, root):
    return {int((r.window_end - T0).total_seconds()): r.n for r in read_window_results(spark, f"{root}/windows").collect()}


def expected(seconds, length=18, slide=6):
    out = {}
    for end in range(-60, 240):
        if end % slide == 0:
            n = sum(end - length <= s < end for s in seconds)
            if n:
                out[end] = n
    return out


@pytest.fixture
def source(spark, tmp_path):
    s = Source(spark, tmp_path)
    s.add()
    return s


def test_tick_between_batches_loses_nothing(spark, tmp_path, source):
    r = runner(source, tmp_path)
    r.process_batch(source.rows(1), 0)
    r.tick(int((T0 + timedelta(seconds=300)).timestamp() * 1e6))
    r.process_batch(source.rows(2), 1)
    r.flush()
    assert counts(spark, tmp_path) == expected([1, 2])


def test_late_rows_complete_their_windows(spark, tmp_path, source):
    r = runner(source, tmp_path)
    r.process_batch(source.rows(1, 20), 0)
    assert counts(spark, tmp_path) == {e: n for e, n in expected([1, 20]).items() if e <= 20}
    r.process_batch(source.rows(2), 1)
    r.flush()
    assert counts(spark, tmp_path) == expected([1, 2, 20])


def test_what_the_driver_tracks_does_not_grow_with_time(spark, tmp_path, source):
    """Without a lateness rows stay for ever, but only the buckets of open windows are known;
    late rows still complete windows long gone, also after a restart."""
    r = runner(source, tmp_path)
    seconds = []
    for i in range(5):
        seconds += [40 * i + 1, 40 * i + 8]
        r.process_batch(source.rows(*seconds[-2:]), i)
        assert len(r.stage.view_counts("input")) <= 3 and len(r.stage.windows()) <= 5
    r.process_batch(source.rows(2, 45), 5)
    r.process_batch(source.rows(2, 45), 5)  # the same batch once more
    again = runner(source, tmp_path)
    assert len(again.stage.view_counts("input")) <= 3
    again.process_batch(source.rows(3), 6)
    again.flush()
    assert counts(spark, tmp_path) == expected([*seconds, 2, 45, 3])


def test_second_run_completes_flushed_windows(spark, tmp_path, source):
    for i, s in enumerate((1, 2)):
        r = runner(source, tmp_path)
        r.process_batch(source.rows(s), i)
        r.flush()
    assert counts(spark, tmp_path) == expected([1, 2])


def test_restart_then_flush(spark, tmp_path, source):
    runner(source, tmp_path).process_batch(source.rows(1), 0)
    runner(source, tmp_path).flush()
    assert counts(spark, tmp_path) == expected([1])


def test_windows_missing_after_a_crash_are_written(spark, tmp_path, source):
    r = runner(source, tmp_path)
    real, r.stage.run = r.stage.run, None
    with pytest.raises(TypeError):  # the crash: rows staged, no window written, or only a later one
        r.process_batch(source.rows(1, 40), 0)
    later = [w for w in r.stage.windows()][-1:]
    real(TEXT, later, out=f"{tmp_path}/windows")
    again = runner(source, tmp_path)
    again.process_batch(source.rows(1, 40), 0)
    again.flush()
    assert counts(spark, tmp_path) == expected([1, 40])


def test_rows_without_time_do_not_stop_the_stream(spark, tmp_path, source):
    r = runner(source, tmp_path)
    r.process_batch(source.rows(None), 0)
    r.process_batch(source.rows(1, None), 1)
    r.flush()
    assert counts(spark, tmp_path) == expected([1])


def test_lateness_keeps_what_comes_too_late(spark, tmp_path, source):
    r = runner(source, tmp_path, lateness="5 seconds")
    r.process_batch(source.rows(1, 40), 0)
    before = counts(spark, tmp_path)
    r.process_batch(source.rows(2, 38), 1)
    r.flush()
    assert r.late_rows == 1 and spark.read.parquet(r.late_path).count() == 1
    after = counts(spark, tmp_path)
    assert all(after[e] == n for e, n in before.items())
    assert {e: n for e, n in after.items() if e > 36} == {e: n for e, n in expected([1, 38, 40]).items() if e > 36}


HAVING = "SELECT COUNT(*) AS n FROM input HAVING COUNT(*) < 3"


@pytest.mark.parametrize("text", [HAVING, "SELECT COUNT(*) AS n FROM input HAVING COUNT(*) < (SELECT 3)"])
def test_a_rerun_without_rows_takes_the_result_away(spark, tmp_path, source, text):
    r = runner(source, tmp_path, text, sql_text_path=f"{tmp_path}/lines")
    r.process_batch(source.rows(1, 2, 40), 0)
    assert counts(spark, tmp_path) == {e: n for e, n in expected([1, 2, 40]).items() if e <= 40}
    r.process_batch(source.rows(3, 4, 7), 1)
    r.flush()
    want = {e: n for e, n in expected([1, 2, 3, 4, 7, 40]).items() if n < 3}
    assert counts(spark, tmp_path) == want
    lines = spark.read.text(f"{tmp_path}/lines").collect()
    assert sorted(x.value for x in lines) == sorted(f"[{n}]" for n in want.values())
    # a new late row makes all of them vanish or come back as the text says, after a restart too
    again = runner(source, tmp_path, text)
    again.process_batch(source.rows(41, 42), 2)
    again.flush()
    assert counts(spark, tmp_path) == {e: n for e, n in expected([1, 2, 3, 4, 7, 40, 41, 42]).items() if n < 3}


def test_a_crash_between_write_and_commit_shows_nothing(spark, tmp_path, source):
    r = runner(source, tmp_path, HAVING)
    r.process_batch(source.rows(1, 40), 0)
    before = counts(spark, tmp_path)
    real, WindowResults.commit = WindowResults.commit, None
    try:
        with pytest.raises(TypeError):  # rows of the re-run windows are written, not committed
            r.process_batch(source.rows(2, 3, 60), 1)
    finally:
        WindowResults.commit = real
    assert counts(spark, tmp_path) == before
    folders = len(list((tmp_path / "windows").glob("_attempt=*")))
    again = runner(source, tmp_path, HAVING)  # deletes what the crash left
    assert len(list((tmp_path / "windows").glob("_attempt=*"))) == folders - 1
    again.process_batch(source.rows(2, 3, 60), 1)
    again.flush()
    assert counts(spark, tmp_path) == {e: n for e, n in expected([1, 2, 3, 40, 60]).items() if n < 3}
    assert {(c.wend, c.rows) for c in WindowResults(spark, f"{tmp_path}/windows").current().collect()
            if c.rows == 0}  # windows without a result are committed too


def test_superseded_results_are_deleted(spark, tmp_path):
    results = WindowResults(spark, f"{tmp_path}/w")
    with pytest.raises(FileNotFoundError):
        results.read()
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "_wend long, n int")
    assert results.write(rows((6, 1), (6, 2), (12, 3)), [6, 12, 18]) == {6: 2, 12: 1, 18: 0}
    assert results.write(rows((18, 4)), [6, 18]) == {6: 0, 18: 1}
    assert sorted(r.n for r in results.read().collect()) == [3, 4]
    assert [r.n for r in results.read([12, 6]).collect()] == [3]
    assert len(list((tmp_path / "w").glob("_attempt=*"))) == 2  # each holds a window that counts
    results.compact()
    assert len(list((tmp_path / "w").glob("_attempt=*"))) == 1 and sorted(r.n for r in results.read().collect()) == [3, 4]
    assert results.write(rows(), [12, 18]) == {12: 0, 18: 0}
    assert results.read().collect() == [] and results.read().columns == ["n"]
    results.stage(rows((6, 9)))
    assert results.clean() == 1 and results.clean() == 0 and results.read().collect() == []


def test_append_without_batch_adds(spark, tmp_path):
    st = SlideStage(spark, "arrival_ts", 6000, root=f"{tmp_path}/stage")
    for i in range(2):
        st.append("input", spark.createDataFrame([(T0, i)], "arrival_ts timestamp, v int"))
    assert [r.n for r in st.run("SELECT COUNT(*) AS n FROM input").collect()] == [2]


def test_windows_without_result_rows(spark, tmp_path):
    st = SlideStage(spark, "arrival_ts", 6000, root=f"{tmp_path}/stage")
    st.append("input", spark.createDataFrame([(T0, 1)], "arrival_ts timestamp, v int"))
    res = st.run("SELECT v FROM input WHERE v > 5", text_out=f"{tmp_path}/lines")
    assert res.columns == ["window_start", "window_end", "v"] and res.count() == 0


def test_session_functions_in_window_sql(spark, tmp_path):
    spark.udf.register("plus_ten", F.udf(lambda v: v + 10, "int"))
    st = SlideStage(spark, "arrival_ts", 6000, root=f"{tmp_path}/stage")
    st.append("input", spark.createDataFrame([(T0, 1)], "arrival_ts timestamp, v int"))
    assert [r.x for r in st.run("SELECT plus_ten(v) AS x FROM Input").collect()] == [11]


def test_views_of_the_caller_are_left_alone(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("input")
    views = {n: spark.createDataFrame([], "v int") for n in ("input", "output")}
    assert referenced_views(views, "SELECT * FROM INPUT WHERE v IN (SELECT v FROM `output`)") == {"input", "output"}
    assert referenced_views(views, "WITH input AS (SELECT 1 AS v) SELECT * FROM input, output") == {"output"}
    assert spark.table("input").count() == 3
    assert not [r for r in spark.sql("SHOW VIEWS").collect() if r.viewName == "output"]
    for text, error in (("SELECT nope(1)", "UNRESOLVED_ROUTINE"), ("SELECT nope FROM input", "UNRESOLVED_COLUMN")):
        with pytest.raises(Exception, match=error):
            referenced_views(views, text)
    spark.catalog.dropTempView("input")


def test_classes_of_one_short_name(spark):
    r = default_registry()
    r.register("a.Foo", "f", ["String"], "String", lambda s: F.concat(s, F.lit("a")))
    r.register("b.Foo", "f", ["String"], "String", lambda s: F.concat(s, F.lit("b")))
    for ns in ("a.Foo", "b.Foo"):
        built = r.resolve(ns, "f", ["string"] if ("a.Foo", "f", ("string",)) in r._defs else
                          list(r._defs)[-1][2]).build(F.lit("x"))
        assert spark.range(1).select(built).first()[0] == "x" + ns[0]
    kinds = list(r._defs)[-1][2]
    with pytest.raises(SchemaError, match="ambiguous"):
        r.resolve("Foo", "f", kinds)
    with pytest.raises(SchemaError, match="unknown"):
        r.resolve("c.Foo", "f", kinds)
    assert r.resolve("any.package.MyFunctions", "toUpperCase", kinds).name == "toUpperCase"
