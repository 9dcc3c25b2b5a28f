from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_log import ACCESS_FIELDS, ACCESS_LINES, ACCESS_OUTPUT, ACCESS_RULES
from rillet.operators.parse import parse_lines
from rillet.operators.render import render
from rillet.operators.rules import apply_rules
from rillet.operators.sql_stage import run_sql, stringify


def derived(lines):
    return apply_rules(parse_lines(lines(ACCESS_LINES), ACCESS_FIELDS), ACCESS_RULES,
                       ACCESS_OUTPUT)


def test_extra_sql_projection(lines):
    res = run_sql({"extraInput": derived(lines)}, "SELECT size FROM extraInput")
    assert [r.size for r in res.collect()] == ["1000 MB"] * 7
    assert [r.value for r in render(res, "list").collect()][:1] == ["[1000 MB]"]
    assert [r.value for r in render(derived(lines), "list").collect()][:1] == ["[1000 KB, 1000 MB]"]


def test_lenient_sql_and_restored_mode(spark, lines):
    before = spark.conf.get("spark.sql.ansi.enabled")
    res = run_sql({"output": derived(lines)},
                  "SELECT SUM(size) AS s, COUNT(*) AS n, MIN(size) AS lo, MAX(size) AS hi FROM output")
    assert tuple(res.first()) == (None, 7, "1000 MB", "1000 MB")
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_default_statistics(lines):
    typed = parse_lines(lines(ACCESS_LINES), ACCESS_FIELDS)
    res = run_sql({"input": typed}, "SELECT SUM(contentSize), COUNT(*), MIN(contentSize), "
                                    "MAX(contentSize) FROM input")
    assert tuple(res.first()) == (7000, 7, 1000, 1000)


def test_stringify_keeps_order_types_and_nulls(spark):
    df = spark.createDataFrame([(1, "a", True, None, 2.5)], "i int, s string, b boolean, n long, d double")
    out = stringify(df)
    assert out.columns == ["i", "s", "b", "n", "d"]
    assert tuple(out.first()) == ("1", "a", "true", None, "2.5")


def test_render_forms(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    got = {f: render(df, f).first().value for f in ("tab", "list", "row")}
    assert got == {"tab": "1\tnull\tx", "list": "[1, null, x]", "row": "[1,null,x]"}


def test_other_delegated_aggregates(lines):
    typed = parse_lines(lines(ACCESS_LINES), ACCESS_FIELDS)
    res = run_sql({"input": typed},
                  "SELECT approx_count_distinct(ipAddress) AS a, first(method) AS f, "
                  "last(protocol) AS l, AVG(contentSize) AS m FROM input GROUP BY responseCode "
                  "HAVING COUNT(*) > 1")
    row = res.first()
    assert (row.a, row.f, row.l, row.m) == (7, "GET", "HTTP/1.1", 1000.0)


def test_referenced_views(spark):
    from rillet.operators.sql_stage import referenced_views
    a = spark.createDataFrame([], "x int")
    b = spark.createDataFrame([], "y string")
    views = {"input": a, "output": b}
    assert referenced_views(views, "SELECT SUM(x) FROM input") == {"input"}
    assert referenced_views(views, "SELECT y FROM output WHERE y LIKE 'a%'") == {"output"}
    assert referenced_views(views, "SELECT * FROM input JOIN output ON x = length(y)") == {
        "input", "output"}
    assert referenced_views(views, "SELECT x FROM input WHERE x IN (SELECT length(y) FROM output)") \
        == {"input", "output"}


def test_referenced_views_uses_the_flows_ansi_mode(spark):
    from rillet.operators.sql_stage import referenced_views
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    try:
        views = {"input": spark.createDataFrame([], "x int"),
                 "output": spark.createDataFrame([], "size string")}
        text = "SELECT SUM(size), COUNT(*), MIN(size), MAX(size) FROM output"
        assert referenced_views(views, text, ansi=False) == {"output"}
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"   # restored
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


PER_GROUP = [
    "SELECT SUM(v) AS s, COUNT(*) AS n FROM input", "SELECT SUM(v) AS s, COUNT(*) AS n FROM input WHERE v > 8",
    "SELECT ALL v FROM input", "SELECT ALL COUNT(*) AS n FROM Input i", "SELECT COUNT(*) AS n FROM input HAVING COUNT(*) < 3",
    "SELECT v FROM input ORDER BY v DESC LIMIT 2 -- GROUP BY v", "SELECT DISTINCT k FROM input;",
    "SELECT k, COUNT(*) AS n FROM input GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1", "/* ; ) */ SELECT 'a;b' AS x, ')' AS y FROM input",
    "WITH a AS (SELECT k, v FROM input WHERE v > 3) SELECT MAX(v) AS m FROM a", "SELECT k, COUNT(*) AS c FROM input GROUP BY ALL",
    "SELECT COUNT(*) AS n FROM input i JOIN output o ON i.v = o.n", "SELECT v FROM input UNION SELECT n FROM output",
    "SELECT v, ROW_NUMBER() OVER (PARTITION BY k ORDER BY v) AS r FROM input", "SELECT COUNT(DISTINCT k) AS c FROM input",
    "SELECT explode(array(v, 1)) AS x FROM input", "SELECT 'having' AS h, MAX(v) AS m FROM input HAVING MAX(v) > 1",
    "SELECT k FROM input EXCEPT SELECT size FROM output WHERE n > 4", "SELECT 1 AS one"]
ONE_BY_ONE = ["SELECT i.v, o.n FROM input i LEFT JOIN output o ON i.v = o.n + 1", "SELECT v FROM input WHERE v IN (SELECT n FROM output)",
              "SELECT v FROM input i WHERE EXISTS (SELECT 1 FROM output o WHERE o.n = i.v)",
              "SELECT v FROM input WHERE v = (SELECT MAX(n) FROM output)", "SELECT k, COUNT(*) AS c FROM input GROUP BY ROLLUP(k)"]


def test_text_for_each_group_in_one_plan(spark):
    """Every text gives what it gives over each group by itself; the others are told apart."""
    from rillet.operators.sql_stage import run_sql_each, runs_each
    rows = spark.createDataFrame([(g, v, None if v == 5 else f"k{v % 3}") for g in range(3) for v in range(g * 4)] + [(None, 1, "k")],
                                 "g int, v int, k string")
    views = {"input": rows, "output": rows.withColumnsRenamed({"v": "n", "k": "size"})}
    groups = spark.createDataFrame([(g, f"group {g}") for g in range(4)], "g int, name string")
    schemas = {n: d.drop("g").schema for n, d in views.items()}
    for text in PER_GROUP:
        assert runs_each(schemas, text, spark), text
        got = sorted((tuple(r) for r in run_sql_each(groups, views, "g", text).collect()), key=repr)
        one_by_one = [run_sql({n: d.where(f"g = {g}").drop("g") for n, d in views.items()}, text.rstrip(";")) for g in range(4)]
        alone = [d.select(F.lit(f"group {g}"), "*") for g, d in enumerate(one_by_one)]
        want = [tuple(r) for r in reduce(DataFrame.union, alone).collect()]
        assert got == sorted(want, key=repr), text
    for text in ONE_BY_ONE:
        assert not runs_each(schemas, text, spark), text
    spark.range(2).createOrReplaceTempView("input")
    run_sql_each(groups, views, "g", PER_GROUP[0])
    assert spark.table("input").columns == ["id"]  # the caller's own view is not touched
    spark.catalog.dropTempView("input")


def test_texts_that_handle_each_row_by_itself(spark):
    from rillet.operators.sql_stage import is_row_wise, run_sql_rows
    rows = spark.createDataFrame([(1, "1 MB", 10), (2, "2 MB", 20), (2, "2 MB", 20), (None, None, None)], "x int, size string, t int")

    def wise(text):
        return is_row_wise("input", rows.schema, text, spark)

    for text, want in (("SELECT size FROM Input", [(10, "1 MB"), (20, "2 MB"), (20, "2 MB"), (None, None)]),
                       ("SELECT ALL size AS s FROM input WHERE x > 1 -- x", [(20, "2 MB"), (20, "2 MB")]),
                       ("SELECT explode(array(x, 1)) AS y FROM input WHERE t = 10", [(10, 1), (10, 1)])):
        assert wise(text), text
        got = run_sql_rows(rows, "input", "t", text)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    plain = run_sql_rows(rows, "input", "t", "SELECT size FROM input")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    for text in ("SELECT DISTINCT x FROM input", "SELECT MAX(x) FROM input", "SELECT x FROM input ORDER BY x LIMIT 2",
                 "SELECT x FROM input LIMIT 1", "SELECT x, ROW_NUMBER() OVER (ORDER BY x) AS r FROM input",
                 "SELECT x FROM input WHERE x > (SELECT AVG(x) FROM input)", "SELECT x FROM input UNION ALL SELECT x FROM input"):
        assert not wise(text), text
