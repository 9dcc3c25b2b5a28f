import pytest
from pyspark.errors import PySparkException

from access_log import ACCESS_FIELDS, ACCESS_JSON, ACCESS_LINES, ACCESS_XML
from rillet.operators.parse import bad_rows, good_rows, parse_lines
from rillet.types import SchemaError

THREE = {"a": "String", "b": "Integer", "c": "String"}


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_three_encodings_give_the_same_row(lines):
    sep = parse_lines(lines(ACCESS_LINES[:1]), ACCESS_FIELDS)
    js = parse_lines(lines([ACCESS_JSON]), ACCESS_FIELDS, "json")
    xml = parse_lines(lines([ACCESS_XML]), ACCESS_FIELDS, "xml")
    expected = [("1.1.1.1", "GET", "/apps/logs/LogAnalyzer.java", "HTTP/1.1", 200, 1000)]
    assert rows(sep) == rows(js) == rows(xml) == expected


def test_separator_arity(lines):
    df = lines(["x\t1\ty", "x\t1", "x\t1\ty\tsurplus", "x\t1\t\t", "x\t\ty"])
    parsed = parse_lines(df, THREE, on_error="quarantine")
    assert rows(good_rows(parsed)) == [("x", 1, "y"), ("x", 1, "y")]
    bad = {r._raw: r._errors for r in bad_rows(parsed).collect()}
    assert bad["x\t1"] == "fewer than 3 fields"
    assert bad["x\t1\t\t"] == "fewer than 3 fields"       # trailing empties do not count
    assert bad["x\t\ty"] == "bad Integer value for b"      # "" is not an Integer


def test_separator_is_a_regex(lines):
    two = {"a": "String", "b": "String"}
    assert rows(parse_lines(lines(["p|q"]), two, separator="\\|")) == [("p", "q")]
    # a bare pipe is an empty alternation: it splits between every character
    assert rows(parse_lines(lines(["pq"]), two, separator="|")) == [("p", "q")]
    assert rows(parse_lines(lines(["a1b22c"]), {"x": "String", "y": "String", "z": "String"},
                            separator="[0-9]+")) == [("a", "b", "c")]


def test_fail_mode_raises(lines):
    with pytest.raises(PySparkException, match="fewer than 3 fields"):
        parse_lines(lines(["x\t1"]), THREE).collect()
    assert rows(parse_lines(lines(["x\t1"]), THREE, on_error="null")) == [("x", 1, None)]


def test_json_cases(lines):
    df = lines([
        '{"c": "z", "a": "x", "b": 1}',          # another key order
        '{"a": "x", "b": "2"}',                   # missing key, quoted number
        '{"a": {"n": [1, 2]}, "b": 3, "c": null}',  # nested object into a String field
        '{"a": "x", "b": 4, "extra": true}',      # undeclared key
        '{broken',
        '{"a": "x", "b": 1.5}',
    ])
    parsed = parse_lines(df, THREE, "json", on_error="quarantine")
    assert rows(good_rows(parsed)) == [("x", 1, "z"), ("x", 2, None), ('{"n":[1,2]}', 3, None),
                                       ("x", 4, None)]
    bad = {r._raw: r._errors for r in bad_rows(parsed).collect()}
    assert bad["{broken"] == "malformed json"
    assert bad['{"a": "x", "b": 1.5}'] == "bad Integer value for b"
    strict = parse_lines(df, THREE, "json", on_error="quarantine", strict_keys=True)
    assert "undeclared keys extra" in {r._errors for r in bad_rows(strict).collect()}


def test_xml_cases(lines):
    df = lines([
        '<xml><entry key="a">x</entry><entry key="b">1</entry><entry key="b">2</entry></xml>',
        '<xml><entry key="a"></entry><entry key="b">3</entry><entry key="c"> s </entry></xml>',
        '<xml><entry key="a">x</entry><entry>no key</entry><entry key="b">4</entry></xml>',
        '<xml><entry key="a">x</entry><entry key="b"> 5</entry></xml>',
        '<xml><entry key="a">x',
        '<xml><entry key="a">a &amp; b</entry><entry key="b">6</entry></xml>',
    ])
    parsed = parse_lines(df, THREE, "xml", on_error="quarantine")
    assert rows(good_rows(parsed)) == [("x", 2, None), ("", 3, " s "), ("a & b", 6, None)]
    reasons = sorted(r._errors for r in bad_rows(parsed).collect())
    assert reasons == ["bad Integer value for b", "entry without key", "malformed xml"]


def test_xml_any_depth(lines):
    df = lines(['<xml><g><entry key="a">deep</entry></g><entry key="b">7</entry></xml>'])
    assert rows(parse_lines(df, THREE, "xml", xml_any_depth=False, on_error="null")) == [(None, 7, None)]
    assert rows(parse_lines(df, THREE, "xml", on_error="null")) == [("deep", 7, None)]


def test_xml_entries_as_written(lines):
    """Nested entries, CDATA, comments, entities, prefixes, a default name space, quotes, one pass each."""
    cases = {
        '<x><entry key="a">1<entry key="b">2</entry>3</entry></x>': ("123", 2, None),
        '<x><entry key="a">x<![CDATA[<&]]><!-- no -->y&#65;</entry></x>': ("x<&yA", None, None),
        '<x xmlns="urn:u"><entry key="a">n</entry></x>': ("n", None, None),
        '<x><p:entry key="a">other</p:entry></x>': (None, None, None),
        "<entry key='a'>root</entry>": ("root", None, None),
        '<?xml version="1.0" encoding="ISO-8859-1"?><x><entry key="a">é中</entry></x>': ("é中", None, None),
        '<!DOCTYPE x [<!ENTITY e "v">]><x><entry key="a">&e;</entry></x>': ("v", None, None),
        '<x><entry key="a">&nope;</entry></x>': "malformed xml", "<x>\x01</x>": "malformed xml",
        '<x><entry key="a" key="b"/></x>': "malformed xml",
    }
    got = parse_lines(lines(list(cases)), THREE, "xml", on_error="quarantine").collect()
    assert {r._raw: r._errors or (r.a, r.b, r.c) for r in got} == cases


def test_xml_is_parsed_once_a_line(lines):
    plan = parse_lines(lines([ACCESS_XML]), ACCESS_FIELDS, "xml")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "xpath" not in plan and "from_xml" not in plan


def test_other_columns_pass_through(lines):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = lines([("x\t1\ty", t)], with_time=True)
    out = parse_lines(df, THREE)
    assert out.columns == ["a", "b", "c", "arrival_ts"]


def test_bad_settings(lines):
    with pytest.raises(SchemaError):
        parse_lines(lines(["x"]), THREE, fmt="csv")
    with pytest.raises(SchemaError):
        parse_lines(lines(["x"]), THREE, on_error="ignore")


def test_fail_mode_checks_every_line_even_for_count(lines):
    with pytest.raises(PySparkException, match="bad Integer value for b"):
        parse_lines(lines(["x\t1\ty", "x\tnope\ty"]), THREE).count()
    with pytest.raises(PySparkException, match="bad Integer value for b"):
        parse_lines(lines(["x\t1\ty", "x\tnope\ty"]), THREE).select("a").collect()


def test_null_line(lines, spark):
    df = spark.createDataFrame([(None,)], "value string")
    parsed = parse_lines(df, THREE, on_error="quarantine")
    assert [r._errors for r in bad_rows(parsed).collect()] == ["null line"]


def test_xml_any_depth_cases(lines):
    df = lines([
        '<xml><g><entry key="a">x</entry><entry key="b">1</entry></g><entry key="b">2</entry></xml>',
        '<xml><entry key="a"></entry><h><entry key="b">3</entry></h><entry key="c"> s </entry></xml>',
        '<xml><entry key="a">x</entry><g><entry>no key</entry></g><entry key="b">4</entry></xml>',
        '<xml><entry key="a">x',
        '<xml><entry key="a">a &amp; b</entry><entry key="b">6</entry><entry key="z">q</entry></xml>',
    ])
    parsed = parse_lines(df, THREE, "xml", on_error="quarantine", xml_any_depth=True)
    assert rows(good_rows(parsed)) == [("x", 2, None), ("", 3, " s "), ("a & b", 6, None)]
    reasons = sorted(r._errors for r in bad_rows(parsed).collect())
    assert reasons == ["entry without key", "malformed xml"]
    strict = parse_lines(df, THREE, "xml", on_error="quarantine", xml_any_depth=True,
                         strict_keys=True)
    assert "undeclared keys" in {r._errors for r in bad_rows(strict).collect()}


def test_field_names_with_dots_and_spaces(lines):
    from rillet.operators.rules import apply_rules
    schema = {"a.b": "String", "c d": "Integer"}
    out = parse_lines(lines(['{"a.b": "x", "c d": 3}']), schema, "json")
    assert rows(out) == [("x", 3)]
    derived = apply_rules(out, ["n:MyFunctions:addOne:$c d", "s:MyFunctions:getOriginalStr:$a.b"],
                          {"n": "Integer", "s": "String"}, schema)
    assert rows(derived) == [(4, "x")]


def test_any_depth_marks_content_after_the_root(lines):
    good = '<xml><g><entry key="a">1</entry></g><entry key="b">x</entry></xml>'
    cases = {good: None, '<?xml version="1.0"?>' + good: None, " " + good + " <!-- end --> ": None,
             "<!-- first --><!DOCTYPE xml>" + good: None,
             good + "<xml/>": "malformed xml", good + "junk": "malformed xml", good + "<entry": "malformed xml",
             "<!-- only -->": "malformed xml", "": "malformed xml", "junk" + good: "malformed xml",
             good + "</__rillet_line><__rillet_line>": "malformed xml",
             "<xml><entry>1</entry></xml>": "entry without key"}
    schema = {"a": "Integer", "b": "String"}
    got = {r._raw: r._errors for r in
           parse_lines(lines(list(cases)), schema, "xml", on_error="quarantine", xml_any_depth=True).collect()}
    assert {k: v and v.split(";")[0] for k, v in got.items()} == cases
    nulls = parse_lines(lines([good + "junk", good]), schema, "xml", on_error="null", xml_any_depth=True).collect()
    assert [tuple(r) for r in nulls] == [(None, None), (1, "x")]


def test_any_depth_reads_many_fields(lines):
    names = [f"f{i}" for i in range(23)]
    line = "<xml><g>" + "".join(f'<entry key="{n}">{n}!</entry>' for n in names) + "</g></xml>"
    row = parse_lines(lines([line]), {n: "String" for n in names}, "xml", xml_any_depth=True).first()
    assert list(row) == [f"{n}!" for n in names]
