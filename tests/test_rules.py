import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from access_log import ACCESS_FIELDS, ACCESS_LINES, ACCESS_OUTPUT, ACCESS_RULES
from rillet.functions import default_registry
from rillet.operators.parse import parse_lines
from rillet.operators.rules import FieldRef, Literal, Rule, apply_rules, parse_argument
from rillet.types import SchemaError


@pytest.fixture
def access(lines):
    return parse_lines(lines(ACCESS_LINES), ACCESS_FIELDS)


def test_worked_example(access):
    out = apply_rules(access, ACCESS_RULES, ACCESS_OUTPUT)
    assert out.columns == ["contentSizeWithUnit", "size"]
    assert {tuple(r) for r in out.collect()} == {("1000 KB", "1000 MB")}
    assert out.count() == 7


def test_argument_typing():
    assert parse_argument('"KB"') == Literal("KB", "string")
    assert parse_argument("'a'") == Literal("a", "char")
    assert parse_argument("$x") == FieldRef("x")
    assert parse_argument("true") == Literal(True, "boolean")
    assert parse_argument("3") == Literal(3, "int")
    assert parse_argument("99999999999") == Literal(99999999999, "long")
    assert parse_argument("3.5") == Literal(3.5, "float")
    assert parse_argument("1.5f") == Literal(1.5, "float")
    for bad in ("", "5L", "abc", "'ab'"):
        with pytest.raises(SchemaError):
            parse_argument(bad)


def test_rule_text_shape():
    r = Rule.parse('f:a.b.MyFunctions:add:$x,"y"')
    assert (r.field, r.namespace, r.function) == ("f", "a.b.MyFunctions", "add")
    for bad in ("f:C:add", "f:C:add:1:2", "", "f:C:add:1,,2"):
        with pytest.raises(SchemaError):
            Rule.parse(bad)


def test_first_rule_wins_and_undeclared_ignored(access):
    rules = ['size:MyFunctions:add:$contentSize,"MB"', 'size:MyFunctions:add:$contentSize,"GB"',
             'other:MyFunctions:add:$contentSize,"TB"']
    out = apply_rules(access, rules, {"size": "String"})
    assert out.columns == ["size"] and out.first().size == "1000 MB"


def test_plan_time_errors(access):
    with pytest.raises(SchemaError, match="no rule"):
        apply_rules(access, ACCESS_RULES, {"size": "String", "missing": "String"})
    with pytest.raises(SchemaError, match="names no input field"):
        apply_rules(access, ['x:MyFunctions:addOne:$nope'], {"x": "Integer"})
    with pytest.raises(SchemaError, match="no method"):
        apply_rules(access, ['x:MyFunctions:addOne:$method'], {"x": "Integer"})
    with pytest.raises(SchemaError, match="no method"):
        apply_rules(access, ['x:MyFunctions:add:$contentSize,3.5'], {"x": "Integer"})
    with pytest.raises(SchemaError, match="unknown function class"):
        apply_rules(access, ['x:Other:addOne:$contentSize'], {"x": "Integer"})


def test_overloads_and_literals(access):
    rules = ["a:MyFunctions:add:$contentSize,$responseCode",
             "b:MyFunctions:add:$method,$protocol",
             "c:MyFunctions:add:$responseCode,$method",
             'd:MyFunctions:toUpperCase:"abc"',
             "e:MyFunctions:addOne:41",
             "f:MyFunctions:getOriginalStr:$endPoint"]
    out = apply_rules(access, rules, {"a": "Integer", "b": "String", "c": "String",
                                      "d": "String", "e": "int", "f": "String"})
    assert tuple(out.first()) == (1200, "GET HTTP/1.1", "200 GET", "ABC", 42,
                                  "/apps/logs/LogAnalyzer.java")


def test_typed_output(access):
    rules = ["n:MyFunctions:addOne:$contentSize", "s:MyFunctions:addOne:$contentSize",
             "d:MyFunctions:addOne:$contentSize", "t:MyFunctions:getOriginalStr:$method"]
    out = apply_rules(access, rules, {"n": "Long", "s": "String", "d": "Double", "t": "Boolean"})
    assert dict(out.dtypes) == {"n": "bigint", "s": "string", "d": "double", "t": "boolean"}
    assert tuple(out.first()) == (1001, "1001", 1001.0, False)
    with pytest.raises(PySparkException, match="not a Integer"):
        apply_rules(access, ['x:MyFunctions:add:$contentSize,"KB"'], {"x": "Integer"}).collect()


def test_overflow_raises_under_ansi(spark):
    df = spark.createDataFrame([(2147483647,)], "n int")
    with pytest.raises(PySparkException):
        apply_rules(df, ["m:MyFunctions:addOne:$n"], {"m": "Integer"}).collect()


def test_null_propagates(spark):
    df = spark.createDataFrame([(None, "a")], "n int, s string")
    out = apply_rules(df, ["m:MyFunctions:addOne:$n", 'k:MyFunctions:add:$n,"KB"'],
                      {"m": "Integer", "k": "String"})
    assert tuple(out.first()) == (None, None)


def test_custom_functions(spark):
    reg = default_registry()
    reg.register("com.acme.Fn", "twice", ["String"], "String", lambda s: F.concat(s, s))

    def shout(s: pd.Series) -> pd.Series:
        return s.str.upper() + "!"

    reg.register_pandas("Fn", "shout", ["String"], "String", shout)
    reg.register_sql("Fn", "rev", ["String"], "String", "reverse")
    df = spark.createDataFrame([("ab",)], "s string")
    out = apply_rules(df, ["x:com.acme.Fn:twice:$s", "y:Fn:shout:$s", "z:Fn:rev:$s"],
                      {"x": "String", "y": "String", "z": "String"}, registry=reg)
    assert tuple(out.first()) == ("abab", "AB!", "ba")


def test_builtin_rules_stay_in_the_jvm(access):
    out = apply_rules(access, ACCESS_RULES, ACCESS_OUTPUT)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    # an unused derived column is pruned away
    pruned = out.select("size")._jdf.queryExecution().optimizedPlan().toString()
    assert "KB" not in pruned


def test_classes_on_the_class_path(lines):
    """Static methods by argument types (boxed or primitive), results as the declared types; what
    is not there fails when the plan is built."""
    typed = parse_lines(lines(["10\ta b", "-3\tc"]), {"n": "Integer", "s": "String"})

    def derive(rules, out, **kw):
        return apply_rules(typed, rules, out, {"n": "Integer", "s": "String"}, **kw)

    out = derive(["h:java.lang.Integer:toHexString:$n", "m:java.lang.Math:floorMod:$n,4", 'e:java.net.URLEncoder:encode:$s,"UTF-8"',
                  "d:java.lang.Double:valueOf:$s1".replace("$s1", '"2.5"')],
                 {"h": "String", "m": "Integer", "e": "String", "d": "Double"})
    assert [tuple(r) for r in out.collect()] == [("a", 2, "a+b", 2.5), ("fffffffd", 1, "c", 2.5)]
    for rule, error in (("h:com.example.Nope:f:$n", "Nope"), ("h:java.lang.Integer:nope:$n", "nope"),
                        ("h:java.lang.Integer:toHexString:$s", "toHexString"), ("h:Nope:f:$n", "unknown function class")):
        with pytest.raises(SchemaError, match=error):
            derive([rule], {"h": "String"})
    from rillet.functions.registry import FunctionRegistry
    with pytest.raises(SchemaError, match="unknown function class"):
        derive(["h:java.lang.Integer:toHexString:$n"], {"h": "String"}, registry=FunctionRegistry(jvm_classes=False))
