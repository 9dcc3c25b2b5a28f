import math

import pytest
from pyspark.sql import functions as F

from rillet.operators.coerce import coerce
from rillet.types import SchemaError, as_schema


def test_type_names_and_order():
    s = as_schema('{"b": "int", "a": "Integer", "c": "char"}')
    assert s.names == ["b", "a", "c"]
    assert [f.kind for f in s] == ["int", "int", "char"]
    for bad in ("void", "Void", "string", "Decimal"):
        with pytest.raises(SchemaError):
            as_schema({"x": bad})


def _coerce(spark, kind, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    value, ok = coerce(F.col("t"), kind)
    return [(r.v, r.ok) for r in df.select(value.alias("v"), ok.alias("ok")).collect()]


def test_integral_domain(spark):
    got = _coerce(spark, "int", ["+5", " 10", "10.5", "1e2", "", "2147483648", "-7", None])
    assert got == [(5, True), (None, False), (None, False), (None, False), (None, False),
                   (None, False), (-7, True), (None, True)]
    assert _coerce(spark, "byte", ["127", "128"]) == [(127, True), (None, False)]
    assert _coerce(spark, "short", ["32767", "32768"]) == [(32767, True), (None, False)]
    assert _coerce(spark, "long", ["9223372036854775807"])[0] == (9223372036854775807, True)


def test_floating_domain(spark):
    got = dict(zip([" 2.5 ", "1.5f", "NaN", "nan", "Infinity", "inf", "1e400", "abc"],
                   _coerce(spark, "double", [" 2.5 ", "1.5f", "NaN", "nan", "Infinity", "inf",
                                             "1e400", "abc"])))
    assert got[" 2.5 "] == (2.5, True)
    assert got["1.5f"] == (1.5, True)
    assert math.isnan(got["NaN"][0]) and got["NaN"][1]
    assert got["nan"] == (None, False)
    assert got["Infinity"] == (math.inf, True)
    assert got["inf"] == (None, False)
    assert got["1e400"] == (math.inf, True)
    assert got["abc"] == (None, False)


def test_boolean_and_char(spark):
    got = _coerce(spark, "boolean", ["TRUE", "t", "1", "yes", "abc", " true ", "true"])
    assert [v for v, _ in got] == [True, False, False, False, False, False, True]
    assert all(ok for _, ok in got)
    assert _coerce(spark, "char", ["a", "ab", ""]) == [("a", True), (None, False), (None, False)]
