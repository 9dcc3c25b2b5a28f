"""Property tests of the integral and floating text domains (one Spark job per property)."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillet.operators.coerce import coerce

INT32 = (-(2**31), 2**31 - 1)


def _run(spark, texts, kind):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    value, ok = coerce(F.col("t"), kind)
    return {r.i: (r.v, r.ok) for r in df.select("i", value.alias("v"), ok.alias("ok")).collect()}


def _expected_int(text):
    body = text[1:] if text[:1] in "+-" else text
    if not body or not body.isascii() or not body.isdigit():
        return None
    v = int(text)
    return v if INT32[0] <= v <= INT32[1] else None


int_texts = st.one_of(
    st.integers(-(2**40), 2**40).map(str),
    st.integers(0, 2**40).map(lambda v: f"+{v}"),
    st.integers(-1000, 1000).map(lambda v: f" {v}"),
    st.integers(-1000, 1000).map(lambda v: f"{v}.0"),
    st.text(alphabet="0123456789+-. e", max_size=6),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(int_texts, min_size=20, max_size=60))
def test_integer_texts(spark, texts):
    got = _run(spark, texts, "int")
    for i, t in enumerate(texts):
        want = _expected_int(t)
        assert got[i] == (want, want is not None), t


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), min_size=20,
                max_size=60))
def test_double_texts_round_trip(spark, values):
    got = _run(spark, [repr(v) for v in values], "double")
    for i, v in enumerate(values):
        parsed, ok = got[i]
        assert ok and (parsed == v or (math.isnan(parsed) and math.isnan(v))), repr(v)
