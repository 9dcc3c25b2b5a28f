"""Strict conversion of text to a declared type, as Catalyst expressions.

``try_cast`` alone is laxer than the accepted text domains (it trims integers,
reads ``nan``/``inf``, and ``t``/``yes`` as true), so each type puts a guard in
front of it. The result is a pair ``(value, ok)``: ``value`` is null when the
text is rejected, ``ok`` is false only for rejected non-null text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..types import spark_type

# Accepted text patterns.
# Integral types: optional sign and ASCII digits, nothing else (no spaces).
INTEGRAL_TEXT = r"^[+-]?[0-9]+$"
# Floating types: any case spelling of these words is read by try_cast ...
FLOAT_WORDS_ANY_CASE = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
# ... but only these exact spellings are accepted.
FLOAT_WORDS_ACCEPTED = r"^\s*[+-]?(NaN|Infinity)\s*$"


def coerce(text: Column, kind: str) -> tuple[Column, Column]:
    """Typed value and acceptance flag for one text column."""
    if kind == "string":
        return text, F.lit(True)
    if kind == "char":
        value = F.when(F.length(text) == 1, text)
    elif kind == "boolean":
        # Everything is accepted: true iff the text equals "true" ignoring case.
        return F.lower(text) == F.lit("true"), F.lit(True)
    elif kind in ("byte", "short", "int", "long"):
        value = F.when(text.rlike(INTEGRAL_TEXT), text.try_cast(spark_type(kind)))
    elif kind in ("float", "double"):
        guard = ~text.rlike(FLOAT_WORDS_ANY_CASE) | text.rlike(FLOAT_WORDS_ACCEPTED)
        value = F.when(guard, text.try_cast(spark_type(kind)))
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return value, text.isNull() | value.isNotNull()
