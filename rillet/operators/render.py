"""Rendering rows as text lines for text sinks.

* :func:`tab_line`  values joined by a tab, null printed as ``null``;
* :func:`list_line` ``[a, b]``, the list form of derived rows;
* :func:`row_line`  ``[a,b]``, the row form of SQL results.

``concat_ws`` would silently drop nulls, so ``array_join`` with a null
replacement is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators and null spelling of the three text forms.
TAB = "\t"
LIST_SEP = ", "
ROW_SEP = ","
NULL_TEXT = "null"


def _joined(cols: Sequence[str], sep: str) -> Column:
    return F.array_join(F.array(*[F.col(f"`{c}`").cast("string") for c in cols]), sep, NULL_TEXT)


def tab_line(cols: Sequence[str]) -> Column:
    return _joined(cols, TAB)


def list_line(cols: Sequence[str]) -> Column:
    return F.concat(F.lit("["), _joined(cols, LIST_SEP), F.lit("]"))


def row_line(cols: Sequence[str]) -> Column:
    return F.concat(F.lit("["), _joined(cols, ROW_SEP), F.lit("]"))


def render(df: DataFrame, form: str = "list", cols: Sequence[str] | None = None,
           keep: Sequence[str] = (), name: str = "value") -> DataFrame:
    """One text column ``name`` (plus ``keep`` columns) from ``cols`` of ``df``."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in keep]
    line = {"tab": tab_line, "list": list_line, "row": row_line}[form](cols)
    return df.select(line.alias(name), *keep)
