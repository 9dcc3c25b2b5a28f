"""Raw lines from a table: every row rendered as one separator, JSON or XML line.

This is the bounded (replay) source: a table with a time column becomes the
same ``(value, arrival_ts)`` shape a stream delivers, so the whole chain can
be run and checked on static data. Rendering is built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = "arrival_ts"


def _text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def _xml_escape(c: Column) -> Column:
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def _attr(text: str) -> str:
    return text.replace("&", "&amp;").replace('"', "&quot;").replace("<", "&lt;")


def separator_line(fields: Sequence[str], separator: str = "\t") -> Column:
    """Fields joined by ``separator`` (a literal here); null becomes an empty piece."""
    return F.array_join(F.array(*[_text(f) for f in fields]), separator, "")


def json_line(fields: Sequence[str], quote_all: bool = False) -> Column:
    """A flat JSON object with keys in the given order; null fields are left out.
    ``quote_all`` writes every value as a JSON string."""
    cols = [(_text(f) if quote_all else F.col(f"`{f}`")).alias(f) for f in fields]
    return F.to_json(F.struct(*cols))


def xml_entries(fields: Sequence[str]) -> Column:
    """``<entry key="f">text</entry>`` for each field; null fields are left out."""
    entries = [F.concat(F.lit(f'<entry key="{_attr(f)}">'), _xml_escape(_text(f)),
                        F.lit("</entry>"))
               for f in fields]
    return F.concat_ws("", *entries)


def xml_line(fields: Sequence[str], root: str = "xml") -> Column:
    """``<root><entry key="f">text</entry>...</root>``; null fields are left out."""
    return F.concat(F.lit(f"<{root}>"), xml_entries(fields), F.lit(f"</{root}>"))


def table_lines(df: DataFrame, fields: Sequence[str], fmt: str = "separator",
                separator: str = "\t", time_col: str | None = None, keep: Sequence[str] = (),
                quote_all: bool = False) -> DataFrame:
    """``value`` (one line per row) and ``arrival_ts`` (from ``time_col``), plus ``keep``."""
    if fmt == "separator":
        line = separator_line(fields, separator)
    elif fmt == "json":
        line = json_line(fields, quote_all)
    elif fmt == "xml":
        line = xml_line(fields)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    cols = [line.alias("value")]
    if time_col:
        cols.append(F.col(f"`{time_col}`").alias(ARRIVAL))
    return df.select(*cols, *keep)
