"""Raw text lines -> typed columns (delimited, JSON or XML).

Delimited and JSON lines are parsed with built-in Catalyst expressions (``split``,
``from_json``), so parsing stays inside whole-stage codegen; XML, whose entries may lie at
any depth, by one pass of a parser over Arrow batches. All run the same on static and
streaming DataFrames. Fields are matched by name, and each line is parsed once.

Error policies (``on_error``):

* ``"fail"``       a bad line raises when the plan runs (the default);
* ``"null"``       bad values become null, the row is kept;
* ``"quarantine"`` the row gets ``_raw`` (the line) and ``_errors`` (reasons,
                   null for a good line);
                   split with :func:`good_rows` / :func:`bad_rows`.
"""

from __future__ import annotations

from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..types import Schema, SchemaError, as_schema
from .coerce import coerce

FORMATS = ("separator", "json", "xml")
ON_ERROR = ("fail", "null", "quarantine")
RAW_COL = "_raw"
ERRORS_COL = "_errors"
_PARSED = "__rillet_parsed"
_CORRUPT = "__rillet_corrupt"
_ROW = "__rillet_row"


def parse_lines(
    df: DataFrame,
    schema,
    fmt: str = "separator",
    separator: str = "\t",
    on_error: str = "fail",
    value_col: str = "value",
    strict_keys: bool = False,
    xml_any_depth: bool = True,
) -> DataFrame:
    """Parse ``value_col`` into the declared fields, in declared order.

    All other columns of ``df`` (for example an arrival time) follow the
    declared fields unchanged.

    * ``separator``: a Java regular expression, as for ``String.split``.
      A line needs at least as many pieces as fields, not counting trailing
      empty pieces; surplus pieces are ignored.
    * ``json``: one flat object per line; numbers may be bare or quoted,
      nested values of a String field arrive as JSON text, missing keys give
      null. ``strict_keys`` makes an undeclared key a bad line.
    * ``xml``: ``<entry key="field">value</entry>`` elements at any depth, the last of
      duplicate keys wins, an empty element is ``""``. ``xml_any_depth=False`` takes the
      children of the root element alone, with Spark's own reader, which does not look at
      what follows the root element.
    """
    schema = as_schema(schema)
    if fmt not in FORMATS:
        raise SchemaError(f"unknown input format {fmt!r}; expected one of {FORMATS}")
    if on_error not in ON_ERROR:
        raise SchemaError(f"unknown on_error {on_error!r}; expected one of {ON_ERROR}")
    for name in (RAW_COL, ERRORS_COL):
        if name in schema:
            raise SchemaError(f"field name {name!r} is reserved")
    keep = [c for c in df.columns if c != value_col and c not in schema]
    line = F.col(value_col)

    if fmt == "separator":
        staged, texts, problems = _separator(df, line, schema, separator)
    elif fmt == "json":
        staged, texts, problems = _json(df, line, schema, strict_keys)
    else:
        staged, texts, problems = _xml(df, line, schema, strict_keys, xml_any_depth)
    problems = [F.when(line.isNull(), F.lit("null line"))] + problems

    values, reasons = [], []
    for f in schema:
        value, ok = coerce(texts[f.name], f.kind)
        values.append(value.cast(f.data_type).alias(f.name))
        reasons.append(F.when(~ok, F.lit(f"bad {f.type_name} value for {f.name}")))

    if on_error == "null":
        return _emit(staged, F.struct(*values), keep)
    # concat_ws skips nulls: "" when the line has no problem
    errors = F.concat_ws("; ", *problems, *reasons)
    if on_error == "quarantine":
        return _emit(staged, F.struct(*values, line.alias(RAW_COL),
                                      F.when(errors != "", errors).alias(ERRORS_COL)), keep)
    # fail: the row is guarded by the check, so values and checks share
    # subexpressions, and every line is checked whatever columns are read.
    message = F.concat(F.lit("bad input line ("), errors, F.lit("): "),
                       F.coalesce(line, F.lit("null")))
    row = F.when(errors != "", F.raise_error(message)).otherwise(F.struct(*values))
    return _emit(staged, row, keep).select(*[_q(f.name) for f in schema], *map(_q, keep))


def _emit(staged: DataFrame, row: Column, keep: list[str]) -> DataFrame:
    """The parsed fields as the output of a generator over one struct per line.

    The struct is built in a projection, where common subexpressions of the
    values and checks are evaluated once. A predicate on a parsed field cannot
    be pushed below the Generate, so a later filter or join key never
    re-evaluates (inlines) the parse; predicates on pass-through columns still
    reach the scan.
    """
    return (staged.select(row.alias(_ROW), *map(_q, keep))
            .select(F.inline(F.array(F.col(_ROW))), *map(_q, keep)))


def _q(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col(f"`{name}`")


def good_rows(parsed: DataFrame) -> DataFrame:
    """Rows of a quarantine parse without problems, without the bookkeeping columns."""
    return parsed.where(F.col(ERRORS_COL).isNull()).drop(RAW_COL, ERRORS_COL)


def bad_rows(parsed: DataFrame) -> DataFrame:
    """Rejected lines of a quarantine parse: the line and its reasons."""
    return parsed.where(F.col(ERRORS_COL).isNotNull()).select(RAW_COL, ERRORS_COL)


def _separator(df: DataFrame, line: Column, schema: Schema, separator: str):
    pieces = F.split(line, separator, -1)
    n = len(schema)
    staged = df.withColumn(_PARSED, pieces)
    pieces = F.col(_PARSED)
    # Trailing empty pieces do not count: the line is complete when a non-empty
    # piece exists at position n or later (a one-field schema also takes "").
    # ("" sorts first, so the largest remaining piece is non-empty iff one is).
    rest = F.slice(pieces, n, F.size(pieces))
    complete = F.coalesce(F.array_max(rest), F.lit("")) != F.lit("")
    if n == 1:
        complete = complete | (line == F.lit(""))
    texts = {f.name: F.get(pieces, i) for i, f in enumerate(schema)}
    return staged, texts, [F.when(line.isNotNull() & ~complete, F.lit(f"fewer than {n} fields"))]


def _json(df: DataFrame, line: Column, schema: Schema, strict_keys: bool):
    # Every field is read as text first and typed afterwards, so that "1000"
    # and 1000 are both an Integer and nested objects stay JSON text.
    ddl = ", ".join(f"`{f.name}` string" for f in schema) + f", {_CORRUPT} string"
    parsed = F.from_json(line, ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    staged = df.withColumn(_PARSED, parsed)
    p = F.col(_PARSED)
    texts = {f.name: p[f.name] for f in schema}
    problems = [F.when(line.isNotNull() & (p.isNull() | p[_CORRUPT].isNotNull()),
                       F.lit("malformed json"))]
    if strict_keys:
        extra = F.array_except(F.json_object_keys(line), F.array(*[F.lit(n) for n in schema.names]))
        problems.append(F.when(F.size(extra) > 0, F.concat(F.lit("undeclared keys "),
                                                            F.array_join(extra, ","))))
    return staged, texts, problems


def _xml(df: DataFrame, line: Column, schema: Schema, strict_keys: bool, any_depth: bool):
    if any_depth:
        return _xml_any_depth(df, line, schema, strict_keys)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT,
            "ignoreSurroundingSpaces": "false"}
    ddl = f"entry array<struct<_key:string,_VALUE:string>>, {_CORRUPT} string"
    staged = df.withColumn(_PARSED, F.from_xml(line, ddl, opts))
    p = F.col(_PARSED)
    wellformed = line.isNotNull() & p.isNotNull() & p[_CORRUPT].isNull()
    problems = [F.when(line.isNotNull() & ~wellformed, F.lit("malformed xml"))]
    # Built-in array functions only (no lambdas): the last entry with a key is
    # found by its position in the reversed key list.
    keys = F.reverse(F.coalesce(p["entry"]["_key"], F.array()))
    values = F.reverse(F.coalesce(p["entry"]["_VALUE"], F.array()))
    texts = {}
    for f in schema:
        pos = F.array_position(keys, F.lit(f.name)).cast("int")
        texts[f.name] = F.when(pos > 0, F.coalesce(F.element_at(values, pos), F.lit("")))
    # a null key shows as the U+0001 stand-in (XML text cannot hold it)
    problems.append(F.when(F.array_join(keys, ",", _XSEP).contains(_XSEP),
                           F.lit("entry without key")))
    if strict_keys:
        declared = F.array(*[F.lit(n) for n in schema.names], F.lit(None).cast("string"))
        problems.append(F.when(F.size(F.array_except(keys, declared)) > 0,
                               F.lit("undeclared keys")))
    return staged, texts, problems


# XML 1.0 text cannot hold U+0001 (not even as a character reference), so it
# safely stands for a null among keys.
_XSEP = "\x01"


def _xml_any_depth(df: DataFrame, line: Column, schema: Schema, strict_keys: bool):
    """Entries at any depth, by one pass of expat over a line, in Arrow batches.

    Spark's own readers need a schema of known depth, and its XPath functions build a
    document a call. Names are compared as written, prefix included; an entry's text is
    all text inside it; of several entries with a key the last to begin wins.
    """
    names = schema.names
    at = {name: i for i, name in enumerate(names)}
    columns = ["problem", *[f"f{i}" for i in range(len(names))]]

    @F.pandas_udf(", ".join(f"{c} string" for c in columns))
    def read(lines: pd.Series) -> pd.DataFrame:
        rows = []
        for text in lines:
            row = [None] * len(columns)
            if text is not None:
                entries = xml_entries_of(text)
                if entries is None:
                    row[0] = "malformed xml"
                else:
                    problems = []
                    if any(key is None for key, _ in entries):
                        problems.append("entry without key")
                    if strict_keys and any(key is not None and key not in at for key, _ in entries):
                        problems.append("undeclared keys")
                    row[0] = "; ".join(problems) or None
                    for key, value in entries:
                        if key in at:
                            row[1 + at[key]] = value
            rows.append(row)
        return pd.DataFrame(rows, columns=columns, dtype=object)

    staged = df.withColumn(_PARSED, read(line))
    p = F.col(_PARSED)
    return staged, {name: p[f"f{i}"] for name, i in at.items()}, [p["problem"]]


def xml_entries_of(line: str) -> list[tuple[str | None, str]] | None:
    """Key (None: no such attribute) and text of each ``entry`` element, in the order in
    which they begin; None for a line that is not one well-formed document."""
    parser = expat.ParserCreate()
    parser.buffer_text = True
    found, inside = [], []

    def begin(name, attributes):
        if name == "entry":
            entry = (attributes.get("key"), [])
            found.append(entry)
            inside.append(entry)

    def end(name):
        if name == "entry":
            inside.pop()

    def text(part):
        for entry in inside:
            entry[1].append(part)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = begin, end, text
    try:
        parser.Parse(line.lstrip(), True)
    except (expat.ExpatError, UnicodeEncodeError):
        return None
    return [(key, "".join(parts)) for key, parts in found]
