"""Declarative rules -> derived columns, compiled into one projection.

A rule says how one output field is computed: a function applied to input
fields (``$name``) and literals. The text form is
``outField:Class:function:arg1,arg2``; :class:`Rule` can also be built directly,
which lifts the text form's ban on ``:`` and ``,`` inside literals.

Compilation happens once per plan: argument kinds come from the input schema
and the literal spelling, the function overload is resolved in the registry,
and the result is one Catalyst expression per output field. An unused
derived column is pruned by the optimizer like any other column.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import BUILTIN_NAMESPACE, FunctionRegistry, default_registry
from ..types import Schema, SchemaError, as_schema, infer_schema, spark_type
from .coerce import coerce

INT32 = (-(2**31), 2**31 - 1)
INT64 = (-(2**63), 2**63 - 1)
_INTEGER_LITERAL = re.compile(r"[+-]?[0-9]+")
_FLOAT_LITERAL = re.compile(
    r"[\x00-\x20]*[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?))[fFdD]?[\x00-\x20]*"
)


@dataclass(frozen=True)
class FieldRef:
    """``$name``: the value of an input field, with that field's type."""
    name: str


@dataclass(frozen=True)
class Literal:
    value: object
    kind: str


@dataclass(frozen=True)
class Rule:
    field: str
    function: str
    args: tuple
    namespace: str = BUILTIN_NAMESPACE

    @classmethod
    def parse(cls, text: str) -> Rule:
        """``outField:Class:function:arg1,arg2`` (exactly four parts, at least one argument)."""
        parts = _java_split(text, ":")
        if len(parts) != 4:
            raise SchemaError(f"rule {text!r} must have 4 ':'-separated parts")
        field, namespace, function, arg_text = parts
        args = tuple(parse_argument(a) for a in _java_split(arg_text, ","))
        if not args:
            raise SchemaError(f"rule {text!r} has no arguments")
        return cls(field, function, args, namespace)


def _java_split(text: str, sep: str) -> list[str]:
    """``str.split`` without trailing empty pieces, as rule files have always been read."""
    parts = text.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def parse_argument(text: str) -> FieldRef | Literal:
    """Type one argument by its spelling, in this order: "string", 'c' (char),
    $field, true/false, integer (long beyond int range), float."""
    if not text:
        raise SchemaError("empty rule argument")
    if len(text) >= 2 and text[0] == '"' and text[-1] == '"':
        return Literal(text[1:-1], "string")
    if len(text) >= 2 and text[0] == "'" and text[-1] == "'":
        if len(text) != 3:
            raise SchemaError(f"char literal {text!r} must hold one character")
        return Literal(text[1], "char")
    if text[0] == "$":
        return FieldRef(text[1:])
    if text in ("true", "false"):
        return Literal(text == "true", "boolean")
    if _INTEGER_LITERAL.fullmatch(text):
        v = int(text)
        if INT32[0] <= v <= INT32[1]:
            return Literal(v, "int")
        if INT64[0] <= v <= INT64[1]:
            return Literal(v, "long")
        return Literal(float(v), "float")
    if _FLOAT_LITERAL.fullmatch(text):
        return Literal(float(text.strip("\x00\x20\t\n\r\x0b\x0c").rstrip("fFdD")), "float")
    raise SchemaError(f"cannot type rule argument {text!r}")


def parse_rules(rules: str | Iterable[str | Rule]) -> list[Rule]:
    """Rules from text (one per line) or a sequence of texts and :class:`Rule` values."""
    if isinstance(rules, str):
        rules = rules.splitlines()
    return [r if isinstance(r, Rule) else Rule.parse(r) for r in rules]


def compile_rules(rules, input_schema, output_schema, registry: FunctionRegistry | None = None,
                  on_error: str = "fail") -> list[Column]:
    """One aliased Column per declared output field, in declared order.

    The first rule naming a field wins; rules for undeclared fields are
    ignored; a declared field without a rule is an error.
    """
    registry = registry or default_registry()
    input_schema = as_schema(input_schema)
    output_schema = as_schema(output_schema)
    by_field: dict[str, Rule] = {}
    for rule in parse_rules(rules):
        by_field.setdefault(rule.field, rule)
    columns = []
    for out in output_schema:
        if out.name not in by_field:
            raise SchemaError(f"no rule for output field {out.name!r}")
        rule = by_field[out.name]
        cols, kinds = zip(*(_argument(a, input_schema) for a in rule.args))
        fdef = registry.resolve(rule.namespace, rule.function, kinds)
        result = fdef.build(*cols)
        columns.append(_as_declared(result, fdef.return_kind, out, on_error).alias(out.name))
    return columns


def apply_rules(df: DataFrame, rules, output_schema, input_schema=None,
                registry: FunctionRegistry | None = None, keep: Sequence[str] = (),
                on_error: str = "fail") -> DataFrame:
    """Derived rows: one per input row, the declared output fields, then ``keep`` columns."""
    if input_schema is None:
        input_schema = infer_schema(df.schema)
    return df.select(*compile_rules(rules, input_schema, output_schema, registry, on_error),
                     *[F.col(f"`{k}`") for k in keep])


def _argument(arg, input_schema: Schema) -> tuple[Column, str]:
    if isinstance(arg, FieldRef):
        if arg.name not in input_schema:
            raise SchemaError(f"rule argument ${arg.name} names no input field")
        return F.col(f"`{arg.name}`"), input_schema.field(arg.name).kind
    if isinstance(arg, Literal):
        return F.lit(arg.value).cast(spark_type(arg.kind)), arg.kind
    raise SchemaError(f"bad rule argument {arg!r}")


def _as_declared(result: Column, return_kind: str, out, on_error: str) -> Column:
    """A derived value is its text form read as the declared type; when the
    function already returns that type the round trip is the identity."""
    same = {return_kind, out.kind} <= {"string", "char"} or return_kind == out.kind
    if same:
        return result.cast(out.data_type)
    text = result.cast("string")
    value, ok = coerce(text, out.kind)
    if on_error == "fail":
        msg = F.concat(F.lit(f"derived value for {out.name} is not a {out.type_name}: "), text)
        return F.when(~ok, F.raise_error(msg)).otherwise(value).cast(out.data_type)
    return value.cast(out.data_type)
