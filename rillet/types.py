"""Declared field types: type names, Spark types and ordered schemas.

A schema is an ordered list of ``(field name, type name)`` pairs, given as a
``dict``, a list of pairs, JSON text, or a ``StructType``. Type names are
case-sensitive; the boxed and primitive spellings of one type are synonyms.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# The accepted type names and the kind each one denotes.
# Kinds are what function signatures are matched on; the Spark type follows the kind.
TYPE_KINDS = {
    "String": "string",
    "Integer": "int", "int": "int",
    "Long": "long", "long": "long",
    "Float": "float", "float": "float",
    "Double": "double", "double": "double",
    "Boolean": "boolean", "boolean": "boolean",
    "Byte": "byte", "byte": "byte",
    "Short": "short", "short": "short",
    "Character": "char", "char": "char",
}

KIND_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "byte": T.ByteType(),
    "short": T.ShortType(),
    "char": T.StringType(),
}

_SPARK_TYPE_KINDS = {
    T.StringType(): "string",
    T.IntegerType(): "int",
    T.LongType(): "long",
    T.FloatType(): "float",
    T.DoubleType(): "double",
    T.BooleanType(): "boolean",
    T.ByteType(): "byte",
    T.ShortType(): "short",
}


class SchemaError(ValueError):
    """A schema, rule or setting that cannot be planned."""


def kind_of(type_name: str) -> str:
    """Kind of a declared type name; unknown names (``void``, ``string``...) are rejected."""
    try:
        return TYPE_KINDS[type_name]
    except KeyError:
        raise SchemaError(f"unsupported type name {type_name!r}") from None


def spark_type(kind: str) -> T.DataType:
    return KIND_SPARK_TYPES[kind]


@dataclass(frozen=True)
class Field:
    name: str
    type_name: str

    @property
    def kind(self) -> str:
        return kind_of(self.type_name)

    @property
    def data_type(self) -> T.DataType:
        return spark_type(self.kind)


@dataclass(frozen=True)
class Schema:
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def __iter__(self):
        return iter(self.fields)

    def __len__(self) -> int:
        return len(self.fields)

    def __contains__(self, name: object) -> bool:
        return any(f.name == name for f in self.fields)

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise SchemaError(f"no field {name!r} in schema {self.names}")

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type, True) for f in self.fields])


def as_schema(spec: Schema | Mapping[str, str] | Iterable | str | T.StructType) -> Schema:
    """Normalise any accepted schema form; every type name is checked here, at plan time."""
    if isinstance(spec, Schema):
        return spec
    if isinstance(spec, str):
        spec = json.loads(spec)  # JSON object text keeps its key order
    if isinstance(spec, T.StructType):
        pairs = []
        for sf in spec.fields:
            if sf.dataType not in _SPARK_TYPE_KINDS:
                raise SchemaError(f"unsupported Spark type {sf.dataType} for {sf.name!r}")
            kind = _SPARK_TYPE_KINDS[sf.dataType]
            pairs.append((sf.name, next(n for n, k in TYPE_KINDS.items() if k == kind)))
    elif isinstance(spec, Mapping):
        pairs = list(spec.items())
    else:
        pairs = [tuple(p) for p in spec]
    fields = []
    seen = set()
    for name, type_name in pairs:
        if name in seen:
            raise SchemaError(f"field {name!r} declared twice")
        seen.add(name)
        kind_of(type_name)
        fields.append(Field(str(name), str(type_name)))
    if not fields:
        raise SchemaError("a schema needs at least one field")
    return Schema(tuple(fields))


def infer_schema(struct: T.StructType) -> Schema:
    """Schema of the columns whose Spark type has a declared-type equivalent."""
    return as_schema(T.StructType([sf for sf in struct.fields if sf.dataType in _SPARK_TYPE_KINDS]))
