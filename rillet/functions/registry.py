"""Rule functions: ``(namespace, name, argument kinds) -> Column builder``.

A rule names a class and a method; here the class is a namespace looked up by
its full name (a class registered without a package answers for any package; a
name asked for without one must be unambiguous), and the method is resolved
against the argument kinds **once, when the plan is built**. Boxed and
primitive spellings share one kind, matching is exact (no widening).

Functions are ordinary Column builders, so built-in ones compile to Catalyst
expressions. Custom logic can be added as a vectorised ``pandas_udf``
(:meth:`FunctionRegistry.register_pandas`), as any function known to Spark
SQL, for example a JVM UDF registered with ``spark.udf.registerJavaFunction``
(:meth:`FunctionRegistry.register_sql`), or needs no registration at all: a full class
name that is not registered is looked for on Spark's class path, and its public static
method is called in the JVM (:func:`jvm_method`).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..types import SchemaError, kind_of, spark_type


@dataclass(frozen=True)
class FunctionDef:
    namespace: str
    name: str
    arg_kinds: tuple[str, ...]
    return_kind: str
    build: Callable[..., Column]

    def signature(self) -> str:
        return f"{self.namespace}.{self.name}({', '.join(self.arg_kinds)}) -> {self.return_kind}"


def simple_name(namespace: str) -> str:
    return namespace.rsplit(".", 1)[-1]


# The kinds that a JVM method can take, as Spark's reflect passes them.
_JVM_KINDS = ("boolean", "byte", "short", "int", "long", "float", "double", "string")


def jvm_method(class_name: str, name: str, arg_kinds: Sequence[str]) -> FunctionDef:
    """A public static method of a class on Spark's class path (``--jars`` and the like), found by
    the argument kinds (boxed or primitive parameters). Its result arrives as text and is
    read as the output field's declared type. A class or method that Spark does not find,
    asked here when the plan is built, is a :class:`~rillet.types.SchemaError`."""
    kinds = tuple("string" if k == "char" else k for k in arg_kinds)

    def build(*cols: Column) -> Column:
        return F.call_function("reflect", F.lit(class_name), F.lit(name), *cols)

    spark = SparkSession.getActiveSession()
    if spark is None or not set(kinds) <= set(_JVM_KINDS):
        raise SchemaError(f"unknown function class {class_name!r}")
    try:
        spark.range(1).select(build(*[F.lit(None).cast(spark_type(k)) for k in kinds]))
    except AnalysisException as e:
        shown = f"{class_name}.{name}({', '.join(arg_kinds)})"
        raise SchemaError(f"unknown function class or no public static method {shown}: "
                          f"{e.getCondition() or e}") from None
    return FunctionDef(class_name, name, tuple(arg_kinds), "string", build)


class FunctionRegistry:
    """``jvm_classes``: whether rules may name classes on Spark's class path."""

    def __init__(self, jvm_classes: bool = True) -> None:
        self._defs: dict[tuple[str, str, tuple[str, ...]], FunctionDef] = {}
        self.jvm_classes = jvm_classes

    def copy(self) -> FunctionRegistry:
        other = FunctionRegistry(self.jvm_classes)
        other._defs = dict(self._defs)
        return other

    def register(self, namespace: str, name: str, arg_types: Sequence[str], return_type: str,
                 build: Callable[..., Column]) -> FunctionDef:
        """Register a Column builder; types are type names such as ``"Integer"`` or ``"int"``."""
        kinds = tuple(kind_of(t) for t in arg_types)
        fdef = FunctionDef(namespace, name, kinds, kind_of(return_type), build)
        self._defs[(fdef.namespace, name, kinds)] = fdef
        return fdef

    def register_pandas(self, namespace: str, name: str, arg_types: Sequence[str],
                        return_type: str, fn: Callable) -> FunctionDef:
        """Register a vectorised function of pandas Series (Arrow batches, not rows)."""
        udf = F.pandas_udf(fn, spark_type(kind_of(return_type)))
        return self.register(namespace, name, arg_types, return_type, lambda *cols: udf(*cols))

    def register_sql(self, namespace: str, name: str, arg_types: Sequence[str],
                     return_type: str, sql_function: str) -> FunctionDef:
        """Register a function callable from Spark SQL (built-in, or a registered JVM UDF)."""
        return self.register(namespace, name, arg_types, return_type,
                             lambda *cols: F.call_function(sql_function, *cols))

    def namespaces(self) -> set[str]:
        return {ns for ns, _, _ in self._defs}

    def _find(self, namespace: str) -> str:
        """The registered namespace a rule's class names: the same full name, or one
        registered (or asked for) without a package, if only one class can be meant."""
        known = self.namespaces()
        if namespace in known:
            return namespace
        short = simple_name(namespace)
        if short != namespace:  # a full name: only a class registered without package can be it
            found = [short] if short in known else []
        else:
            found = sorted(n for n in known if simple_name(n) == short)
        if len(found) > 1:
            raise SchemaError(f"function class {namespace!r} is ambiguous: {found}")
        if not found:
            raise SchemaError(f"unknown function class {namespace!r}")
        return found[0]

    def resolve(self, namespace: str, name: str, arg_kinds: Sequence[str]) -> FunctionDef:
        try:
            ns = self._find(namespace)
        except SchemaError:
            if self.jvm_classes and "." in namespace:
                return jvm_method(namespace, name, arg_kinds)
            raise
        fdef = self._defs.get((ns, name, tuple(arg_kinds)))
        if fdef is None:
            known = sorted(d.signature() for (n, m, _), d in self._defs.items()
                           if n == ns and m == name)
            raise SchemaError(f"no method {ns}.{name}({', '.join(arg_kinds)}); "
                              f"known: {known or 'none'}")
        return fdef
