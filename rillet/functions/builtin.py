"""The six shipped rule functions, as Catalyst expressions.

Integer arithmetic follows the session's ANSI setting: with ANSI on (the
Spark 4 default) an overflow raises instead of wrapping around.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import FunctionRegistry

# The namespace (class simple name) and method names that rule
# files use for the shipped functions.
BUILTIN_NAMESPACE = "MyFunctions"


def register_builtins(registry: FunctionRegistry) -> FunctionRegistry:
    ns = BUILTIN_NAMESPACE
    registry.register(ns, "toUpperCase", ["String"], "String", lambda s: F.upper(s))
    registry.register(ns, "addOne", ["Integer"], "int", lambda n: n + F.lit(1))
    registry.register(ns, "add", ["Integer", "int"], "int", lambda a, b: a + b)
    registry.register(ns, "add", ["String", "String"], "String",
                      lambda a, b: F.concat(a, F.lit(" "), b))
    registry.register(ns, "add", ["Integer", "String"], "String",
                      lambda a, b: F.concat(a.cast("string"), F.lit(" "), b))
    registry.register(ns, "getOriginalStr", ["String"], "String", lambda s: s)
    return registry


def default_registry() -> FunctionRegistry:
    """A fresh registry holding the shipped functions; add your own to it."""
    return register_builtins(FunctionRegistry())
