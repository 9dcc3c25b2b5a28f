from .builtin import BUILTIN_NAMESPACE, default_registry, register_builtins
from .registry import FunctionDef, FunctionRegistry

__all__ = ["BUILTIN_NAMESPACE", "FunctionDef", "FunctionRegistry", "default_registry",
           "register_builtins"]
