from .flow import DEFAULT_EXTRA_SQL, EXTRA_INPUT, INPUT, OUTPUT, LogFlow

__all__ = ["DEFAULT_EXTRA_SQL", "EXTRA_INPUT", "INPUT", "LogFlow", "OUTPUT"]
