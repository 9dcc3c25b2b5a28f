"""Rule-driven analytics over raw text records, on Spark DataFrames and Structured Streaming."""

from .functions import FunctionRegistry, default_registry
from .operators import (Rule, SlideStage, apply_rules, bad_rows, explode_windows, good_rows,
                        parse_lines, render, run_sql, stringify, tagged_union, window_agg,
                        window_stats, windowed_sql)
from .plans import LogFlow
from .plans.settings import flow_from_settings
from .session import local_session, scratch_dir
from .sources import kafka_lines, table_lines, text_lines
from .streaming import FlowStream, stream_window_stats
from .types import Schema, SchemaError, as_schema

__all__ = [
    "FlowStream", "FunctionRegistry", "LogFlow", "Rule", "Schema", "SchemaError", "SlideStage",
    "apply_rules", "as_schema", "bad_rows", "default_registry", "explode_windows",
    "flow_from_settings", "good_rows", "kafka_lines", "local_session", "parse_lines", "render",
    "run_sql", "scratch_dir", "stream_window_stats", "stringify", "table_lines", "tagged_union",
    "text_lines", "window_agg", "window_stats", "windowed_sql",
]
