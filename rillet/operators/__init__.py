from .coerce import coerce
from .parse import bad_rows, good_rows, parse_lines
from .render import list_line, render, row_line, tab_line
from .rules import FieldRef, Literal, Rule, apply_rules, compile_rules, parse_argument, parse_rules
from .sql_stage import ansi_mode, run_sql, stringify
from .union import split_tagged, tagged_union
from .windows import (SlideStage, duration_us, explode_windows, staged_windowed_sql, window_agg,
                      window_column, window_stats, windowed_sql)

__all__ = [
    "FieldRef", "Literal", "Rule", "SlideStage", "ansi_mode", "apply_rules", "bad_rows", "coerce",
    "compile_rules", "duration_us", "explode_windows", "good_rows", "list_line", "parse_argument",
    "parse_lines", "parse_rules", "render", "row_line", "run_sql", "split_tagged",
    "staged_windowed_sql", "stringify", "tab_line", "tagged_union", "window_agg", "window_column",
    "window_stats", "windowed_sql",
]
