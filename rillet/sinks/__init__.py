"""Idempotent partitioned sinks, the empty guard and a bounded console echo.

Each micro-batch (or window) writes into its own partition with dynamic
partition overwrite, so a replayed batch id or window replaces its own output
and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.render import render


def write_partition(df: DataFrame, path: str, key: str, value, fmt: str = "parquet") -> None:
    """Write ``df`` as partition ``key=value`` of ``path``, replacing only that partition."""
    (df.withColumn(key, F.lit(value)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy(key).format(fmt).save(path))


def write_lines(df: DataFrame, path: str, key: str, value, form: str = "list") -> None:
    """Rows rendered as text lines (``[a, b]`` list or ``[a,b]`` row form) in one partition."""
    write_partition(render(df, form), path, key, value, fmt="text")


def write_if_rows(df: DataFrame, writer, *args, **kwargs) -> bool:
    """Empty guard: call ``writer(df, ...)`` only when ``df`` has a row."""
    if df.isEmpty():
        return False
    writer(df, *args, **kwargs)
    return True


def echo(df: DataFrame, n: int = 20, label: str | None = None) -> None:
    """Print at most ``n`` rows on the driver (never an unbounded collect)."""
    if label:
        print(label)
    df.show(n, truncate=False)
