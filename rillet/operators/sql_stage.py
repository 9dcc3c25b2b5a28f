"""Running user SQL text over named DataFrames.

The text is handed to Spark SQL unchanged; Catalyst plans it, also where it is to be run
for many groups of rows at once (:func:`run_sql_each`). Views are
registered in the session of the DataFrames just before the text is analysed.
An analysed DataFrame keeps its resolved plan, so later re-registration of the
same view names does not change a DataFrame returned earlier.

``ansi=False`` (the default) analyses the text with ANSI mode off, the
lenient coercion user SQL of this kind was written for: ``SUM`` over text such
as ``'1000 MB'`` is null rather than an error. The mode is captured at
analysis, and the session setting is restored afterwards.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ANSI = "spark.sql.ansi.enabled"
_lock = threading.RLock()


@contextmanager
def borrowed_settings(spark: SparkSession, settings: Mapping[str, str]):
    """Session settings used for a while; the ones before are back afterwards."""
    with _lock:
        before = {k: spark.conf.get(k) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)


def ansi_mode(spark: SparkSession, enabled: bool):
    return borrowed_settings(spark, {_ANSI: "true" if enabled else "false"})


def run_sql(views: Mapping[str, DataFrame], text: str, ansi: bool = False,
            spark: SparkSession | None = None) -> DataFrame:
    """Register ``views`` as temp views and analyse ``text`` against them."""
    if spark is None:
        if not views:
            raise ValueError("run_sql needs views or a session")
        spark = next(iter(views.values())).sparkSession
    with ansi_mode(spark, ansi):
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return spark.sql(text)


@contextmanager
def borrowed_views(spark: SparkSession, names):
    """Temp view names used for a while: the caller's own views of these names are
    back afterwards, and names that were free are free again."""
    with _lock:
        names = list(names)
        temporary = {r.viewName.lower() for r in spark.sql("SHOW VIEWS").collect() if r.isTemporary}
        before = {n: spark.table(f"`{n}`") if n.lower() in temporary else None for n in names}
        try:
            yield
        finally:
            for name, df in before.items():
                if df is None:
                    spark.catalog.dropTempView(name)
                else:
                    df.createOrReplaceTempView(name)


def referenced_views(views: Mapping[str, DataFrame], text: str,
                     spark: SparkSession | None = None, ansi: bool = False) -> set[str]:
    """The names in ``views`` that ``text`` reads, by its EXPLAIN. Nothing is run; functions and
    views of the session can be used in the text, and the session's own views are left as
    they were. Pass cheap stand-ins (empty DataFrames with the views' schemas)."""
    if spark is None:
        spark = next(iter(views.values())).sparkSession
    with borrowed_views(spark, views), ansi_mode(spark, ansi):
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        spark.sql(text)  # what is wrong with the text itself is raised here
        plan = spark.sql(f"EXPLAIN EXTENDED {_statement(text)}").first()[0].lower()
    # names as Spark resolves them, without regard to case
    return {name for name in views if f"view (`{name.lower()}`" in plan}


def run_sql_each(groups: DataFrame, views: Mapping[str, DataFrame], key: str, text: str,
                 ansi: bool = False) -> DataFrame:
    """``text`` run for every row of ``groups`` in one plan: the row's columns, then the text's.

    For a row, each view holds the rows that are equal in ``key`` (a column of ``groups``
    and of all ``views`` that the text does not see). The text is used unchanged, as a
    correlated subquery whose views are named in a WITH in front of it; Spark turns the
    equality into a grouping or join on ``key``, and a LIMIT into a ranking by it.
    See :func:`runs_each` for the texts that Spark can take this way.
    """
    spark = groups.sparkSession
    stored = {name: f"__rillet_rows_{i}" for i, name in enumerate(views)}
    with borrowed_views(spark, [_GROUPS, *stored.values()]), ansi_mode(spark, ansi):
        groups.createOrReplaceTempView(_GROUPS)
        named = []
        for name, df in views.items():
            df.createOrReplaceTempView(stored[name])
            columns = ", ".join(quote(c) for c in df.columns if c != key)
            named.append(f"{quote(name)} AS (SELECT {columns} FROM {stored[name]} {_ROW} WHERE {_ROW}.{quote(key)} = {_GROUP}.{quote(key)})")
        shown = ", ".join(f"{_GROUP}.{quote(c)}" for c in groups.columns if c != key)
        return spark.sql(f"SELECT {shown}, {_RESULT}.* FROM {_GROUPS} {_GROUP}, LATERAL (WITH {', '.join(named)} "
                         f"SELECT * FROM (\n{_statement(text)}\n)) {_RESULT}")


def run_sql_rows(rows: DataFrame, name: str, keep: str, text: str, ansi: bool = False) -> DataFrame:
    """A ``text`` that handles each row of its view ``name`` by itself (:func:`is_row_wise`), with
    the column ``keep`` of the row in front of what it makes of it. The view is the one row
    that stands outside, so a projection stays a projection."""
    spark = rows.sparkSession
    with borrowed_views(spark, [_GROUPS]), ansi_mode(spark, ansi):
        rows.createOrReplaceTempView(_GROUPS)
        row = ", ".join(f"{_GROUP}.{quote(c)} AS {quote(c)}" for c in rows.columns)
        return spark.sql(f"SELECT {_GROUP}.{quote(keep)}, {_RESULT}.* FROM {_GROUPS} {_GROUP}, LATERAL (WITH {quote(name)} AS "
                         f"(SELECT {row}) SELECT * FROM (\n{_statement(text)}\n)) {_RESULT}")


def runs_each(schemas: Mapping[str, T.StructType], text: str, spark: SparkSession, ansi: bool = False) -> bool:
    """Whether :func:`run_sql_each` can run ``text`` over views of these schemas: not where it
    has outer joins, nested subqueries over the views or ROLLUP. The text is tried on a
    single made-up row, without adaptive planning, which might leave parts of it out."""
    key = "__rillet_key"
    views = {n: _made_up(spark, s, 1).withColumn(key, F.col(_ID)).drop(_ID) for n, s in schemas.items()}
    groups = spark.range(1).select(F.col("id").alias(key), F.col("id").alias("__rillet_group"))
    with borrowed_settings(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "1"}):
        try:
            run_sql_each(groups, views, key, text, ansi).collect()
        except (AnalysisException, Py4JJavaError, PySparkException):
            return False
    return True


def is_row_wise(name: str, schema: T.StructType, text: str, spark: SparkSession, ansi: bool = False) -> bool:
    """Whether ``text`` handles each row of its view ``name`` by itself: its EXPLAIN shows
    nothing but filters, projections and generators."""
    rows = _made_up(spark, schema, 1 << 40).drop(_ID)
    with borrowed_views(spark, [name]), ansi_mode(spark, ansi):
        rows.createOrReplaceTempView(name)
        plan = spark.sql(f"EXPLAIN {_statement(text)}").first()[0]
    steps = {m.group(1) for m in re.finditer(r"^[ :+*()0-9-]*([A-Za-z]+)", plan, re.M)}
    return steps <= {"Project", "Filter", "Generate", "Range", "BatchEvalPython", "ArrowEvalPython"}


_GROUPS, _GROUP, _ROW, _RESULT = "__rillet_groups", "__rillet_group_row", "__rillet_row", "__rillet_result"
_ID = "__rillet_id"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _statement(text: str) -> str:
    return text.strip().rstrip(";").rstrip()


def _made_up(spark: SparkSession, schema: T.StructType, rows: int) -> DataFrame:
    """Rows of ``schema`` (and their number) that Spark cannot work out before they are read."""
    def value(f: T.StructField):
        x = F.col("id")
        if isinstance(f.dataType, (T.TimestampNTZType, T.DateType)):
            x = F.timestamp_micros(x)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(x.cast("string"), f.dataType).alias(f.name)
        elif isinstance(f.dataType, T.BinaryType):
            x = x.cast("string")
        return x.cast(f.dataType).alias(f.name)
    return spark.range(rows).select(F.col("id").alias(_ID), *[value(f) for f in schema.fields])


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text, keeping column order, names and nulls."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
