"""Results of windows as a versioned set.

Every run over a set of windows writes its rows, with the window's end in ``_wend``
(microseconds), into a folder of its own, ``_attempt=A``, and then commits: one line a window,
with the attempt and its number of rows, zero too, appended as one file to the folder
``<path>_commits``. A read follows the commits: for each window the latest attempt alone
counts. So a window whose new run gives no row has no result any more, a run that ended
between writing and committing is not seen, and a reader never meets half of a run. A run
writes few files however many windows it covers.

Attempts of which no window counts any more are deleted after a commit, and with them what
runs left that never committed; a reader that began before may have to read again.
``compact`` brings the windows that count into one attempt. One writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WEND = "_wend"
ATTEMPT = "_attempt"
_COMMIT = "wend long, attempt string, rows long, schema string"


class WindowResults:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = f"{self.path}_commits"
        self._next: int | None = None

    # -- files ------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _exists(self, path: str) -> bool:
        fs, where = self._fs(path)
        return fs.exists(where)

    def _delete(self, path: str) -> None:
        fs, where = self._fs(path)
        fs.delete(where, True)

    def _names(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    # -- commits ------------------------------------------------------------
    def commits(self) -> DataFrame:
        """All commits: ``wend, attempt, rows, schema``; attempts sort in the order they began."""
        if not self._exists(self.log):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).json(self.log)

    def current(self) -> DataFrame:
        """The commit that counts for each window, those without rows included."""
        last = F.max_by(F.struct("attempt", "rows", "schema"), F.col("attempt")).alias("last")
        return self.commits().groupBy("wend").agg(last).select("wend", "last.*")

    # -- writing ------------------------------------------------------------
    def write(self, rows: DataFrame, ends: list[int]) -> dict[int, int]:
        """Write ``rows`` (with a column ``_wend``) as the results of the windows that end at
        ``ends``, which replaces what these had. Returns the number of rows of each window."""
        attempt = self.stage(rows)
        return self.commit(attempt, rows.schema, ends)

    def stage(self, rows: DataFrame) -> str:
        """Write without committing."""
        if self._next is None:
            last = self.commits().agg(F.max("attempt")).first()[0]
            self._next = int(last.split("-")[0]) + 1 if last else 0
        # names of one length: they sort by number, and two that a crash lets begin at the
        # same number do not share a folder
        attempt = f"{self._next:012d}-{uuid.uuid4().hex[:8]}"
        self._next += 1
        rows.write.parquet(self._folder(attempt))
        return attempt

    def commit(self, attempt: str, schema: T.StructType, ends: list[int]) -> dict[int, int]:
        found = self.spark.read.schema(schema).parquet(self._folder(attempt)).groupBy(WEND).count().collect()
        rows = dict.fromkeys(ends, 0) | {r[0]: r[1] for r in found}
        text = T.StructType([f for f in schema.fields if f.name != WEND]).json()
        (self.spark.createDataFrame([(e, attempt, n, text) for e, n in rows.items()], _COMMIT)
             .coalesce(1).write.mode("append").json(self.log))
        self.clean()
        return rows

    def clean(self) -> int:
        """Delete the attempts that no commit counts. Returns how many."""
        live = self._live(self.current())
        dead = [n for n in self._names(self.path) if n.startswith(f"{ATTEMPT}=") and n.partition("=")[2] not in live]
        for name in dead:
            self._delete(f"{self.path}/{name}")
        return len(dead)

    def compact(self) -> None:
        """Write the results that count as one attempt."""
        ends = [r[0] for r in self.current().filter("rows > 0").select("wend").collect()]
        if ends:
            self.write(self._rows(self.current()), ends)

    def _folder(self, attempt: str) -> str:
        return f"{self.path}/{ATTEMPT}={attempt}"

    def _live(self, current: DataFrame) -> set[str]:
        return {r[0] for r in current.filter("rows > 0").select("attempt").distinct().collect()}

    def _ends(self, ends: list[int]) -> DataFrame:
        return self.spark.createDataFrame([(e,) for e in ends], "wend long")

    # -- reading ------------------------------------------------------------
    def read(self, ends: list[int] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The current results, of all windows or of those that end at ``ends``, without the
        bookkeeping columns. ``schema`` is that of the results where nothing is committed yet."""
        current = self.current()
        if ends is not None:
            current = current.join(self._ends(ends), "wend")
        return self._rows(current, schema).drop(WEND)

    def _rows(self, current: DataFrame, schema: T.StructType | None = None) -> DataFrame:
        last = self.commits().agg(F.max_by("schema", "attempt")).first()[0]
        if last is not None:
            schema = T.StructType.fromJson(json.loads(last))
        if schema is None:
            raise FileNotFoundError(f"no window results at {self.path}")
        stored = T.StructType([*schema.fields, T.StructField(WEND, T.LongType())])
        live = self._live(current)
        if not live:
            return self.spark.createDataFrame([], stored)
        rows = (self.spark.read.schema(T.StructType([*stored.fields, T.StructField(ATTEMPT, T.StringType())]))
                .option("basePath", self.path).parquet(*[self._folder(a) for a in sorted(live)]))
        kept = current.filter("rows > 0").select(F.col("attempt").alias(ATTEMPT), F.col("wend").alias(WEND))
        return rows.join(kept, [ATTEMPT, WEND], "left_semi").select(*[F.col(f"`{c}`") for c in stored.fieldNames()])


def read_window_results(spark: SparkSession, path: str) -> DataFrame:
    """The current results written to ``path`` by a stream's window SQL."""
    return WindowResults(spark, path).read()
