"""Shared pieces of the corpus operators."""

from __future__ import annotations

import ctypes

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir


def sha256_hex(col: Column) -> Column:
    """Lowercase hex digest of a string's UTF-8 bytes."""
    return F.sha2(F.encode(col, "UTF-8"), 256)


def cut(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    The copy survives lost executors and ends the lineage, so a later job does
    not compute ``df`` again.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Gives memory that this process has freed, but Arrow's pool and the C library keep
    for later, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):  # not the GNU library
        pass


def quota(sizes: list[int], total: int) -> int:
    """Rows that each class may give at most so that all together give about ``total``:
    classes of fewer rows give all of theirs, and the others share what is left evenly."""
    left = total
    for i, n in enumerate(sorted(sizes)):
        even = left // (len(sizes) - i)
        if n > even:
            return max(1, even)
        left -= n
    return max(sizes, default=0)


HASH_RANGE = 1 << 30


def class_sample(rows: DataFrame, label: str, sizes: dict, most: int) -> DataFrame:
    """Distinct texts of every class (value of ``label``): all of a class with up to ``most``
    of them (``sizes`` has the numbers), about ``most`` of a larger one.

    ``rows`` has the text's 64-bit hash as ``full``; it picks the same texts everywhere. Adds
    ``h``, a hash below ``HASH_RANGE`` times the class's share. Copies count once, so neither
    a class nor the size of the sample hangs on one text.
    """
    picked = rows.withColumn("h", F.pmod("full", F.lit(HASH_RANGE)))
    cuts = {c: max(1, int(most / n * HASH_RANGE)) for c, n in sizes.items() if n > most}
    if cuts:
        at = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
        picked = picked.filter(F.col("h") < F.coalesce(at[F.col(label)], F.lit(HASH_RANGE)))
    return picked.dropDuplicates([label, "full"])


def spread(rows: DataFrame, key: str) -> DataFrame:
    """Few rows that cost much each, dealt over all cores whatever their bytes."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)


def map_frame(df: DataFrame, func, schema: str) -> DataFrame:
    """``func(DataFrame) -> DataFrame`` over Arrow batches of ``df``."""
    def run(batches):
        for batch in batches:
            yield func(batch)
    return df.mapInPandas(run, schema)


def split_buckets(rows: DataFrame, keys: list[str], item: str, block: int, some: str | None = None) -> DataFrame:
    """Buckets of ``rows`` cut into bounded pieces that together hold every pair.

    A bucket (rows equal in ``keys``) of n > 1 rows is dealt by the hash of
    ``item`` into ``nb = ceil(n / block)`` blocks. Each row goes to every piece
    (i, j), i <= j, of its own block, so two rows of a bucket meet in a piece of
    about ``2 * block`` rows at most, whatever the size of the bucket. Buckets of
    one row are left out, and those where no row has ``some`` (if named). Adds columns ``nb``, ``pi``, ``pj`` and ``own`` (the
    row's block).
    """
    any_ = F.max(some) if some else F.lit(True)
    sizes = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), any_.alias("__some")).filter("__n > 1 AND __some")
             .withColumn("nb", F.ceil(F.col("__n") / F.lit(block)).cast("int")).drop("__n", "__some"))
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    met = rows.alias("r").join(sizes.alias("s"), cond).select("r.*", "s.nb")
    own = F.pmod(F.xxhash64(F.col(item)), F.col("nb")).cast("int")
    met = met.withColumn("own", own)
    met = met.withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    return (met.withColumn("pi", F.least("own", "__o")).withColumn("pj", F.greatest("own", "__o"))
            .drop("__o"))


def each_group(df: DataFrame, keys: list[str], func, schema: str) -> DataFrame:
    """``func(group) -> list of result rows`` for each run of rows equal in ``keys``,
    where ``group`` maps column names to numpy arrays.

    Rows are dealt and sorted by ``keys`` (no nulls in them) and streamed in batches;
    one group is held at a time. Meant for very many small groups, where one Python
    call per group and batch of Arrow would cost more than the work itself.
    """
    dealt = df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    names = [f.split()[0] for f in schema.split(",")]

    def run(batches):
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            cols = {c: batch[c].to_numpy() for c in batch.columns}
            new = np.zeros(len(batch), dtype=bool)
            for k in keys:
                new[1:] |= cols[k][1:] != cols[k][:-1]
            starts = [0, *new.nonzero()[0].tolist()]
            out = []
            for a, b in zip(starts[:-1], starts[1:]):
                out += func({c: v[a:b] for c, v in cols.items()})
            if out:
                yield pd.DataFrame(out, columns=names)
            rest = batch.iloc[starts[-1]:]
        if rest is not None:
            out = func({c: rest[c].to_numpy() for c in rest.columns})
            if out:
                yield pd.DataFrame(out, columns=names)

    return dealt.mapInPandas(run, schema)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long): rows ``node, component``
    with the smallest node of each component; only nodes with an edge appear.

    Alternating large-star and small-star rounds: each round re-links a node's
    larger neighbours, then its smaller ones, to the smallest neighbour. All
    rounds are joins and grouped minima; each is written to the shared scratch
    folder, and only a row count and a checksum come to the driver.
    """
    spark = edges.sparkSession
    e = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e, "edges")
    before = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").filter("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(small_low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
