"""Exact top-k search with vector-approximation files.

The approximation file is built once: a row for every vector, with one small cell
number a component in place of the component (cells of equal width between the vector's
least and greatest component). A scan of the cells gives, for each query, a lower and an
upper bound of every candidate's inner product. The k-th largest lower bound rules
nearly all candidates out; the exact vectors of the others are read in the order of
their bounds: those with the best ones first, then only those whose bound reaches the
k-th best score found.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_QUERIES, BLOCK_VECTORS, AT_ONCE = 4096, 32_768, 64
CROWD = 512  # candidates of a query in one block, beyond which the block is searched exactly


def approximate(exact: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``low, width, codes`` of integer vectors: a component lies in ``low + width * code`` and
    the ``width - 1`` integers above it."""
    low = exact.min(axis=1)
    width = (exact.max(axis=1) - low) // cells + 1
    return low, width, ((exact - low[:, None]) // width[:, None]).astype(np.uint8)


class VaFile:
    """Approximations of integer vectors of one length."""

    def __init__(self, low: np.ndarray, width: np.ndarray, codes: np.ndarray):
        self.low, self.width, self.codes = low.astype(np.float64), width.astype(np.float64), codes.astype(np.float64)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products, queries x vectors."""
        q = queries.astype(np.float64)
        least = (q @ self.codes.T) * self.width + q.sum(axis=1)[:, None] * self.low
        # rounding of the float sums stays far below this slack
        most = np.abs(self.low) + self.width * (1 + self.codes.max(axis=1, initial=0))
        slack = 1e-12 * np.abs(q).sum(axis=1)[:, None] * most
        return (least + q.clip(None, 0).sum(axis=1)[:, None] * (self.width - 1) - slack,
                least + q.clip(0).sum(axis=1)[:, None] * (self.width - 1) + slack)

    def scan(self, queries: np.ndarray, own: np.ndarray, k: int):
        """For each query the positions that may be among its ``k`` best, with both bounds,
        without the row at position ``own`` (-1: none of these)."""
        for a in range(0, len(queries), AT_ONCE):
            low, high = self.bounds(queries[a:a + AT_ONCE])
            for i in range(len(low)):
                mine = own[a + i]
                if mine >= 0:
                    low[i, mine] = high[i, mine] = -np.inf
                n = low.shape[1] - (mine >= 0)
                take = min(k, n)
                least = np.partition(low[i], -take)[-take] if take else np.inf
                left = np.flatnonzero(high[i] >= least)
                yield left, low[i, left], high[i, left]


def sound(vector: Column) -> Column:
    """True for vectors without null or non-finite components (null vectors: false)."""
    return F.coalesce(vector.isNotNull()
                      & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), dim)


def _places(uids: pd.Series, asked: pd.Series) -> np.ndarray:
    at = {u: i for i, u in enumerate(uids.tolist())}
    return np.array([at.get(u, -1) for u in asked.tolist()], dtype=np.int64)


class Search:
    """One search: the exact table, the approximation file and what a scan of it leaves.

    ``rows(id, uid, dim, x, q)``: the exact vectors; ``codes``: the file; ``left(quid, cuid, low,
    high)``: pairs of query and candidate that the bounds do not settle; ``crowded(quid, shard)``:
    blocks where over ``CROWD`` candidates of a query are left (near copies of one vector), to
    be searched exactly.
    """

    def __init__(self, vectors: DataFrame, queries: Column, k: int, scale: float, vec_id: str, embedding: str,
                 cells: int):
        x = F.transform(F.col(embedding).cast("array<double>"), lambda v: F.floor(v * F.lit(scale)).cast("long"))
        rows = (vectors.withColumn("__q", F.coalesce(queries, F.lit(False)))
                .filter(F.col(vec_id).isNotNull() & sound(F.col(embedding)))
                .select(F.col(vec_id).cast("long").alias("id"), x.alias("x"), F.col("__q").alias("q"),
                        F.size(embedding).alias("dim"), F.monotonically_increasing_id().alias("uid")))
        self.k = k
        self.rows = rows = cut(rows, "vectors")  # the row numbers must not change from here on
        nq = rows.agg(F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()[0]

        # of equal vectors only the k + 1 first ones can be among the k best of any query
        equal = Window.partitionBy("x").orderBy("id", "uid")
        first = rows.withColumn("copy", F.row_number().over(equal)).filter(F.col("copy") <= k + 1)

        def encode(batches):
            for batch in batches:
                for dim, part in batch.groupby("dim"):
                    if dim:
                        low, width, codes = approximate(_matrix(part["x"], dim), cells)
                    else:
                        low, width, codes = (np.zeros(len(part), dtype=np.int64), np.ones(len(part), dtype=np.int64),
                                             np.zeros((len(part), 0), dtype=np.uint8))
                    yield pd.DataFrame({"cuid": part["uid"].to_numpy(), "dim": part["dim"].to_numpy(), "low": low,
                                        "width": width, "code": [c.tobytes() for c in codes]})

        self.codes = codes = cut(first.select("uid", "dim", "x").mapInPandas(
            encode, "cuid long, dim int, low long, width long, code binary"), "vafile")
        shards = max(1, -(-codes.count() // BLOCK_VECTORS))
        blocks = max(1, -(-nq // BLOCK_QUERIES))
        self.shard = lambda uid: F.pmod(F.xxhash64(uid), F.lit(shards)).cast("int")
        self.block = lambda uid: F.pmod(F.xxhash64(uid, F.lit(1)), F.lit(blocks)).cast("int")
        asked = rows.filter("q").select(F.col("uid").alias("quid"), F.col("id").alias("query_id"), F.col("x").alias("qx"),
                                        "dim")
        ours = asked.drop("query_id").withColumn("qblock", self.block("quid")).withColumn(
            "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        # names of its own on the other side: the two sides come from one table
        theirs = codes.select("cuid", F.col("dim").alias("cdim"), "low", "width", "code", self.shard("cuid").alias("cshard"),
                              F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cblock"))

        def scan(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(q) and len(c):
                dim, shard = int(q["dim"].iloc[0]), int(q["shard"].iloc[0])
                code = np.frombuffer(b"".join(c["code"]), dtype=np.uint8).reshape(len(c), dim)
                file = VaFile(c["low"].to_numpy(), c["width"].to_numpy(), code)
                cuid = c["cuid"].to_numpy()
                found = file.scan(_matrix(q["qx"], dim), _places(c["cuid"], q["quid"]), k)
                for quid, (left, low, high) in zip(q["quid"].tolist(), found):
                    if len(left) > CROWD:
                        out.append((quid, None, None, None, shard))
                    else:
                        out += [(quid, u, a, b, None) for u, a, b in zip(cuid[left].tolist(), low.tolist(), high.tolist())]
            made = pd.DataFrame(out, columns=["quid", "cuid", "low", "high", "shard"])
            return made.astype({"quid": "int64", "cuid": "Int64", "low": "float64", "high": "float64", "shard": "Int32"})

        found = cut(ours.groupBy("dim", "shard", "qblock").cogroup(theirs.groupBy("cdim", "cshard", "cblock"))
                    .applyInPandas(scan, "quid long, cuid long, low double, high double, shard int"), "vascan")
        self.asked, self.crowded = asked, found.filter("shard IS NOT NULL").select("quid", "shard")
        pairs = found.filter("shard IS NULL").select("quid", "cuid", "low", "high")
        # the k-th largest lower bound over all blocks settles most of what single blocks leave
        nth = Window.partitionBy("quid").orderBy(F.desc("low"), "cuid")
        sure = (pairs.withColumn("nth", F.row_number().over(nth)).filter(F.col("nth") <= k).groupBy("quid")
                .agg(F.when(F.count(F.lit(1)) == k, F.min("low")).alias("sure")))
        near = Window.partitionBy("quid").orderBy(F.desc("high"), "cuid")
        self.left = cut(pairs.join(sure, "quid").filter("sure IS NULL OR high >= sure")
                        .withColumn("place", F.row_number().over(near)).drop("sure"), "valeft")

    def read(self, pairs: DataFrame) -> DataFrame:
        """``quid, cuid, vec_id, score``: exact scores of pairs of query and candidate."""
        x = self.rows.select(F.col("uid").alias("cuid"), F.col("id").alias("vec_id"), "x")
        score = F.aggregate(F.zip_with("x", "qx", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, v: s + v)
        return (x.join(pairs.select("quid", "cuid"), "cuid").join(self.asked.select("quid", "qx"), "quid")
                .select("quid", "cuid", "vec_id", score.alias("score")))

    def search_crowded(self) -> DataFrame:
        """The best of the crowded blocks, by their exact vectors."""
        k = self.k
        ours = (self.crowded.join(self.asked, "quid").withColumn("qblock", self.block("quid")))
        met = ours.select(F.col("dim").alias("cdim"), F.col("shard").alias("cshard"), F.col("qblock").alias("cblock")).distinct()
        exact = self.rows.select(F.col("uid").alias("cuid"), F.col("id").alias("cid"), F.col("x").alias("cx"))
        theirs = (self.codes.select("cuid", F.col("dim").alias("cdim"), self.shard("cuid").alias("cshard"))
                  .join(met, ["cdim", "cshard"]).join(exact, "cuid"))

        def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(q) and len(c):
                dim = int(q["dim"].iloc[0])
                vectors, asked = _matrix(c["cx"], dim), _matrix(q["qx"], dim)
                ids, uids, own = c["cid"].to_numpy(), c["cuid"].to_numpy(), _places(c["cuid"], q["quid"])
                for i, quid in enumerate(q["quid"].tolist()):
                    score = vectors @ asked[i]
                    best = [j for j in np.lexsort((ids, -score))[:k + 1].tolist() if j != own[i]][:k]
                    out += [(quid, int(uids[j]), int(ids[j]), int(score[j])) for j in best]
            return pd.DataFrame(out, columns=["quid", "cuid", "vec_id", "score"], dtype=np.int64)

        return (ours.groupBy("dim", "shard", "qblock").cogroup(theirs.groupBy("cdim", "cshard", "cblock"))
                .applyInPandas(search, "quid long, cuid long, vec_id long, score long"))

    def best(self) -> DataFrame:
        k = self.k
        order = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "cuid")
        early = self.read(self.left.filter(F.col("place") <= 2 * k))
        if not self.crowded.isEmpty():
            early = early.unionByName(self.search_crowded())
        early = cut(early, "vabest")
        sure = (early.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k).groupBy("quid")
                .agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("sure")))
        late = self.left.filter(F.col("place") > 2 * k).join(sure, "quid", "left").filter("sure IS NULL OR high >= sure")
        return (early.unionByName(self.read(late)).withColumn("rank", F.row_number().over(order))
                .filter(F.col("rank") <= k).join(self.asked.select("quid", "query_id"), "quid")
                .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id",
            embedding: str = "embedding", cells: int = 128) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``queries`` holds, the ``k`` other
    rows with the largest inner product of ``floor(scale * x)`` vectors, ties to the smaller
    vec_id; fewer if there are fewer.

    Null vectors, rows without vec_id and vectors holding null or non-finite components
    take no part. Vectors of different length are not compared. Repeated rows are rows of
    their own; of equal vectors the ``k + 1`` with the smallest vec_id are candidates, as no
    other can be among the best. Scores must fit a long. An empty table gives no rows.
    Queries and approximations (``cells`` values, at most 256, a byte a component) meet in a
    grid of bounded blocks; exact vectors are joined for what the bounds leave. Near
    copies that bounds cannot tell apart in a block are searched there exactly.
    """
    return Search(vectors, queries, k, scale, vec_id, embedding, cells).best()
