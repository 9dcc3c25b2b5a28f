"""Reversible line dedup: sharded cuckoo filters over exact reference counts.

The exact table holds, for every line key and document, how many of the document's
lines have that key. Sharded cuckoo filters stand before it: they answer "surely not
there" without reading it, and take keys out again when a document is deleted, so an
insertion can be undone. What a filter lets through is always settled by the table.

A whole table goes through the same index in increments of rising doc_id: each one's
keys are looked up in the filters of the increments before it, the possible ones are
settled by the exact keys, and the new ones enter both.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
SLOTS = 4
SHARD_KEYS = 50_000


class CuckooFilter:
    """Approximate set of 64-bit keys with deletion: 4-slot buckets of 16-bit
    fingerprints, partial-key displacement. Never forgets a key it holds."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        buckets = 1 << max(1, int(np.ceil(np.log2(max(capacity, 1) / SLOTS / 0.85))))
        self.table = np.zeros((buckets, SLOTS), dtype=np.uint16) if table is None else table
        self.mask = len(self.table) - 1

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(0, np.frombuffer(data, dtype=np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys):
        keys = np.asarray(keys).astype(np.uint64)
        mixed = keys * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        print_ = (mixed & np.uint64(0xFFFF)).astype(np.uint16)
        print_[print_ == 0] = 1
        first = ((mixed >> np.uint64(20)) & np.uint64(self.mask)).astype(np.int64)
        return print_, first, first ^ self._jump(print_)

    def _jump(self, print_):
        return ((np.asarray(print_).astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(self.mask)).astype(np.int64)

    def contains(self, keys) -> np.ndarray:
        p, a, b = self._places(keys)
        return ((self.table[a] == p[:, None]) | (self.table[b] == p[:, None])).any(axis=1)

    def _fill(self, print_, at) -> np.ndarray:
        """Put fingerprints into free slots of their buckets ``at``; True for those that found one."""
        order = np.argsort(at, kind="stable")
        bucket = at[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = bucket[1:] != bucket[:-1]
        begin = np.flatnonzero(new)
        rank = np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))
        taken = self.table[bucket] != 0
        fits = rank < SLOTS - taken.sum(axis=1)
        slot = np.argsort(taken[fits], axis=1, kind="stable")[np.arange(fits.sum()), rank[fits]]
        self.table[bucket[fits], slot] = print_[order[fits]]
        placed = np.zeros(len(at), dtype=bool)
        placed[order[fits]] = True
        return placed

    def insert(self, keys) -> bool:
        """Add keys; False if the filter is too full (rebuild it larger)."""
        table = self.table
        print_, first, second = self._places(keys)
        left = ~self._fill(print_, first)
        print_, second = print_[left], second[left]
        left = ~self._fill(print_, second)
        print_, second = print_[left], second[left]
        for p, at in zip(print_.tolist(), second.tolist()):
            for turn in range(500):
                slot = (p + turn) % SLOTS
                p, table[at, slot] = int(table[at, slot]), p
                at ^= int(self._jump(p))
                free = (table[at] == 0).nonzero()[0]
                if len(free):
                    table[at, free[0]] = p
                    break
            else:
                return False
        return True

    def delete(self, keys) -> None:
        """Take out keys that were inserted."""
        for p, a, b in zip(*(x.tolist() for x in self._places(keys))):
            for at in (a, b):
                hit = (self.table[at] == p).nonzero()[0]
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        room = len(keys)
        while True:
            made = cls(room)
            if made.insert(keys):
                return made
            room = room * 2 + SLOTS


def line_keys(text: str | None, least: int) -> tuple[list[bytes], list[bytes | None]]:
    """Lines of a text and, for lines with ``least`` or more code points, the 128-bit
    digest of their key (blanks stripped, A-Z lower-cased); None for the others."""
    lines = (text or "").encode("utf-8", "replace").split(b"\n")
    keys: list[bytes | None] = []
    for line in lines:
        key = line.strip(BLANKS).lower()
        enough = len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8")) >= least)
        keys.append(xxhash.xxh3_128_digest(key) if enough else None)
    return lines, keys


def _longs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)


def references(docs: DataFrame, least: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The exact table ``k1, k2, doc_id, refs`` of ``docs``. Rows without doc_id hold
    no references."""
    def run(batches):
        for batch in batches:
            ids, keys, counts = [], [], []
            for d, t in zip(batch["doc_id"], batch["text"]):
                seen: dict[bytes, int] = {}
                for k in line_keys(t, least)[1]:
                    if k is not None:
                        seen[k] = seen.get(k, 0) + 1
                ids += [d] * len(seen)
                keys += seen
                counts += seen.values()
            if ids:
                pair = _longs(keys)
                yield pd.DataFrame({"k1": pair[:, 0], "k2": pair[:, 1], "doc_id": ids, "refs": counts})

    source = (docs.filter(F.col(doc_id).isNotNull())
              .select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    return source.mapInPandas(run, "k1 long, k2 long, doc_id long, refs long")


def keys_of(refs: DataFrame) -> DataFrame:
    """``k1, k2, first, last, n``: each key's least and greatest doc_id and number of rows."""
    return refs.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                        F.count(F.lit(1)).alias("n"))


class LineIndex:
    """Incremental state: the exact table ``refs``, its distinct ``keys`` and their sharded
    ``filters``, as tables of the shared folder.

    ``insert`` tells which keys of new documents were there before and adds them;
    ``delete`` takes documents out again, after which everything is as if they had
    never been inserted. An insertion appends to the exact tables, reads of the keys only
    those that a filter lets through, and writes the filters; a shard that reports full is
    built anew from its keys. A deletion writes all three anew. Old tables stay readable
    until the caller lets them go. A shard holds distinct keys only, so a line that very
    many documents hold is one key in it.
    """

    def __init__(self, refs: DataFrame, keys: DataFrame | None, filters: DataFrame | None, shards: int):
        self.refs, self.keys, self.filters, self.shards = refs, keys, filters, shards

    @classmethod
    def empty(cls, refs: DataFrame, n_keys: int) -> LineIndex:
        """An index without references, with shards for about ``n_keys`` keys; ``refs`` lends its columns."""
        return cls(refs.filter(F.lit(False)), None, None, max(1, -(-n_keys // SHARD_KEYS)))

    @classmethod
    def build(cls, docs: DataFrame, least: int = 10) -> LineIndex:
        refs = cut(references(docs, least), "lineindex")
        index = cls.empty(refs, refs.agg(F.approx_count_distinct("k1")).first()[0])
        return index.add(refs, index.look(refs))

    def _shard(self, keys: DataFrame) -> DataFrame:
        return keys.withColumn("shard", F.pmod(F.col("k2"), F.lit(self.shards)).cast("int"))

    def look(self, refs: DataFrame) -> DataFrame:
        """``k1, k2, first, last, n, known`` of the distinct keys of ``refs``; ``known``: the index holds it."""
        keys = keys_of(refs)
        if self.filters is None:
            return cut(keys.withColumn("known", F.lit(False)), "linekeys")

        def probe(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            ours = ours.drop(columns="shard")
            maybe = np.zeros(len(ours), dtype=bool)
            if len(ours) and len(theirs):
                maybe = CuckooFilter.load(theirs["filter"].iloc[0]).contains(ours["k1"].to_numpy().view(np.uint64))
            return ours.assign(maybe=maybe)

        probed = cut(self._shard(keys).groupBy("shard").cogroup(self.filters.groupBy("shard"))
                     .applyInPandas(probe, "k1 long, k2 long, first long, last long, n long, maybe boolean"), "lineprobe")
        maybe = probed.filter("maybe").drop("maybe")
        known = self.keys.join(maybe.select("k1", "k2"), ["k1", "k2"], "left_semi").withColumn("known", F.lit(True))
        settled = maybe.join(known, ["k1", "k2"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
        return cut(probed.filter("NOT maybe").drop("maybe").withColumn("known", F.lit(False)).unionByName(settled),
                   "linekeys")

    def add(self, refs: DataFrame, keys: DataFrame) -> LineIndex:
        """The index with the written table ``refs``, of which ``keys`` is what ``look`` said."""
        fresh = keys.filter("NOT known").select("k1", "k2")
        held = fresh if self.keys is None else self.keys.unionAll(fresh)
        schema = "shard int, filter binary"

        def enter(key, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            if len(theirs) and not len(ours):
                return theirs[["shard", "filter"]]
            f = (CuckooFilter.load(theirs["filter"].iloc[0]) if len(theirs)
                 else CuckooFilter(max(SHARD_KEYS, len(ours))))
            kept = f.insert(ours["k1"].to_numpy().view(np.uint64))
            return pd.DataFrame({"shard": [int(key[0])], "filter": [f.dump() if kept else None]})

        def rebuild(key, ours: pd.DataFrame) -> pd.DataFrame:
            made = CuckooFilter.of(ours["k1"].to_numpy().view(np.uint64))
            return pd.DataFrame({"shard": [int(key[0])], "filter": [made.dump()]})

        old = self.filters
        if old is None:
            old = keys.sparkSession.createDataFrame([], schema)
        filters = cut(self._shard(fresh).groupBy("shard").cogroup(old.groupBy("shard"))
                      .applyInPandas(enter, schema), "linefilters")
        full = filters.filter("filter IS NULL").select("shard")
        if not full.isEmpty():
            again = (self._shard(held).join(full, "shard", "left_semi").groupBy("shard")
                     .applyInPandas(rebuild, schema))
            filters = cut(filters.filter("filter IS NOT NULL").unionAll(again), "linefilters")
        return LineIndex(self.refs.unionByName(refs.select(*self.refs.columns)), held, filters, self.shards)

    def insert(self, docs: DataFrame, least: int = 10) -> tuple[LineIndex, DataFrame]:
        """The index with ``docs`` and ``k1, k2, doc_id`` of their lines that it held before."""
        new = cut(references(docs, least), "linerefs")
        keys = self.look(new)
        known = limited(new, keys.filter("known").withColumn("after", F.lit(None).cast("long")), new.count())
        return self.add(new, keys), known

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of ``doc_ids(doc_id)``; filters lose their last keys."""
        ids = doc_ids.select("doc_id").distinct()
        left = cut(self.refs.join(ids, "doc_id", "left_anti").select(*self.refs.columns), "lineindex")
        touched = self.refs.join(ids, "doc_id", "left_semi").select("k1", "k2").distinct()
        lost = cut(touched.join(left.select("k1", "k2").distinct(), ["k1", "k2"], "left_anti"), "linekeys")
        if self.keys is None:
            return LineIndex(left, None, None, self.shards)

        def take(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            if len(ours) and len(theirs):
                f = CuckooFilter.load(theirs["filter"].iloc[0])
                f.delete(ours["k1"].to_numpy().view(np.uint64))
                theirs = theirs.assign(filter=[f.dump()])
            return theirs[["shard", "filter"]]

        filters = cut(self._shard(lost).groupBy("shard").cogroup(self.filters.groupBy("shard"))
                      .applyInPandas(take, "shard int, filter binary"), "linefilters")
        return LineIndex(left, cut(self.keys.join(lost, ["k1", "k2"], "left_anti"), "linekeys"), filters, self.shards)


def limited(refs: DataFrame, keys: DataFrame, n_refs: int, hot: int = 1000) -> DataFrame:
    """``k1, k2, doc_id`` of the references whose key is in ``keys(k1, k2, n, after)`` and whose
    doc_id is greater than ``after`` (null: any).

    At most ``hot`` keys can each have over one in ``hot`` of the ``n_refs`` references: these
    are broadcast, so a line that very many documents hold meets in no one task.
    """
    keys = keys.select("k1", "k2", "n", "after")
    many = F.col("n") > F.lit(n_refs / hot)
    over = "after IS NULL OR doc_id > after"
    often = F.broadcast(keys.filter(many).select("k1", "k2", "after", F.lit(True).alias("often")))
    met = refs.select("k1", "k2", "doc_id").join(often, ["k1", "k2"], "left")
    rest = (met.filter("often IS NULL").select("k1", "k2", "doc_id")
            .join(keys.filter(~many).select("k1", "k2", "after"), ["k1", "k2"]).filter(over))
    return (met.filter("often").filter(over).select("k1", "k2", "doc_id")
            .unionAll(rest.select("k1", "k2", "doc_id")))


def drop_repeated(docs: DataFrame, least: int = 10, doc_id: str = "doc_id", text: str = "text",
                  digest: bool = False, increments: int = 2) -> DataFrame:
    """Drop every line whose key occurs in a document of a smaller doc_id.

    The documents go through a ``LineIndex`` in ``increments`` of rising doc_id, without
    effect on the result.

    Keys shorter than ``least`` code points are never dropped, nor are lines of rows
    without doc_id. A document keeps its own repeats. Rows sharing a doc_id are one
    document. Returns all columns of ``docs`` with the new text (null and empty texts are
    as they were if nothing was dropped; an empty table gives no rows; a text of any length
    is one row) plus ``n_lines`` and ``n_dropped``; with
    ``digest`` only ``doc_id, n_lines, n_dropped, kept_sha256``.
    """
    refs = cut(references(docs, least, doc_id, text), "linerefs")
    shares = [i / increments for i in range(1, increments)]
    n, n_keys, ends = refs.agg(F.count(F.lit(1)), F.approx_count_distinct("k1"),
                               F.percentile_approx("doc_id", shares or [0.5], 1000)).first()
    ends = sorted(set(ends or [])) if shares else []
    index = LineIndex.empty(refs, n_keys)
    gone = None
    for i in range(len(ends) + 1):
        own = refs
        if i:
            own = own.filter(F.col("doc_id") > ends[i - 1])
        if i < len(ends):
            own = own.filter(F.col("doc_id") <= ends[i])
        keys = index.look(own)
        if i < len(ends):  # the index ends with this call: nobody asks it after the last increment
            index = index.add(own, keys)
        repeated = (keys.filter("known OR first <> last")
                    .withColumn("after", F.when(~F.col("known"), F.col("first"))))
        found = limited(own, repeated, n)
        gone = found if gone is None else gone.unionAll(found)
    gone = (gone.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("k1", "k2"))).alias("__keys"))
            .select(F.col("doc_id").alias("__doc"), F.col("__keys.k1").alias("__k1"), F.col("__keys.k2").alias("__k2")))
    met = docs.join(gone, F.col(f"`{doc_id}`").cast("long") == F.col("__doc"), "left")

    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def rewrite(texts: pd.Series, k1: pd.Series, k2: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(texts, k1, k2):
            if a is None or not len(a):
                out.append((t, (t or "").count("\n") + 1, 0))
                continue
            drop = set(zip(np.asarray(a).tolist(), np.asarray(b).tolist()))
            lines, keys = line_keys(t, least)
            kept = [x for x, k in zip(lines, keys)
                    if k is None or (int.from_bytes(k[:8], "little", signed=True),
                                     int.from_bytes(k[8:], "little", signed=True)) not in drop]
            out.append((b"\n".join(kept).decode("utf-8"), len(lines), len(lines) - len(kept)))
        out = pd.DataFrame(out, columns=["text", "n_lines", "n_dropped"])
        if digest:
            out["text"] = [hashlib.sha256((t or "").encode("utf-8", "replace")).hexdigest() for t in out["text"]]
        return out

    done = met.withColumn("__line", rewrite(F.col(f"`{text}`"), "__k1", "__k2"))
    if digest:
        return done.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), "__line.n_lines", "__line.n_dropped",
                           F.col("__line.text").alias("kept_sha256"))
    cols = [F.col("__line.text").alias(text) if c == text else F.col(f"`{c}`")
            for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return done.select(*cols, "__line.n_lines", "__line.n_dropped")
