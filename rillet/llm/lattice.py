"""Embedding near-dedup by lattice hashing.

Each table projects unit vectors to eight random directions and decodes the result to
the nearest point of the E8 lattice: the cell. A vector lives in one cell a table and
also visits the neighbouring cells nearest to it. Vectors meet in a cell where at least
one of them lives; cosine decides in double precision.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, each_group, split_buckets


def e8_roots() -> np.ndarray:
    """The 240 shortest lattice vectors, doubled: two entries of +-2, or all +-1 with an
    even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(s) for s in product((1, -1), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out, dtype=np.int64)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer vectors with an even sum: where rounding gives an odd sum, the
    coordinate rounded farthest goes the other way."""
    r = np.rint(y)
    odd = np.flatnonzero(r.sum(axis=1) % 2 != 0)
    if len(odd):
        gap = y[odd] - r[odd]
        worst = np.abs(gap).argmax(axis=1)
        step = np.where(gap[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
        r[odd, worst] += step
    return r


def e8_decode(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row, doubled (so that halves are integers). E8 is the
    even-sum integer vectors together with those shifted by one half everywhere."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - half) ** 2).sum(axis=1) < ((y - whole) ** 2).sum(axis=1)
    return np.rint(2 * np.where(closer[:, None], half, whole)).astype(np.int64)


def _cell_hash(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    h = salt.astype(np.uint64)
    for j in range(8):
        h = (h ^ points[..., j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


class LatticeTables:
    """Projections of ``tables`` tables for vectors of one length; the same wherever made."""

    def __init__(self, dim: int, tables: int, probes: int, width: float, seed: int = 11):
        rng = np.random.default_rng([seed, dim])
        self.tables, self.probes = tables, probes
        self._turn = rng.standard_normal((tables, dim, 8)) / width
        self._shift = rng.uniform(0, 2, (tables, 8))
        self._roots = e8_roots()

    def keys(self, unit: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Cell keys, rows x tables x (1 + probes): the home cell first, then the visited ones."""
        out = np.empty((len(unit), self.tables, 1 + self.probes), dtype=np.int64)
        for t in range(self.tables):
            y = unit @ self._turn[t] + self._shift[t]
            home = e8_decode(y)
            lean = (y - home / 2) @ self._roots.T  # the larger, the nearer the neighbour
            near = np.argsort(-lean, axis=1, kind="stable")[:, :self.probes]
            cells = np.concatenate([home[:, None, :], home[:, None, :] + self._roots[near]], axis=1)
            salt = (label.astype(np.int64) * 1000003 + t + 1).view(np.uint64)
            out[:, t] = _cell_hash(cells, np.repeat(salt[:, None], 1 + self.probes, axis=1))
        return out


def _meet(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """In which tables a row (tables x cells) meets each of others (n x tables x cells)."""
    here = (many[:, :, 0][:, :, None] == one[None]).any(axis=2)  # they live where it lives or visits
    there = (many == one[None, :, :1]).any(axis=2)
    return here | there


def _bucket(group: dict, least: float, shape: tuple[int, int]) -> list[tuple]:
    """Links of one cell piece: ``(class, links to add, -1)`` and spanning edges ``(class, class, 1)``.

    A pair that meets in several cells counts in one only: the first table it meets
    in, and there where it shares a home or the visitor has the larger class number.
    """
    n = len(group["cid"])
    if n < 2:
        return []
    order = np.argsort(group["cid"], kind="stable")
    cid, own, home, table = (group[c][order] for c in ("cid", "own", "home", "tab"))
    unit = np.array([np.frombuffer(group["unit"][i], dtype=np.float64) for i in order])
    keys = np.array([np.frombuffer(group["cells"][i], dtype=np.int64) for i in order]).reshape(n, *shape)
    mult, t, cell = group["mult"][order], int(table[0]), group["cell"][0]
    split = group["pi"][0] != group["pj"][0]
    links = np.zeros(n, dtype=np.int64)
    edges: list[tuple] = []
    root = np.arange(n)

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n - 1):
        later = np.arange(i + 1, n)
        can = (home[i] | home[later]) & ((own[later] != own[i]) if split else (own[later] == own[i]))
        later = later[can & (cid[later] != cid[i])]
        if not len(later):
            continue
        later = later[unit[later] @ unit[i] >= least]
        if not len(later):
            continue
        met = _meet(keys[i], keys[later])
        first = ~met[:, :t].any(axis=1)
        both = home[i] & home[later]
        # one lives here, the other visits; it may be the other way round elsewhere
        back = np.where(home[later], (keys[later, t] == keys[i, t, 0]).any(axis=1) if not home[i] else False,
                        (keys[i, t][None, :] == keys[later, t, 0][:, None]).any(axis=1))
        visitor_larger = ~home[later]  # rows are in order of class: the later one is larger
        counts = first & (both | ~back | visitor_larger)
        links[i] += mult[later[counts]].sum()
        links[later[counts]] += mult[i]
        for j in later.tolist():
            a, b = top(i), top(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((cid[i], cid[j], 1))
    return [(c, x, -1) for c, x in zip(cid.tolist(), links.tolist()) if x] + edges


def near_duplicates(vectors: DataFrame, least: float = 0.93, tables: int = 8, probes: int = 6, width: float = 1.05,
                    block: int = 1024, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id, n_links`` (other rows of the same label with
    cosine at least ``least``), ``component_id`` (smallest vec_id reachable) and ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows
    without label or vec_id, link with nothing (a null vec_id has a null component).
    Vectors of different length are not compared. Equal vectors of a label are one class
    from the start, with their number, so copies cost one row. Other pairs are found with
    the tables' recall; each counts once; only a spanning forest of a cell's links leaves
    its task. Large cells are split. An empty table gives no rows.
    """
    shape = (tables, 1 + probes)
    v = F.col("v")
    rows = cut(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                              F.col(embedding).cast("array<double>").alias("v")), "vectors")
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size("v") > 0)
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("v", lambda x: x != 0))
    good = rows.filter(F.coalesce(sound, F.lit(False)))

    @F.pandas_udf("struct<unit: binary, cells: binary, homes: array<long>, visits: array<long>>")
    def hashed(vs: pd.Series, labels: pd.Series) -> pd.DataFrame:
        made: dict[int, LatticeTables] = {}
        out: list = [None] * len(vs)
        size = np.array([len(x) for x in vs])
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            tab = made.setdefault(int(dim), LatticeTables(int(dim), tables, probes, width))
            x = np.array([vs.iloc[i] for i in at], dtype=np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
            x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
            keys = tab.keys(x, labels.to_numpy()[at] * 4099 + dim)
            for k, i in enumerate(at):
                out[i] = (x[k].tobytes(), keys[k].tobytes(), keys[k, :, 0], keys[k, :, 1:].ravel())
        return pd.DataFrame(out, columns=["unit", "cells", "homes", "visits"])

    classes = (good.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("mult"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = cut(cut(classes, "classes").withColumn("h", hashed("v", "label"))
                  .select("cid", "label", "v", "node", "mult", "h.*"), "cells")
    narrow = classes.select("cid", F.posexplode("homes").alias("tab", "cell")).withColumn("home", F.lit(True)).unionAll(
        classes.select("cid", F.posexplode("visits").alias("at", "cell"))
        .select("cid", F.floor(F.col("at") / probes).cast("int").alias("tab"), "cell", F.lit(False)))
    pieces = split_buckets(narrow, ["tab", "cell"], "cid", block, some="home")
    wide = pieces.select("tab", "cell", "pi", "pj", "own", "home", "cid").join(
        classes.select("cid", "mult", "unit", "cells"), "cid")

    found = cut(each_group(wide, ["tab", "cell", "pi", "pj"], lambda g: _bucket(g, least, shape),
                           "a long, b long, kind int"), "links")
    extra = found.filter("kind = -1").groupBy(F.col("a").alias("cid")).agg(F.sum("b").alias("extra"))
    node = classes.select("cid", "node")
    edges = (found.filter("kind = 1").join(node, F.col("a") == node.cid).select(F.col("node").alias("a"), "b")
             .join(node, F.col("b") == node.cid).select("a", F.col("node").alias("b")))
    member = good.join(classes.select(F.col("label"), F.col("v"), "cid", "node", "mult"), ["label", "v"]) \
        .select("vec_id", "cid", "node", "mult")
    tied = member.groupBy("vec_id").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).filter("lo <> hi") \
        .select("vec_id").join(member, "vec_id").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    comp = components(edges.unionAll(tied))
    told = (classes.select("label", "v", "cid", "node", "mult").join(extra, "cid", "left").join(comp, "node", "left")
            .select("label", "v", (F.col("mult") - 1 + F.coalesce("extra", F.lit(0))).alias("n_links"),
                    F.coalesce("component", "node").alias("component_id")))
    ok = F.coalesce(sound, F.lit(False))
    linked = rows.filter(ok).join(told, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
