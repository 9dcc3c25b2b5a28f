"""SimHash near-duplicates with pigeonring filtering.

The 64 bits are cut into ``distance + 1`` consecutive segments on a ring. If two
fingerprints differ in at most ``distance`` bits, some segment starts a chain whose
running sums of differences stay within their share of the budget: after l segments
at most ``floor(l * distance / segments)`` bits. For the first segment that means
equality, for the first two one bit. So two rows can only link through a key that
holds one whole segment and two thirds of the next (the differing bit is in the
third left out, whichever it is). In a bucket of equal keys the longer chains are
checked next, and the full Hamming distance last.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, each_group, split_buckets

SHINGLES_AT_ONCE = 1 << 16
HASH_SEED = 9


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the text's word shingles (A-Z lower-cased, repeats count) as a signed
    64-bit number. Fewer words: the whole sequence is one shingle; none: 0."""
    tokens = text.encode("utf-8", "replace").lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, seed)).view(np.int64))
    size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
    ends = np.cumsum(size + 1) - 1
    starts, ends = (ends - size)[:len(tokens) - words + 1].tolist(), ends[words - 1:].tolist()
    digest, n = xxhash.xxh64_intdigest, len(starts)
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, n, SHINGLES_AT_ONCE):
        b = a + SHINGLES_AT_ONCE
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[a:b], ends[a:b])], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    value = np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0]
    return int(value.view(np.int64))


def segments(distance: int) -> list[int]:
    """Bit masks of the ring's segments, nearly equal in width."""
    m, masks, at = distance + 1, [], 0
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        masks.append(((1 << width) - 1) << at)
        at += width
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def key_masks(distance: int) -> list[tuple[int, int]]:
    """(segment, mask) of every key."""
    ring, out = segments(distance), []
    for i, whole in enumerate(ring):
        after = ring[(i + 1) % len(ring)]
        bits = [b for b in range(64) if after >> b & 1]
        budget = 2 * distance // len(ring)  # differing bits the second segment may hold
        parts = np.array_split(bits, budget + 2)
        # budget bits fall into at most budget parts: leave each such choice out in turn
        for left in (range(len(parts)) if budget == 1 else [None]):
            mask = whole
            for p, part in enumerate(parts):
                if budget == 0 or budget == 1 and p != left:
                    mask |= sum(1 << int(b) for b in part)
            out.append((i, mask))
    return out


def tree_links(fps: np.ndarray, at: int, distance: int) -> list[tuple[int, int]]:
    """Spanning links among a bucket's distinct fingerprints whose chain from segment
    ``at`` is viable and whose distance is within bounds. Each fingerprint is met once."""
    ring = segments(distance)
    m = len(ring)
    chains, mask = [], 0
    for length in range(1, m):
        mask |= ring[(at + length - 1) % m]
        if length >= 2:
            chains.append((np.uint64(mask), length * distance // m))
    rest, links = fps, []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            a = queue.pop()
            diff = rest ^ a
            near = np.arange(len(rest))
            for chain, budget in chains:
                near = near[np.bitwise_count(diff[near] & chain) <= budget]
            near = near[np.bitwise_count(diff[near]) <= distance]
            if len(near):
                found = rest[near]
                links += [(a, b) for b in found]
                queue.extend(found)
                rest = np.delete(rest, near)
    return links


def links(classes: DataFrame, distance: int = 4, block: int = 4096) -> DataFrame:
    """Edges ``a, b`` between the nodes of ``classes(fp, node)`` (distinct ``fp``) that
    connect all fingerprints at ``distance`` or fewer bits.

    Within a bucket only a spanning forest of the links comes out, not all pairs; the
    connected components are the same. Large buckets are split into bounded pieces.
    """
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(i).alias("seg"),
                              F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("part"))
                     for k, (i, mask) in enumerate(key_masks(distance))])
    rows = classes.select("fp", "node", F.explode(keys).alias("__k")).select("fp", "node", "__k.*")
    pieces = split_buckets(rows, ["k", "part"], "fp", block)

    def run(group):
        if len(group["fp"]) < 2:
            return []
        fps = np.ascontiguousarray(group["fp"]).view(np.uint64)
        found = tree_links(fps, int(group["seg"][0]), distance)
        if not found:
            return []
        node = dict(zip(fps.tolist(), group["node"].tolist()))
        return [(node[int(a)], node[int(b)]) for a, b in found]

    return each_group(pieces.select("k", "part", "pi", "pj", "seg", "fp", "node"),
                      ["k", "part", "pi", "pj"], run, "a long, b long")


def _fingerprints(words: int, seed: int):
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words, seed) for t in texts], dtype="int64")
    return fp


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, distance: int = 4,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp`` (signed 64 bits) and ``component_id``,
    the smallest doc_id reachable over links of at most ``distance`` differing bits.

    Null and empty texts have fingerprint 0 and link like any other. Rows that share
    a doc_id are one node with several fingerprints. A null doc_id links to nothing
    and has a null component. Equal fingerprints are one class from the start, so
    groups of copies cost one row. An empty table gives no rows.
    """
    prints = cut(docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                             _fingerprints(words, seed)(F.col(text)).alias("fp")), "simhash")
    held = prints.filter("doc_id IS NOT NULL")
    classes = held.groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = cut(classes, "classes")
    edges = links(classes, distance)
    # a doc_id with several texts ties its classes together
    tied = (held.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi")
            .select("doc_id").join(held, "doc_id").join(classes, "fp")
            .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    found = components(edges.unionAll(tied))
    named = (classes.join(found, "node", "left")
             .select("fp", F.coalesce("component", "node").alias("component_id")))
    return (prints.join(named, "fp", "left")
            .select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def text_hash(text: str = "text"):
    return F.xxhash64(F.col(text), F.lit(HASH_SEED))


def one_of_each(docs: DataFrame, words: int = 4, seed: int = 42, distance: int = 4,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash`` of one row of each component of texts: that of the smallest
    doc_id, and of its texts there the one of the least hash.

    Fingerprints are the nodes here, so two texts under one doc_id are not linked by it.
    Rows without doc_id take no part.
    """
    prints = (docs.filter(F.col(doc_id).isNotNull())
              .select(F.struct(F.col(doc_id).cast("long").alias("doc_id"), text_hash(text).alias("text_hash")).alias("row"),
                      _fingerprints(words, seed)(F.col(text)).alias("fp")))
    classes = cut(prints.groupBy("fp").agg(F.min("row").alias("row")).withColumn("node", F.col("fp")), "classes")
    found = components(links(classes, distance))
    return (classes.join(found, "node", "left").groupBy(F.coalesce("component", "node").alias("component"))
            .agg(F.min("row").alias("row")).select("row.doc_id", "row.text_hash"))
