"""Substring dedup by level-wise doubling.

Only what repeats at one length can repeat at twice that length. Level 1 looks at
windows of a few words, of which each longer window names one (the one with the least
hash), so about a quarter of all positions is looked at. Windows whose chosen part
occurs in two documents are extended to twice the length (overlapping, where twice is
too much), and so on, until the wanted length is reached or nothing survives.

Texts are dealt once into chunks of documents. A chunk sends each distinct hash once,
with the smallest doc_id that has it, in packed blocks: a passage that a third of all
documents share is one entry a chunk. The answers come back by chunk.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 6_000_000
PART_BYTES = 12_000_000  # of text for each part of the hashes
NO_DOC = np.iinfo(np.int64).max

_RNG = np.random.Generator(np.random.PCG64(20_240_613))
_BYTE = _RNG.integers(0, 1 << 63, (2, 256), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2^64, up to ``n``."""
    if which not in _POWERS or len(_POWERS[which][0]) <= n:
        size = max(1 << 16, 1 << int(n).bit_length())
        out = []
        for base in (_BASE[which], pow(_BASE[which], -1, 1 << 64)):
            p = np.empty(size, dtype=np.uint64)
            p[0] = 1
            done = 1
            while done < size:  # doubling
                take = min(done, size - done)
                p[done:done + take] = p[:take] * np.uint64(pow(base, done, 1 << 64))
                done += take
            out.append(p)
        _POWERS[which] = out[0], out[1]
    return _POWERS[which]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Windows:
    """Hashes of all word windows of one text: a prefix sum over its bytes makes each
    window's hash two subtractions, whatever its length."""

    def __init__(self, text: str | None):
        self.words = text.encode("utf-8", "replace").split() if text else []
        self.n = len(self.words)
        if self.n:
            size = np.fromiter(map(len, self.words), dtype=np.int64, count=self.n)
            self._ends = np.cumsum(size + 1) - 1
            self._starts = self._ends - size
            self._data = np.frombuffer(b" ".join(self.words), dtype=np.uint8)
            self._sums: dict[int, np.ndarray] = {}

    def hashes(self, length: int, which: int = 0, at: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the windows of ``length`` words at word positions ``at`` (all, if None)."""
        count = self.n - length + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        power, inverse = _powers(which, len(self._data))
        if which not in self._sums:
            sums = np.zeros(len(self._data) + 1, dtype=np.uint64)
            np.cumsum(_BYTE[which][self._data] * power[:len(self._data)], out=sums[1:])
            self._sums[which] = sums
        sums = self._sums[which]
        first = self._starts[:count] if at is None else self._starts[at]
        last = self._ends[length - 1:] if at is None else self._ends[at + length - 1]
        return _mix((sums[last] - sums[first]) * inverse[first])


def levels(length: int, least: int = 6) -> list[int]:
    """Window lengths: each at most twice the one before, the last one ``length``."""
    out = [length]
    while (out[0] + 1) // 2 >= least:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    out = h[:len(h) - width + 1].copy()
    for j in range(1, width):
        np.minimum(out, h[j:len(h) - width + 1 + j], out=out)
    return out


def _chosen(w: Windows, steps: list[int]) -> np.ndarray:
    """For each window of the second level's length, the hash that stands for it on level 1."""
    if len(steps) == 1 or w.n < steps[1]:
        return np.zeros(0, dtype=np.uint64)
    return _sliding_min(w.hashes(steps[0]), steps[1] - steps[0] + 1)


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted ``table``."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(table, values)
    at[at == len(table)] = 0
    return table[at] == values


def _alive(w: Windows, steps: list[int], level: int, answers: dict[int, np.ndarray]) -> np.ndarray:
    """Positions whose window of ``steps[level]`` words may repeat, after all levels below."""
    if w.n < steps[level]:
        return np.zeros(0, dtype=np.int64)
    if level == 0:
        return np.arange(w.n - steps[0] + 1)
    alive = _member(_chosen(w, steps), answers[0])
    for k in range(2, level + 1):
        here = np.flatnonzero(alive)
        known = np.zeros(len(alive), dtype=bool)
        if len(here):
            known[here] = _member(w.hashes(steps[k - 1], 0, here), answers[k - 1])
        count = w.n - steps[k] + 1
        if count <= 0:
            return np.zeros(0, dtype=np.int64)
        over = steps[k] - steps[k - 1]
        alive = known[:count] & known[over:over + count]
    return np.flatnonzero(alive)


def _send(chunk: int, parts: int, h: np.ndarray, check: np.ndarray, doc: np.ndarray) -> pd.DataFrame:
    """Packed blocks of a chunk: each distinct hash once, with its smallest doc_id and
    whether the chunk has it in several documents."""
    order = np.lexsort((doc, check, h))
    h, check, doc = h[order], check[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(h)) - 1
    several = doc[start] != doc[last] if len(start) else np.zeros(0, dtype=bool)
    h, check, doc = h[start], check[start], doc[start]
    part = ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # ranges of h
    bound = np.searchsorted(part, np.arange(parts + 1))
    ids, local = np.unique(doc, return_inverse=True)
    rows = []
    for p in range(parts):
        a, b = bound[p], bound[p + 1]
        if a < b:
            own, at = np.unique(local[a:b], return_inverse=True)
            rows.append((p, chunk, h[a:b].tobytes(), check[a:b].tobytes(), at.astype("<u4").tobytes(),
                         ids[own].tobytes(), np.packbits(several[a:b]).tobytes()))
    return pd.DataFrame(rows, columns=["part", "chunk", "h", "checked", "doc", "ids", "several"])


_SENT = "part int, chunk int, h binary, checked binary, doc binary, ids binary, several binary"
_BACK = "chunk int, part int, h binary, first binary"


def _answer(rows: pd.DataFrame, checks: bool, firsts: bool) -> pd.DataFrame:
    """For every chunk the hashes of a part that two documents have (and the smallest doc_id)."""
    rows = rows.sort_values("chunk")
    hs = [np.frombuffer(x, dtype=np.uint64) for x in rows["h"]]
    cs = [np.frombuffer(x, dtype="<u4") for x in rows["checked"]] if checks else None
    ds = [np.frombuffer(i, dtype=np.int64)[np.frombuffer(d, dtype="<u4")] for i, d in zip(rows["ids"], rows["doc"])]
    many = [np.unpackbits(np.frombuffer(s, dtype=np.uint8))[:len(h)].astype(bool) for s, h in zip(rows["several"], hs)]
    size = [len(h) for h in hs]
    h, doc, several = np.concatenate(hs), np.concatenate(ds), np.concatenate(many)
    check = np.concatenate(cs) if checks else np.zeros(len(h), dtype=np.uint32)
    order = np.lexsort((doc, check, h)) if checks else np.argsort(h, kind="stable")
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (check[order][1:] != check[order][:-1])
    start, group = np.flatnonzero(new), np.cumsum(new) - 1
    low = np.minimum.reduceat(doc[order], start)
    high = np.maximum.reduceat(doc[order], start)
    twice = (low != high) | np.logical_or.reduceat(several[order], start)
    keep, first = np.empty(len(h), dtype=bool), np.empty(len(h), dtype=np.int64)
    keep[order], first[order] = twice[group], low[group]
    out, at = [], 0
    for chunk, part, n in zip(rows["chunk"], rows["part"], size):
        k = keep[at:at + n]
        if k.any():
            out.append((chunk, part, h[at:at + n][k].tobytes(), first[at:at + n][k].tobytes() if firsts else b""))
        at += n
    return pd.DataFrame(out, columns=["chunk", "part", "h", "first"])


def _answer_below(rows: pd.DataFrame) -> pd.DataFrame:
    return _answer(rows, checks=False, firsts=False)


def _answer_last(rows: pd.DataFrame) -> pd.DataFrame:
    return _answer(rows, checks=True, firsts=True)


def _texts(group: pd.DataFrame):
    ids = [None if pd.isna(d) else int(d) for d in group["doc_id"]]
    return ids, group["text"]


def repeated_windows(docs: DataFrame, length: int = 13, doc_id: str = "doc_id", text: str = "text"):
    """``(dealt, answers, steps, chunks)``: the documents dealt into chunks, and for each
    chunk the hashes of the windows of ``length`` words that two documents have, with
    the smallest doc_id that has each."""
    steps = levels(length)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = source.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    chunks, parts = max(1, -(-total // CHUNK_BYTES)), max(1, -(-total // PART_BYTES))
    # rows without doc_id are dealt by their text: they need not meet
    chunk = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(chunks)).cast("int")
    dealt = source.withColumn("chunk", chunk).repartition(int(chunks), "chunk")
    answers: list[DataFrame] = []
    last = len(steps) - 1

    def told(theirs: pd.DataFrame) -> dict[int, np.ndarray]:
        return {int(k): np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in g.sort_values("part")["h"]])
                for k, g in theirs.groupby("level")}

    def look(level: int):
        def run(group: pd.DataFrame, known: dict[int, np.ndarray]) -> pd.DataFrame:
            h, c, d = [], [], []
            ids, texts = _texts(group)
            for doc, t in zip(ids, texts):
                if doc is None:
                    continue
                w = Windows(t)
                if level == 0 and last > 0:
                    own = np.unique(_chosen(w, steps))
                    sure = np.zeros(len(own), dtype=np.uint32)
                else:
                    at = _alive(w, steps, level, known)
                    own = w.hashes(steps[level], 0, at) if len(at) else np.zeros(0, dtype=np.uint64)
                    sure = (w.hashes(steps[level], 1, at) >> np.uint64(32)).astype(np.uint32) if len(at) else \
                        np.zeros(0, dtype=np.uint32)
                h.append(own)
                c.append(sure)
                d.append(np.full(len(own), doc, dtype=np.int64))
            if not h or not sum(map(len, h)):
                return pd.DataFrame([], columns=["part", "chunk", "h", "checked", "doc", "ids", "several"])
            sent = _send(int(group["chunk"].iloc[0]), int(parts), np.concatenate(h), np.concatenate(c), np.concatenate(d))
            if level < last:
                sent["checked"] = b""
            return sent

        if level == 0:
            return lambda group: run(group, {})

        def with_answers(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
            known = told(theirs)
            if not len(ours) or any(k not in known for k in range(level)):
                return pd.DataFrame([], columns=["part", "chunk", "h", "checked", "doc", "ids", "several"])
            return run(ours, known)
        return with_answers

    for level in range(last + 1):
        if level == 0:
            sent = dealt.groupBy("chunk").applyInPandas(look(0), _SENT)
        else:
            so_far = answers[0]
            for a in answers[1:]:
                so_far = so_far.unionAll(a)
            sent = dealt.groupBy("chunk").cogroup(so_far.groupBy("chunk")).applyInPandas(look(level), _SENT)
        back = sent.groupBy("part").applyInPandas(_answer_last if level == last else _answer_below, _BACK)
        answers.append(back.withColumn("level", F.lit(level)))
    return dealt, answers[-1], steps, chunks


def drop_repeats(docs: DataFrame, length: int = 13, doc_id: str = "doc_id", text: str = "text",
                 digest: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``length`` words that also starts in a
    document of a smaller doc_id: ``doc_id, text, n_words, n_removed`` (kept words joined
    by one blank), or with ``digest`` the SHA-256 of that text as ``kept_sha256``.

    Windows are judged on the input. Words are runs of anything but ASCII white space.
    Null and empty texts have no words; rows without doc_id are neither judged nor
    witnesses; rows sharing a doc_id do not witness against each other; an empty table
    gives no rows. Hashes of 96 bits decide equality.
    """
    dealt, answers, _, _ = repeated_windows(docs, length, doc_id, text)
    out_name = "kept_sha256" if digest else "text"
    schema = f"doc_id long, n_words long, n_removed long, {out_name} string"

    def keep(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if len(theirs):
            theirs = theirs.sort_values("part")
            table = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in theirs["h"]])
            first = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in theirs["first"]])
        else:
            table, first = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        rows = []
        for doc, t in zip(*_texts(ours)):
            w = Windows(t)
            words, removed = w.words, 0
            if doc is not None and w.n >= length and len(table):
                h = w.hashes(length)
                at = np.searchsorted(table, h)
                at[at == len(table)] = 0
                hit = (table[at] == h) & (first[at] < doc)
                if hit.any():
                    cover = np.zeros(w.n + 1, dtype=np.int64)
                    here = np.flatnonzero(hit)
                    cover[here] += 1
                    cover[here + length] -= 1
                    gone = np.cumsum(cover[:-1]) > 0
                    removed = int(gone.sum())
                    words = [x for x, g in zip(words, gone.tolist()) if not g]
            kept = b" ".join(words)
            rows.append((doc, w.n, removed, hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8")))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", out_name])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(keep, schema)
