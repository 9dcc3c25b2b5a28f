"""Cross-tokenizer alignment by merge-path partitioning.

Two tokenizers cut the same bytes; merging the ends of A's tokens with the ends of B's
gives every overlap: each distinct end closes exactly one stretch that lies in one A token
and one B token, and an end of both closes a group. The merge of many documents is one
long path through the grid of A ends and B ends. Diagonals at equal distances cut it into
pieces of equal work: on each, a binary search finds where the path crosses, so every
piece knows its A ends and B ends and is merged for itself. A piece gives its overlaps; an
end that two pieces share is dropped from the later one and closes the group of the earlier.

How often two ids are linked in the whole corpus is counted per block of documents first,
so the shuffle carries one row for each block and pair of ids, and the counts come back
the same way: to the blocks, not to the links.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

BLOCK_CHARS = 1 << 22   # documents of a block, whose pairs of ids are counted together
SLICE_CHARS = 1 << 19   # texts tokenized at a time
PIECE = 1 << 16         # ends in a piece of the merge path

# The split of the byte-level file kind; code points on which Unicode versions
# agree about letters, digits and spaces (others go through the library whole); the byte alphabet.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSETTLED = r"[^\u0000-\u052f\u2010-\u205f\u3040-\u9fff\uac00-\ud7a3]"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BLANK = "\u2581"


def crossings(a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the first ``at`` elements of the merge of sorted ``a`` and ``b`` come
    from ``a`` (equal ones: from ``a`` first), by binary search on each diagonal."""
    low, high = np.maximum(at - len(b), 0), np.minimum(at, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        other = np.clip(at - mid - 1, 0, max(len(b) - 1, 0))
        more = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[other])
        low, high = np.where(more, mid + 1, low), np.where(open_ & ~more, mid, high)
    return low


def merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One piece merged: distinct ends, how many of ``a`` and of ``b`` lie before each,
    and whether it is an end of both."""
    ends = np.empty(len(a) + len(b), dtype=np.int64)
    ends[np.arange(len(a)) + np.searchsorted(b, a, "left")] = a
    ends[np.arange(len(b)) + np.searchsorted(a, b, "right")] = b
    first = np.ones(len(ends), dtype=bool)
    first[1:] = ends[1:] != ends[:-1]
    both = np.zeros(len(ends), dtype=bool)
    both[:-1] = ~first[1:]
    ends = ends[first]
    return ends, np.searchsorted(a, ends, "left"), np.searchsorted(b, ends, "left"), both[first]


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, ...]:
    """Overlapping tokens of two tokenizations given by their sorted end offsets: for each
    overlap the A token's and the B token's number, its end, and whether a group ends there."""
    total = len(a) + len(b)
    if not total:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, np.empty(0, dtype=bool)
    at = np.append(np.arange(0, total, piece), total)
    i = crossings(a, b, at)
    j = at - i
    found, last = [], None
    for p in range(len(at) - 1):
        ends, ia, ib, both = merge_piece(a[i[p]:i[p + 1]], b[j[p]:j[p + 1]])
        if last is not None and len(ends) and ends[0] == last:
            # stitched: the end stands in the piece before, which now closes a group there
            found[-1][3][-1] = True
            ends, ia, ib, both = ends[1:], ia[1:], ib[1:], both[1:]
        if len(ends):
            found.append((ia + i[p], ib + j[p], ends, both))
            last = ends[-1]
    return tuple(np.concatenate(parts) for parts in zip(*found))


class Pair:
    """Both tokenizers: a byte-level BPE file (A) and a sentencepiece model (B)."""

    def __init__(self, a_path: str, b_path: str, cache_pieces: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {chr(b): b for b in PRINTABLE}
        byte_of.update({chr(0x100 + n): b for n, b in enumerate(b for b in range(256) if b not in byte_of.values())})
        self.a_bytes = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            plain = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if plain else token.encode("utf-8")
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i)
                                else piece.replace(BLANK, " ").encode("utf-8"))
        self.a_size, self.b_size = (np.array([len(t) for t in ts]) for ts in (self.a_bytes, self.b_bytes))
        self._b_blob, self._b_start = np.frombuffer(b"".join(self.b_bytes), dtype=np.uint8), np.cumsum(self.b_size) - self.b_size
        self.a_text, self.b_text = (np.array([f"{i}{sep}" for sep in (",", end) for i in range(len(ts))], dtype=object)
                                    for ts, end in ((self.a_bytes, "|"), (self.b_bytes, ";")))
        self._split, self._unsettled = regex.compile(BYTE_SPLIT).findall, regex.compile(UNSETTLED).search
        self._limit = cache_pieces
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._lossy: set[str] = set()  # pre-tokens of the memo that A's tokens do not give back

    def _a_encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool]]:
        """A's ids, and whether their bytes are known to give back the text. Pre-tokens are
        encoded, and compared with their bytes, for themselves: each once."""
        out: list[np.ndarray | None] = [None] * len(texts)
        settled = [n for n, t in enumerate(texts) if not self._unsettled(t)]
        pieces = [self._split(texts[n]) for n in settled]
        if len(self._young) > self._limit:
            self._young, self._old = {}, self._young
            self._lossy.intersection_update(self._old)
        young, old, lossy, a_bytes = self._young, self._old, self._lossy, self.a_bytes.__getitem__
        wanted = set().union(*pieces).difference(young)
        young.update({p: old[p] for p in wanted if p in old})
        wanted = [p for p in wanted if p not in young]
        for piece, found in zip(wanted, self.a.encode_batch_fast(wanted, add_special_tokens=False)):
            ids = found.ids
            young[piece] = array("I", ids).tobytes()
            if b"".join(map(a_bytes, ids)) != piece.encode("utf-8"):
                lossy.add(piece)
        for n, of_text in zip(settled, pieces):
            out[n] = np.frombuffer(b"".join(map(young.__getitem__, of_text)), dtype="<u4")
        rest = [n for n, ids in enumerate(out) if ids is None]
        for n, found in zip(rest, self.a.encode_batch_fast([texts[n] for n in rest], add_special_tokens=False)):
            out[n] = np.array(found.ids, dtype="<u4")
        whole = [False] * len(texts)
        for n, of_text in zip(settled, pieces):
            whole[n] = not lossy or lossy.isdisjoint(of_text)
        return out, whole

    def _b_texts(self, ids: list[np.ndarray]) -> Iterator[bytes]:
        """The joined bytes of each list of B's ids, gathered for all of them at once."""
        flat = np.concatenate([np.empty(0, dtype="<u4"), *ids])
        size = self.b_size[flat]
        ends = np.append(0, np.cumsum(size))
        got = self._b_blob[np.arange(ends[-1]) + np.repeat(self._b_start[flat] - ends[:-1], size)].tobytes()
        cuts = ends[np.cumsum([0, *map(len, ids)])].tolist()
        return (got[x:y] for x, y in zip(cuts, cuts[1:]))

    def tokens(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """A's ids of a blank and the text, and B's of the text (B adds the blank). None for
        null and empty texts, and where the tokens' bytes do not give back blank and text."""
        none = np.empty(0, dtype="<u4")
        out = [(none, none)] * len(texts)
        there = [n for n, t in enumerate(texts) if t]
        a_ids, whole = self._a_encode([" " + texts[n] for n in there])
        b_ids = [np.array(b, dtype="<u4") for b in self.b.encode([texts[n] for n in there], num_threads=1)] if there else []
        for n, a, same, b, b_text in zip(there, a_ids, whole, b_ids, self._b_texts(b_ids)):
            raw = (" " + texts[n]).encode("utf-8")
            if b_text == raw and (same or b"".join(map(self.a_bytes.__getitem__, a.tolist())) == raw):
                out[n] = a, b
        return out

    def group_texts(self, a: np.ndarray, b: np.ndarray, ia, ib, both, bounds) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``. ``bounds`` are the documents' ends
        among the overlaps; the last token of a group carries the group's separator."""
        a_last, b_last = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
        a_last[ia[both]] = b_last[ib[both]] = True
        # a token stands after all tokens of its side before it and, on the other side, all
        # of the groups before it (A tokens) or up to its own (B tokens)
        a_ends, b_ends = ia[both] + 1, ib[both] + 1
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        b_before = np.append(0, b_ends)
        line = np.empty(len(a) + len(b), dtype=object)
        line[np.arange(len(a)) + b_before[a_group]] = self.a_text[a + a_last * len(self.a_size)]
        line[np.arange(len(b)) + a_ends[b_group]] = self.b_text[b + b_last * len(self.b_size)]
        cuts = [0]
        for end in bounds:
            cuts.append(int(ia[end - 1] + ib[end - 1]) + 2 if end else 0)
        cuts = np.maximum.accumulate(cuts).tolist()
        return ["".join(line[x:y].tolist())[:-1] for x, y in zip(cuts, cuts[1:])]


_OPEN: dict[tuple[str, str], Pair] = {}


def open_pair(a_path: str, b_path: str) -> Pair:
    """The worker process's tokenizers (loaded once)."""
    if (a_path, b_path) not in _OPEN:
        _OPEN[a_path, b_path] = Pair(a_path, b_path)
    return _OPEN[a_path, b_path]


def _linked(pair: Pair, docs: list[tuple[int | None, np.ndarray, np.ndarray]]) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """A block's documents as rows, its pairs of ids (packed) and how often each is linked."""
    a = np.concatenate([d[1] for d in docs]).astype(np.int64)
    b = np.concatenate([d[2] for d in docs]).astype(np.int64)
    ia, ib, ends, both = overlaps(np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b]))
    n_a, n_b = np.array([len(d[1]) for d in docs]), np.array([len(d[2]) for d in docs])
    bounds = np.searchsorted(ia, np.cumsum(n_a), "left")  # overlaps before each document's end
    texts = pair.group_texts(a, b, ia, ib, both, bounds)
    starts = np.append(0, bounds[:-1])
    closed = np.append(0, np.cumsum(both))
    packed = a[ia] * len(pair.b_size) + b[ib]
    at, keys = pd.factorize(packed)
    times = np.bincount(at, minlength=len(keys))
    owner = np.repeat(np.arange(len(docs)), bounds - starts)
    mine, counts = np.unique(owner * max(len(keys), 1) + at, return_counts=True)
    cuts = np.searchsorted(mine, np.arange(len(docs) + 1) * max(len(keys), 1))
    mine, counts = (mine % max(len(keys), 1)).astype("<u4"), counts.astype("<u4")
    rows = [{"doc_id": doc_id, "n_a": n_a[n], "n_b": n_b[n], "n_groups": closed[bounds[n]] - closed[starts[n]],
             "n_links": bounds[n] - starts[n], "groups": texts[n],
             "at": mine[cuts[n]:cuts[n + 1]].tobytes(), "times": counts[cuts[n]:cuts[n + 1]].tobytes()}
            for n, (doc_id, _, _) in enumerate(docs)]
    return rows, keys, times


def _blocks(batches, pair: Pair) -> Iterator[list[tuple[int | None, np.ndarray, np.ndarray]]]:
    """Tokenized documents in blocks of about ``BLOCK_CHARS`` characters."""
    block, held, size, pending = [], [], 0, 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            held.append((None if pd.isna(doc_id) else int(doc_id), text))
            pending += len(text or "")
            if pending >= SLICE_CHARS or len(held) >= 20_000:
                block += [(d, *ids) for (d, _), ids in zip(held, pair.tokens([t for _, t in held]))]
                size, held, pending = size + pending, [], 0
                if size >= BLOCK_CHARS or len(block) >= 100_000:
                    yield block
                    block, size = [], 0
    block += [(d, *ids) for (d, _), ids in zip(held, pair.tokens([t for _, t in held]))]
    if block:
        yield block


def linked(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
           digest: bool = False) -> DataFrame:
    """Documents aligned, written to the shared folder: a row a document (``doc_id, n_a, n_b,
    n_groups, n_links, groups``, and its pairs as numbers in the block's list ``at`` with
    how often, ``times``) and a row a block with that list (``keys``, ``counts``).

    With ``digest``, ``groups`` is the SHA-256 of the groups' text, '' without tokens.
    """
    schema = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
              "at binary, times binary, keys array<long>, counts array<long>")

    def run(batches):
        pair = open_pair(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        for docs_ in _blocks(batches, pair):
            rows, keys, counts = _linked(pair, docs_)
            if digest:
                for row in rows:
                    row["groups"] = hashlib.sha256(row["groups"].encode()).hexdigest() if row["n_a"] else ""
            out = pd.DataFrame([*rows, {"keys": keys, "counts": counts}],
                               columns=[f.split()[0] for f in schema.split(", ")])
            out["block"] = block
            for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links"):
                out[c] = out[c].astype("Int64")
            yield out.astype({c: object for c in ("groups", "at", "times")}).where(out.notna(), None)
            block += 1

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cut(source.mapInPandas(run, schema), "linked")


def pair_counts(found: DataFrame, b_tokens: int) -> DataFrame:
    """``key`` (A id times ``b_tokens`` plus B id), ``n`` (links of the pair in the corpus) and
    ``best`` (no other pair of the B id has more) from :func:`linked`."""
    pairs = (found.filter("keys IS NOT NULL").select(F.explode(F.arrays_zip("keys", "counts")).alias("p"))
             .groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.counts").alias("n")))
    most = pairs.groupBy(F.pmod("key", F.lit(b_tokens)).alias("b")).agg(F.max("n").alias("most"))
    # one row a token of B at most, whatever the corpus
    return (pairs.withColumn("b", F.pmod("key", F.lit(b_tokens))).join(F.broadcast(most), "b")
            .select("key", "n", (F.col("n") == F.col("most")).alias("best")))


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
          digest: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``, a row a row of ``docs``.

    ``n_links`` are the overlapping token occurrences, ``count_sum`` the sum over them of how
    often the two ids are linked in all of ``docs``, ``n_best`` those whose count is the
    highest of their B id (ties included). Texts null, empty, or not given back by the
    tokens of A or of B have no tokens: zeros and empty ``groups``. Repeated rows and
    doc_ids are rows of their own, null doc_ids stay null, other columns are not looked
    at, an empty table gives no row. Long texts are aligned whole; a document is in one block.
    ``a_path`` and ``b_path`` name files that every executor has.
    """
    found = linked(docs, a_path, b_path, doc_id, text, digest)
    b_tokens = len(open_pair(a_path, b_path).b_size)
    scored = cut(pair_counts(found, b_tokens), "pairs")
    wanted = found.filter("keys IS NOT NULL").select(
        F.col("block").alias("of_block"), F.posexplode("keys").alias("place", "key"))
    answers = wanted.join(scored, "key").select("of_block", "place", "n", "best")
    rows = found.filter("keys IS NULL").drop("keys", "counts")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"

    def score(block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        n, best = np.zeros(len(counts), dtype=np.int64), np.zeros(len(counts), dtype=bool)
        n[counts["place"]], best[counts["place"]] = counts["n"], counts["best"]
        at, times = (np.frombuffer(b"".join(block[c]), dtype="<u4").astype(np.int64) for c in ("at", "times"))
        cuts = np.append(0, np.cumsum(block["at"].map(len).to_numpy() // 4))
        out = block[["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]].copy()
        out["doc_id"] = out["doc_id"].astype("Int64")
        for name, value in (("n_best", times * best[at]), ("count_sum", times * n[at])):
            sums = np.append(0, np.cumsum(value))
            out[name] = sums[cuts[1:]] - sums[cuts[:-1]]
        return out[[f.split()[0] for f in schema.split(", ")]]

    return rows.groupBy("block").cogroup(answers.groupBy("of_block")).applyInPandas(score, schema)
