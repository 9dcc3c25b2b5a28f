"""Byte-level BPE with a rank queue over a hierarchical bitmap.

The bytes of pre-tokens form linked lists of tokens. Every neighbouring pair whose joined
bytes are a token waits in the bucket of that token's rank, by the position of its left
half. One bit a rank tells whether its bucket holds anything, and one bit a word of those
bits whether the word does; find-first-set on the upper level and then in the word gives
the lowest rank without looking at any other. A merge changes the two pairs beside it:
their old entries stay where they are and are skipped when they come up. A merge costs a
few steps whatever the length of the pre-token, so one of a megabyte takes time in
proportion; short ones that the memo lacks go through the queue together, as lists of
their own.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 1 << 20   # texts are encoded in blocks of about so many characters
BLOCK_PIECES = 1 << 17  # a longer text in blocks of so many pre-tokens
MEMO_CHARS = 1 << 24    # a generation of the memo holds so many characters at most
WORD = 8  # a word of the bitmap holds 2**WORD ranks
LOW = (1 << WORD) - 1


class ByteBpe:
    """Encoder and decoder for a file of ``base64(token) rank`` lines.

    ``pattern`` splits a text into pre-tokens; each is encoded on its own. The memo holds
    up to ``cache_pieces`` pre-tokens twice over (a younger and an older generation).
    """

    def __init__(self, path: str, pattern: str, cache_pieces: int = 200_000):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks a single byte")
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self._longest = max(map(len, self.ranks))
        self._pattern = regex.compile(pattern)
        self._words = [0] * ((len(self.tokens) >> WORD) + 1)  # all zero between two merges
        self._limit, self._held = cache_pieces, 0
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token: always the lowest rank first, the leftmost of equal ranks."""
        ranks, longest, words = self.ranks, self._longest, self._words
        rank_of, line = ranks.get, b"".join(pieces)
        n = len(line)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # the rank under which the pair that begins here waits
        waits = [rank_of(line[i:i + 2]) for i in range(n)]
        begins = bytearray(n + 1)  # pre-tokens: no pair reaches over these
        at = 0
        for piece in pieces:
            begins[at], before[at] = 1, -1
            at += len(piece)
            waits[at - 1] = None
        begins[n] = 1
        buckets: dict[int, list[int]] = {}
        for i, rank in enumerate(waits):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
        top = 0
        for rank in buckets:
            words[rank >> WORD] |= 1 << (rank & LOW)
            top |= 1 << (rank >> WORD)
        while top:
            word = (top & -top).bit_length() - 1
            held = words[word]
            low = held & -held
            rank = word << WORD | low.bit_length() - 1
            words[word] = held ^ low
            if held == low:
                top ^= 1 << word
            bucket = buckets.pop(rank)
            bucket.sort()
            for done, i in enumerate(bucket, 1):
                if waits[i] != rank:
                    continue  # stale: the pair has changed since
                gone = after[i]
                after[i] = end = after[gone]
                waits[gone] = waits[i] = None
                lowest, left = rank, before[i]
                if not begins[end]:
                    before[end] = i
                    beyond = after[end]
                    if beyond - i <= longest and (made := rank_of(line[i:beyond])) is not None:
                        waits[i] = lowest = made
                        if made in buckets:
                            buckets[made].append(i)
                        else:
                            buckets[made] = [i]
                            words[made >> WORD] |= 1 << (made & LOW)
                            top |= 1 << (made >> WORD)
                if left >= 0:
                    waits[left] = made = rank_of(line[left:end]) if end - left <= longest else None
                    if made is not None:
                        if made < lowest:
                            lowest = made
                        if made in buckets:
                            buckets[made].append(left)
                        else:
                            buckets[made] = [left]
                            words[made >> WORD] |= 1 << (made & LOW)
                            top |= 1 << (made >> WORD)
                if lowest < rank and done < len(bucket):
                    # a lower rank has come up: the rest of this bucket waits again
                    buckets[rank] = bucket[done:]
                    words[word] |= low
                    top |= 1 << word
                    break
        out, at = [], 0
        for piece in pieces:
            ids, stop = [], at + len(piece)
            while at < stop:
                end = after[at]
                ids.append(ranks[line[at:end]])
                at = end
            out.append(ids)
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Afterwards the younger memo holds all of ``pieces``, as little-endian 32-bit ids."""
        if len(self._young) > self._limit or self._held > MEMO_CHARS:
            self._young, self._old, self._held = {}, self._young, 0
        young, old, rank_of = self._young, self._old, self.ranks.get
        parts, plain = [], []
        for piece in pieces.difference(young):
            ids = old.get(piece)
            if ids is None:
                raw = piece.encode("utf-8")
                rank = rank_of(raw)
                if rank is None:
                    parts.append(raw)
                    plain.append(piece)
                    continue
                ids = rank.to_bytes(4, "little")
            young[piece] = ids
            self._held += len(piece)
        for piece, ids in zip(plain, self.merge(parts) if parts else ()):
            young[piece] = array("I", ids).tobytes()
            self._held += len(piece)

    def _blocks(self, text: str) -> Iterator[list[str]]:
        if len(text) <= BLOCK_CHARS:
            yield self._pattern.findall(text)
            return
        found = (m.group() for m in self._pattern.finditer(text))
        while block := list(islice(found, BLOCK_PIECES)):
            yield block

    def encode(self, texts) -> Iterator[tuple[int, np.ndarray]]:
        """``(number of the text, ids of a block of it)`` in order; a text of no pre-token
        (None, empty) has none. Short texts are taken together."""
        held: list[tuple[int, list[str]]] = []
        size = 0
        for number, text in enumerate(texts):
            for pieces in self._blocks(text or ""):
                held.append((number, pieces))
                size += sum(map(len, pieces)) if len(text or "") > BLOCK_CHARS else len(text or "")
                if size >= BLOCK_CHARS:
                    yield from self._encoded(held)
                    held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, held: list[tuple[int, list[str]]]) -> Iterator[tuple[int, np.ndarray]]:
        self._learn(set().union(*[pieces for _, pieces in held]))
        ids_of = self._young.__getitem__
        for number, pieces in held:
            if pieces:
                yield number, np.frombuffer(b"".join(map(ids_of, pieces)), dtype="<u4")

    def encode_whole(self, texts) -> list[np.ndarray]:
        """The ids of each text."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        for number, ids in self.encode(texts):
            parts[number].append(ids)
        return [np.concatenate(p) if p else np.empty(0, dtype="<u4") for p in parts]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_OPEN: dict[tuple[str, str], ByteBpe] = {}


def open_byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The worker process's encoder for a vocabulary file (loaded once)."""
    if (path, pattern) not in _OPEN:
        _OPEN[path, pattern] = ByteBpe(path, pattern)
    return _OPEN[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column ``ids`` of the whole text's token ids.

    Null and empty texts get an empty array; texts and pre-tokens may be of any length.
    Each row is encoded by itself, so repeated rows get equal arrays and an empty table
    stays empty. Other columns stay as they are; one named as ``ids`` is replaced.
    ``path`` names a vocabulary file that every executor has.
    """
    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        bpe = open_byte_bpe(path, pattern)
        return pd.Series([ids.astype(np.int32) for ids in bpe.encode_whole(list(texts))], dtype=object)
    return docs.withColumn(ids, run(F.col(text)))


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of ``ids`` as a binary column (ids cut anywhere need not be
    UTF-8); null ids decode to no bytes."""
    @F.pandas_udf("binary")
    def run(arrays: pd.Series) -> pd.Series:
        bpe = open_byte_bpe(path, pattern)
        return pd.Series([b"" if a is None else bpe.decode(a) for a in arrays])
    return docs.withColumn(decoded, run(F.col(ids)))


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode and fingerprint in one pass without a shuffle: ``doc_id, n_tokens,
    ids_sha256`` (of little-endian unsigned 32-bit ids) and ``decoded_sha256``.

    One row a row of ``docs``, null doc_ids and repeated rows included; a null or empty
    text has no token and the digests of no bytes. A long text is hashed block by block,
    so a task holds one block of it beside the text. An empty table gives no row.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        bpe = open_byte_bpe(path, pattern)
        for batch in batches:
            n = np.zeros(len(batch), dtype=np.int64)
            packed, plain = ([hashlib.sha256() for _ in n] for _ in range(2))
            for number, ids in bpe.encode(batch["text"]):
                n[number] += len(ids)
                packed[number].update(ids)
                plain[number].update(bpe.decode(ids.tolist()))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_tokens": n,
                                "ids_sha256": [h.hexdigest() for h in packed],
                                "decoded_sha256": [h.hexdigest() for h in plain]})
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)
