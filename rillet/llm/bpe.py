"""BPE encoding and decoding with exact merges in linear time.

A word is covered left to right by longest vocabulary matches, which one
Aho-Corasick pass over the word finds for all positions. Two neighbouring tokens
may stand side by side only if merging their joined text would give back just
these two; a pair-compatibility table, filled on demand from the merge tree,
answers that. Where no longest match is compatible, shorter prefixes are tried
and dead positions are marked, so no position is entered twice. The result is the
tokenization that applying the merges in order gives.

Texts are encoded in blocks: Arrow finds a block's different words, only these are
looked up or encoded, and their ids are gathered for every place where they stand.

Decoding gathers the tokens' texts from one blob through a table of offsets.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the split pattern of the supported file kind.
LATIN_SPLIT_OF = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BEYOND_LATIN = re.compile("[\u0250-\U0010ffff]")
BLANK_BYTE = np.isin(np.arange(256), list(b" \t\n\r\x0b\f"))  # as bytes.split() has it
BLANK_AT = re.compile(rb"[ \t-\r]").search
BLOCK_CHARS = 1 << 21  # texts are encoded in blocks of about so many characters
NEVER = np.iinfo(np.int32).max  # the rank of pairs that do not merge
WIDTHS = (6, 8, 10, 12, 16, 24, 32)  # words merged side by side are padded to one of these
FEW = 100  # fewer words are encoded one by one
END = "\ue000"  # stands for the end-of-word suffix: one character for the automaton


def _slots(keys: np.ndarray, slots: int) -> np.ndarray:
    """Places in a hash table of a power of two ``slots``."""
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - slots.bit_length())).astype(np.int64)


class WordBpe:
    """Encoder and decoder for a ``tokenizers`` file of a BPE with end-of-word suffix.

    Normalizer and pre-tokenizer of the file are used as they are; merges, added
    tokens and decoding are done here. ``cache_words`` bounds the memo: two
    generations of that many words, so that words in use outlive the rare ones.
    ``together`` merges the short ones of a block's new words side by side.
    """

    def __init__(self, path: str, cache_words: int = 400_000, together: bool = False):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix:
            raise ValueError("a BPE with an end-of-word suffix is needed")
        lib = Tokenizer.from_file(path)
        self._normalize, self._split = lib.normalizer.normalize_str, lib.pre_tokenizer.pre_tokenize_str
        special = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        self._special = dict(special)
        self._special_re = re.compile("(" + "|".join(re.escape(s) for s, _ in special) + ")") if special else None
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        size = max([*vocab.values(), *self._special.values()]) + 1

        def key(token):
            return token[: -len(suffix)] + END if token.endswith(suffix) else token

        # Merge tree: halves of each token, rank of the merge that makes it, pair -> token.
        self.left, self.right, self.pairs = list(range(size)), list(range(size)), {}
        self.rank = [-1] * size
        for r, (a, b) in enumerate(merges):
            ia, ib, made = vocab[a], vocab[b], vocab[a + b]
            self.pairs[ia, ib] = made
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = ia, ib, r
        self.merge_rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        self._fits: dict[int, bool] = {}
        self._together = together
        if together:  # a hash table of the pairs, by levels: what finds its slot taken goes to the next
            self._made = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
            pair = np.array([a * size + b for a, b in self.merge_rank], dtype=np.int64)
            ranks = np.array(list(self.merge_rank.values()), dtype=np.int32)
            self._table, slots = [], 1 << (4 * len(pair)).bit_length()
            while len(pair):
                slot, first = np.unique(_slots(pair, slots), return_index=True)
                held = np.full(slots, -1, dtype=np.int64), np.full(slots, NEVER, dtype=np.int32)
                held[0][slot], held[1][slot] = pair[first], ranks[first]
                self._table.append(held)
                pair, ranks, slots = np.delete(pair, first), np.delete(ranks, first), max(slots >> 2, 1 << 10)
        # Only tokens that their own merges rebuild can appear in an encoding.
        sound = [False] * size
        for i in sorted(vocab.values(), key=lambda i: self.rank[i]):
            a, b, r = self.left[i], self.right[i], self.rank[i]
            sound[i] = r < 0 or sound[a] and sound[b] and self._no_earlier(a, b, r)
        self._length, self._match = [0] * size, ahocorasick.Automaton()
        by_key = {}
        for token, i in vocab.items():
            if sound[i]:
                k = key(token)
                by_key[k] = i
                self._length[i] = len(k)
                if len(k) > 1:  # single characters are looked up where nothing longer matches
                    self._match.add_word(k, i)
        self._match.make_automaton()
        self._by_key = by_key
        # Symbols of single characters, inside a word and at its end; the last entry is for all others.
        self._first, self._last = (np.array([by_key.get(chr(c) + end, -1) for c in range(0x180)] + [-1], dtype=np.int32)
                                   for end in ("", END))
        # The longest token that is a proper prefix of each token, or -1.
        self._shorter = [-1] * size
        for k, i in by_key.items():
            self._shorter[i] = next((by_key[k[:n]] for n in range(len(k) - 1, 0, -1) if k[:n] in by_key), -1)
        # Decoding: all token texts in one blob, and where each begins.
        texts = [b""] * size
        for token, i in [*vocab.items(), *special]:
            texts[i] = token.encode("utf-8")
        self._known = np.array([bool(t) for t in texts])
        self.offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(t + b" " for t in texts), dtype=np.uint8)
        # Plain split of words within the Latin blocks, whose categories are settled;
        # other words go through the file's own pre-tokenizer.
        latin = [chr(c) for c in range(0x250)]
        letters = "".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == "L")
        digits = "".join(re.escape(c) for c in latin if unicodedata.category(c)[0] == "N")
        pattern = f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+"
        split = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        plain = [p["pattern"].get("Regex") for p in split] == [LATIN_SPLIT_OF]
        self._latin_split = re.compile(pattern).findall if plain else None
        self._bytes_as = {b: self._split_one(bytes([b])) for b in range(256)}
        self._limit = cache_words
        self._chunks: dict[bytes, bytes] = {}  # ids as little-endian 32-bit numbers
        self._older: dict[bytes, bytes] = {}
        self._words: dict[str, bytes] = {}

    # -- pair compatibility ---------------------------------------------------

    def _no_earlier(self, a: int, b: int, limit: float) -> bool:
        """True if no merge of a rank under ``limit`` joins text across the seam of
        tokens ``a`` and ``b`` while they are being built.

        Walks the right spine of ``a`` and the left spine of ``b`` back in time:
        what was made last is undone first, and the two tokens that touch the seam
        at each moment must not have merged before one of them was made into more.
        """
        rank, pair_rank = self.rank, self.merge_rank
        until = limit
        while True:
            r = pair_rank.get((a, b))
            if r is not None and r < until:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            # Equal merges happen from left to right: b's came after a's, and a seam
            # pair of the same rank comes after a merge on its left, before one on its right.
            if ra > rb:
                until, a = ra, self.right[a]
            else:
                until, b = rb + 1, self.left[b]

    def _fit(self, a: int, b: int) -> bool:
        if len(self._fits) > 300_000:
            self._fits.clear()
        got = self._fits[a << 32 | b] = self._no_earlier(a, b, float("inf"))
        return got

    # -- words ----------------------------------------------------------------

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token (in the byte-level alphabet)."""
        text = word + END
        whole = self._by_key.get(text)
        if whole is not None:
            return (whole,)
        n = len(text)
        longest = [-1] * (n + 1)
        length, shorter, known, single = self._length, self._shorter, self._fits, self._by_key.get
        for end, token in self._match.iter(text):  # ends grow: the longest comes last
            longest[end + 1 - length[token]] = token
        dead = bytearray(n + 1)
        out: list[int] = []
        pos, token, last = 0, longest[0], -1
        if token < 0:
            token = single(text[0], -1)
        while pos < n:
            while token >= 0:
                if not dead[pos + length[token]]:
                    if last < 0:
                        break
                    ok = known.get(last << 32 | token)
                    if self._fit(last, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                pos += length[token]
                last, token = token, longest[pos]
                if token >= 0 or pos == n:
                    continue
                token = single(text[pos], -1)
                if token >= 0:
                    continue
            # no token goes on from here: take the last one back, try a shorter one
            dead[pos] = 1
            if not out:
                raise ValueError("the vocabulary does not cover this text")
            token = out.pop()
            pos -= length[token]
            token, last = shorter[token], out[-1] if out else -1
        return tuple(out)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each two neighbouring symbols, ``NEVER`` for none."""
        key = a.astype(np.int64) * len(self.rank) + b
        key[(a < 0) | (b < 0)] = -1
        out = np.full(key.shape, NEVER, dtype=np.int32)
        open_ = np.flatnonzero(key >= 0)
        flat, key = out.reshape(-1), key.reshape(-1)[open_]
        for keys, ranks in self._table:
            slot = _slots(key, len(keys))
            there = keys[slot]
            hit = there == key
            flat[open_[hit]] = ranks[slot[hit]]
            later = ~hit & (there >= 0)
            open_, key = open_[later], key[later]
            if not len(open_):
                break
        return out

    def _merge_all(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of symbols (-1 behind the last) merged side by side: a round makes the
        leftmost merge of the lowest rank in every row that has one."""
        done, rows = np.full_like(symbols, -1), np.arange(len(symbols))
        ranks = self._ranks(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            width = symbols.shape[1]
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(rows), dtype=np.int64)
            rank = ranks[np.arange(len(rows)), at] if width > 1 else np.full(len(rows), NEVER)
            live = rank < NEVER
            if not live.all():
                done[rows[~live], :width] = symbols[~live]
                rows, symbols, ranks, at, rank = rows[live], symbols[live], ranks[live], at[live], rank[live]
                if not len(rows):
                    break
            every, column, here = np.arange(len(rows)), np.arange(width - 1), at[:, None]
            symbols = np.take_along_axis(symbols, column + (column > here), axis=1)
            symbols[every, at] = self._made[rank]
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= here), axis=1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            i, j = np.append(left, right), np.append(at[left] - 1, at[right])
            ranks[i, j] = self._ranks(symbols[i, j], symbols[i, j + 1])
        return done

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit numbers: short ones are merged
        together, the others go through :meth:`encode_word`."""
        out: list[bytes | None] = [None] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        ends = np.cumsum(size)
        points = np.minimum(points, len(self._first) - 1)
        symbols, last = self._first[points], self._last[points[ends - 1]] if len(words) else points
        low = 1
        for high in WIDTHS:
            some = np.flatnonzero((size > low) & (size <= high))
            low = high
            if not len(some):
                continue
            column = np.arange(size[some].max())
            inside = column < size[some, None]
            rows = np.where(inside, symbols[np.where(inside, (ends - size)[some, None] + column, 0)], -1)
            rows[np.arange(len(some)), size[some] - 1] = last[some]
            known = (rows >= 0).sum(axis=1) == size[some]
            some, rows = some[known], self._merge_all(rows[known])
            packed = rows[rows >= 0].astype("<u4").tobytes()
            cuts = np.append(0, np.cumsum((rows >= 0).sum(axis=1) * 4)).tolist()
            for n, x, y in zip(some.tolist(), cuts, cuts[1:]):
                out[n] = packed[x:y]
        return [array("I", self.encode_word(w)).tobytes() if ids is None else ids for w, ids in zip(words, out)]

    @staticmethod
    def _split_one(byte: bytes) -> str:
        """The byte-level alphabet: printable Latin-1 bytes are themselves, the others
        follow from U+0100 on in order."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        b = byte[0]
        return chr(b) if b in printable else chr(0x100 + sum(x not in printable for x in range(b)))

    def _pieces(self, chunk: bytes) -> list[str]:
        word = chunk.decode("utf-8")
        if self._latin_split is not None and chunk.isalpha():
            return [word]
        if self._latin_split is not None and word.isascii():
            return self._latin_split(word) if word.isprintable() else [
                p.translate(self._bytes_as) for p in self._latin_split(word)]
        if self._latin_split is None or max(word) > "\u024f":
            return [piece for piece, _ in self._split(word)]
        return [p.encode("utf-8").decode("latin-1").translate(self._bytes_as) for p in self._latin_split(word)]

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of these different blank-delimited chunks, which the younger memo then holds."""
        if len(self._chunks) >= self._limit:
            self._chunks, self._older = {}, self._chunks
        young, older, words = self._chunks, self._older.get, self._words
        if len(words) >= self._limit:
            words.clear()
        found = list(map(young.get, chunks))
        new = []
        for n, chunk in enumerate(chunks):
            if found[n] is None:
                ids = older(chunk)
                if ids is None:
                    new.append((n, self._pieces(chunk)))
                else:
                    young[chunk] = found[n] = ids
        wanted = list({piece for _, pieces in new for piece in pieces}.difference(words))
        if self._together and len(wanted) >= FEW:
            words.update(zip(wanted, self.encode_words(wanted)))
        else:
            words.update((w, array("I", self.encode_word(w)).tobytes()) for w in wanted)
        for n, pieces in new:
            ids = words[pieces[0]] if len(pieces) == 1 else b"".join([words[p] for p in pieces])
            young[chunks[n]] = found[n] = ids
        return found

    # -- texts ----------------------------------------------------------------

    def _normal(self, part: str) -> bytes:
        """A text without special tokens, normalized. White space is dropped by the
        pre-tokenizer and ends every match, so blank-separated chunks can be encoded, and
        remembered, on their own."""
        if part.isascii():
            return part.encode("utf-8").lower()
        if self._latin_split and not BEYOND_LATIN.search(part):  # composed already, no contextual case
            return part.lower().replace("\x85", " ").replace("\xa0", " ").encode("utf-8")
        return self._normalize(part).encode("utf-8")

    def _gathered(self, lines: list[bytes]) -> list[np.ndarray]:
        """Ids of each normalized text of a block."""
        data = np.frombuffer(b" ".join([*lines, b""]), dtype=np.uint8)
        solid = ~BLANK_BYTE[data]
        turns = np.flatnonzero(np.diff(solid, prepend=False))  # the last byte is a blank
        starts, sizes = turns[::2], turns[1::2] - turns[::2]
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(np.append(0, np.cumsum(sizes))), pa.py_buffer(data[solid])]).dictionary_encode()
        at, found = words.indices.to_numpy(), self._learn(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        held = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) >> 2
        times = held[at]
        ends = np.append(0, np.cumsum(times))
        begin = np.cumsum(held) - held
        ids = np.frombuffer(b"".join(found), dtype="<u4")[
            np.arange(ends[-1]) + np.repeat(begin[at] - ends[:-1], times)]
        cuts = np.cumsum([0, *(len(line) + 1 for line in lines)])
        cuts = ends[np.searchsorted(starts, cuts)].tolist()
        return [ids[x:y] for x, y in zip(cuts, cuts[1:])]

    def _in_blocks(self, line: bytes) -> Iterator[bytes]:
        """A long normalized text, cut at blanks."""
        start = 0
        while start < len(line):
            blank = BLANK_AT(line, start + BLOCK_CHARS)
            end = blank.start() if blank else len(line)
            yield line[start:end]
            start = end

    def _parts(self, text: str) -> list[bytes | int]:
        """A text's normalized parts and, between them, the ids of its special tokens."""
        if not (self._special_re and "<" in text):
            return [self._normal(text)]
        parts = [p for p in self._special_re.split(text) if p]
        return [self._special[p] if p in self._special else self._normal(p) for p in parts]

    def _joined(self, held: list[list[bytes | int]]) -> Iterator[np.ndarray]:
        """Ids of texts given as parts."""
        found = iter(self._gathered([p for parts in held for p in parts if not isinstance(p, int)]))
        for parts in held:
            ids = [np.array([p], dtype="<u4") if isinstance(p, int) else next(found) for p in parts]
            yield ids[0] if len(ids) == 1 else np.concatenate([np.empty(0, dtype="<u4"), *ids])

    def encode_whole(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each whole text, as little-endian unsigned 32-bit numbers; None is
        the empty text. Short texts are taken together, so a task holds a block of them."""
        held: list[list[bytes | int]] = []
        size = 0
        for text in texts:
            if text and len(text) > BLOCK_CHARS:
                yield from self._joined(held)
                held, size = [], 0
                blocks = ([p] if isinstance(p, int) else self._in_blocks(p) for p in self._parts(text))
                yield np.concatenate([np.empty(0, dtype="<u4"), *(next(self._joined([[b]])) for part in blocks for b in part)])
                continue
            held.append(self._parts(text) if text else [])
            size += len(text or "") + 1
            if size >= BLOCK_CHARS:
                yield from self._joined(held)
                held, size = [], 0
        yield from self._joined(held)

    def forget(self) -> None:
        """Empties the memo."""
        self._chunks, self._older, self._words = {}, {}, {}
        self._fits.clear()

    def packed(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit numbers; None is the empty text."""
        return next(self.encode_whole([text])).tobytes()

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; None is the empty text."""
        return next(self.encode_whole([text])).tolist()

    def decode_bytes(self, ids) -> bytes:
        """UTF-8 text of ``ids``: the tokens' texts joined by one blank each."""
        ids = np.asarray(ids, dtype=np.int64)
        ids = ids[self._known[ids]] if len(ids) else ids
        if not len(ids):
            return b""
        start, size = self.offsets[ids], np.diff(self.offsets)[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.blob[at].tobytes()[:-1]


_OPEN: dict[tuple[str, int, bool], WordBpe] = {}
MEMO_WORDS = 400_000


def open_bpe(path: str, memo_words: int = MEMO_WORDS, together: bool = False) -> WordBpe:
    """The worker process's encoder for a vocabulary file and size of memo (loaded once)."""
    if (path, memo_words, together) not in _OPEN:
        _OPEN[path, memo_words, together] = WordBpe(path, memo_words, together)
    return _OPEN[path, memo_words, together]


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with an array column ``ids`` of the whole text's token ids.

    Null and empty texts get an empty array. Existing columns stay, but for one
    named as ``ids``, which is replaced. ``path`` names a vocabulary file that
    every executor has.
    """
    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        bpe = open_bpe(path)
        return pd.Series([ids.view("<i4") for ids in bpe.encode_whole(texts)], dtype=object)
    return docs.withColumn(ids, run(F.col(text)))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with a column ``text`` decoded from ``ids``; null ids decode to ''."""
    @F.pandas_udf("string")
    def run(arrays: pd.Series) -> pd.Series:
        bpe = open_bpe(path)
        return pd.Series([bpe.decode_bytes(a if a is not None else []).decode("utf-8") for a in arrays])
    return docs.withColumn(text, run(F.col(ids)))


def digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode and fingerprint in one pass: ids and decoded texts stay in the
    task, and ``doc_id, n_tokens, ids_sha256, decoded_sha256`` come out."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        bpe = open_bpe(path)
        for batch in batches:
            rows = []
            for ids in bpe.encode_whole(batch["text"]):
                rows.append((len(ids), hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest(),
                             hashlib.sha256(bpe.decode_bytes(ids)).hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)


def crc32_ids(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
