"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many
of ``max_length`` as fit, then one for each set bit of the rest, longest first.
Pieces of equal length form a bucket, and every piece is a sequence of its own, so
no sequence crosses documents and none holds padding. Batches are drawn from one
bucket at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import MEMO_WORDS, crc32_ids, open_bpe
from .common import give_back


TOKENS_HELD = 1 << 20  # a task hands its pieces on after about this many tokens
STRINGS_HELD = 256  # so many of a batch's texts are Python strings at once


def _strings(column: pa.Array) -> Iterator[str | None]:
    """The texts of an Arrow column, which holds them in fewer bytes than Python does."""
    for at in range(0, len(column), STRINGS_HELD):
        yield from column.slice(at, STRINGS_HELD).to_pylist()


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Lengths of the pieces of ``n`` tokens: powers of two of at most ``max_length``."""
    full, rest = divmod(n, max_length)
    return [max_length] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, max_length: int = 4096, end_id: int = 2,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = True,
         memo_words: int = MEMO_WORDS, keep_memo: bool = True) -> DataFrame:
    """One row per piece of each document's tokens followed by ``end_id``:
    ``doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset, bucket``
    and, if asked for, ``ids``.

    ``max_length`` must be a power of two. A null or empty text is the one token
    ``end_id``. Documents are packed where they are read: no shuffle, no state
    across documents. ``sequence_id`` is unique in the result; equal rows give
    separate sequences; an empty table gives none. ``bucket`` is the power. A worker
    keeps the encoder after the job, and with ``keep_memo`` its memo of ``memo_words``
    words; without, the memo lasts for one task, and the memory it took goes back to the system.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")
    names = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "bucket"]
    schema = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, bucket int" + \
        ", ids array<int>" * with_ids

    def frame(owner, rows, tokens):
        columns = [owner, *(pa.array(c, pa.int64()) for c in zip(*rows))]
        bucket = pa.array([r[1].bit_length() - 1 for r in rows], pa.int32())
        if not with_ids:
            return pa.RecordBatch.from_arrays([*columns, bucket], names)
        cuts = np.cumsum([0, *(r[1] for r in rows)], dtype=np.int32)
        ids = pa.ListArray.from_arrays(cuts, np.concatenate(tokens).view(np.int32))
        return pa.RecordBatch.from_arrays([*columns, bucket, ids], [*names, "ids"])

    def run(batches):
        bpe, end = open_bpe(path, memo_words, together=True), np.array([end_id], dtype="<u4")
        for batch in batches:
            owner, at, rows, tokens, held = batch.column("doc_id"), [], [], [], 0
            for k, ids in enumerate(bpe.encode_whole(_strings(batch.column("text")))):
                ids = np.concatenate([ids, end])
                n, start = len(ids), 0
                for size in piece_lengths(n, max_length):
                    at.append(k)
                    rows.append((start, size, n, crc32_ids(ids[start:start + size])))
                    start += size
                if with_ids:
                    tokens.append(ids)
                held += n
                if held >= TOKENS_HELD:
                    yield frame(owner.take(pa.array(at)), rows, tokens)
                    at, rows, tokens, held = [], [], [], 0
            if rows:
                yield frame(owner.take(pa.array(at)), rows, tokens)
        if not keep_memo:
            bpe.forget()
            batch = owner = tokens = None
            give_back()

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return (source.mapInArrow(run, schema)
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
