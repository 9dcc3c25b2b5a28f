"""Encoding whole blocks of texts gives what one text at a time gives."""

import random
import zlib
from unittest.mock import MagicMock

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rillet.llm import bpe, packing
from rillet.llm.common import give_back
from rillet.llm.queries import vocabulary


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    some = "abcdefghijklmnopqrstuvwxyzaeiou  \n\t.,'\"0ÄéÀß \u0085日​<|>"
    out = ["".join(r.choice(some) for _ in range(r.choice([0, 3, 30, 400]))) + ("<|endoftext|>" if r.random() < .2 else "")
           + "".join(r.choice("aeinrst") for _ in range(r.randrange(60))) for _ in range(400)]
    return [*out, None, "", "  \n", "<|endoftext|>", "<|ENDOFTEXT|>", "x" * 3000, "ab " * 500 + "<|endoftext|>cd"]


@pytest.mark.parametrize("together", [False, True])
@pytest.mark.parametrize("block", [1, 300, 1 << 21])
def test_blocks_of_texts_are_encoded_as_the_library_does(texts, together, block, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
    monkeypatch.setattr(bpe, "FEW", 1)
    mine = bpe.WordBpe(vocabulary(), 300, together)
    lib = Tokenizer.from_file(vocabulary())
    lib.no_truncation(), lib.no_padding()
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in mine.encode_whole(texts)] == want
    assert list(mine.encode_whole([])) == []


def test_short_words_are_merged_together(texts, monkeypatch):
    mine, single = bpe.WordBpe(vocabulary(), together=True), bpe.WordBpe(vocabulary())
    words = sorted({"".join(c for c in w if c.isascii() and c.isalpha()) for t in texts if t for w in t.split()} - {""})
    short = [w for w in words if 1 < len(w) <= bpe.WIDTHS[-1]]
    want = [np.array(single.encode_word(w), dtype="<u4").tobytes() for w in words]
    alone = []
    one = mine.encode_word
    monkeypatch.setattr(mine, "encode_word", lambda w: (alone.append(w), one(w))[1])
    assert mine.encode_words(words) == want
    assert len(short) > 50 and not set(alone) & set(short)


def test_packing_leaves_no_memo_behind(spark):
    docs = spark.createDataFrame([(n, f"some words of text {n}") for n in range(40)], "doc_id long, text string").coalesce(1)

    def held(batches):
        for _ in batches:
            pass
        words = [len(b._chunks) + len(b._older) + len(b._words) for key, b in bpe._OPEN.items() if key[1:] == (777, True)]
        yield pd.DataFrame({"words": words or [-1]})

    def after(**kw):
        packed = packing.pack(docs, vocabulary(), memo_words=777, **kw)
        rows = [tuple(r) for r in packed.orderBy("doc_id", "start").drop("sequence_id").collect()]
        return rows, spark.range(1).coalesce(1).mapInPandas(held, "words long").first().words

    kept, n = after()
    gone, none = after(keep_memo=False)
    assert kept == gone and len(kept) > 40
    assert none <= 0 and (n > 0 or n == -1)


def task_of(**kw):
    """The function that packing hands to Spark."""
    docs = MagicMock()
    packing.pack(docs, vocabulary(), **kw)
    return docs.select.return_value.mapInArrow.call_args[0][0]


def test_packing_gives_its_memory_back(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randrange(4, 12)))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1500)), "text": [
        " ".join(word() for _ in range(120)) for _ in range(1500)]})
    task = task_of(memo_words=200_000, keep_memo=False)

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) for line in f if line.startswith(("Pss_Anon", "Pss_Shmem"))) / 1024

    assert sum(out.num_rows for out in task([batch])) > 1500  # the encoder is there from now on
    give_back()
    before = held()
    peak = max(held() for _ in task([batch, batch]))
    after = held()
    give_back()
    assert peak > before + 30
    assert after < held() + 10 and after < before + 20


def test_packing_over_several_slices_of_a_batch(spark, texts, monkeypatch):
    monkeypatch.setattr(packing, "STRINGS_HELD", 7)
    monkeypatch.setattr(packing, "TOKENS_HELD", 500)
    ids = [None if n % 11 == 0 else n // 2 for n in range(len(texts))]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "text": texts})
    lib = Tokenizer.from_file(vocabulary())
    lib.no_truncation(), lib.no_padding()
    want = []
    for d, t in zip(ids, texts):
        tokens, start = [*lib.encode(t or "", add_special_tokens=False).ids, 2], 0
        for size in packing.piece_lengths(len(tokens), 64):
            piece = tokens[start:start + size]
            crc = zlib.crc32(np.array(piece, dtype="<u4").tobytes())
            want.append((d, start, size, len(tokens), crc, size.bit_length() - 1, piece))
            start += size
    for with_ids in (True, False):
        got = list(task_of(max_length=64, with_ids=with_ids)([batch.slice(0, 0), batch]))
        rows = [tuple(row.values()) for out in got for row in out.to_pylist()]
        assert rows == [w if with_ids else w[:-1] for w in want] and len(got) > 5
