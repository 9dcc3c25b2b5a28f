"""Byte-level BPE, cross-tokenizer alignment and conversation repair against plain versions."""

import hashlib
import random
import struct

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import brute_tokens as plain
from rillet.llm import alignment, bytebpe, repair
from rillet.llm.queries import op11_byte_bpe, op12_token_alignment, op13_conversation_repair

SMALL = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_50k.tiktoken")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
rng = random.Random(11)
SCRAPS = ["ab", "aaaa", "the ", "éüñ ", "\n\t  ", "012", "中文字🙂", "\x1c\x85\xa0", " 's't", "<|endoftext|>", "<s>", "<0x41>",
          "▁", "՘࢏", "é", "​", "don't stop! ", "ﬁ", "İ", "\x00", "ᄀ", "𝒳", "  .  "]


def mixed(n):
    return "".join(rng.choice(SCRAPS) for _ in range(n))


TEXTS = [None, "", " ", "\n", "a", " a", "<|endoftext|>", "<s></s><unk>", "▁", "a▁b", "中文字", "x" * 3000, "ab" * 4000,
         "word " * 30_000, *[mixed(rng.choice([1, 2, 5, 20])) for _ in range(150)]]
ROWS = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(None, "null id", None, None), (3, "a second three", None, None),
                                                         (3, "a second three", None, None), (None, None, None, None)]
SCHEMA = "doc_id long, text string, block string, n_a string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4).cache()


def key(row):
    return [(x is None, x if x is not None else 0) for x in row]


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


# -- byte-level BPE ----------------------------------------------------------------

def test_byte_bpe_equals_the_library(spark, docs):
    lib = plain.tiktoken_encoding()

    def row(doc_id, text):
        ids = lib.encode_ordinary(text or "")
        return (doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest())

    same(bytebpe.digests(docs, RANKS, P.PATTERN).collect(), [row(r[0], r[1]) for r in ROWS])
    back = bytebpe.decode(bytebpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in back)
    assert all(r.ids == lib.encode_ordinary(r.text or "") for r in back)


def test_byte_bpe_of_very_long_pre_tokens_and_texts():
    lib, bpe = plain.tiktoken_encoding(), bytebpe.ByteBpe(RANKS, P.PATTERN, cache_pieces=50)
    long = ["a" * 100_000, "".join(rng.choice("abcdefghij") for _ in range(100_000)), mixed(150_000), "ab" * 50_001]
    for text, ids in zip(long, bpe.encode_whole(long)):
        assert ids.tolist() == lib.encode_ordinary(text)
    assert not any(bpe._words)  # every bit of the queue is off again


def test_byte_bpe_takes_the_leftmost_of_equal_ranks_and_lower_ranks_first(tmp_path):
    """A vocabulary whose merges bring up ranks below the one being worked on."""
    import base64
    import tiktoken
    tokens = [b"abcd", b"bcd", b"ab", b"cd", b"aa", b"aaa", b"ba"] + [bytes([b]) for b in range(256)]
    ranks = {t: i for i, t in enumerate(tokens)}
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
    lib = tiktoken.Encoding("odd", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = bytebpe.ByteBpe(str(path), P.PATTERN)
    texts = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    assert [i.tolist() for i in bpe.encode_whole(texts)] == [lib.encode_ordinary(t) for t in texts]


# -- alignment -----------------------------------------------------------------------

def test_overlaps_equal_all_pairs():
    for _ in range(500):
        end = 60
        a, b = ([*sorted(rng.sample(range(1, end), rng.randint(0, 30))), end] for _ in range(2))
        ia, ib, ends, both = alignment.overlaps(np.array(a), np.array(b), rng.choice([1, 2, 3, 7, 100]))
        spans = [list(zip([0, *x], x)) for x in (a, b)]
        want = [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if max(x[0], y[0]) < min(x[1], y[1])]
        assert sorted(zip(ia.tolist(), ib.tolist())) == want
        assert ends[both].tolist() == sorted({*a} & {*b})


def test_alignment_equals_all_pairs(spark, docs, monkeypatch):
    short = [r for r in ROWS if r[1] is None or len(r[1]) < 3000]
    want = plain.align([r[:2] for r in short])
    some = docs.filter("text IS NULL OR length(text) < 3000")
    same(alignment.align(some, A, B).collect(), want)
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in want]
    same(alignment.align(some, A, B, digest=True).collect(), hashed)


def test_alignment_in_small_blocks(monkeypatch):
    """Blocks, slices and pieces of other sizes give the same rows."""
    import pandas as pd
    pair = alignment.open_pair(A, B)
    frame = pd.DataFrame({"doc_id": range(len(TEXTS)), "text": TEXTS})

    def all_rows():
        found = [alignment._linked(pair, block) for block in alignment._blocks([frame], pair)]
        return [(r["doc_id"], r["n_a"], r["n_groups"], r["n_links"], r["groups"]) for rows, _, _ in found for r in rows]

    whole = all_rows()
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(alignment, "SLICE_CHARS", 300)
    assert all_rows() == whole


# -- conversation repair ---------------------------------------------------------------

ROLES = ["user", "assistant", "system", "tool", "", " ", "u", "User"]
SAYS = ["Yes.", "No!", "So", "", " \t", "What? ", "Yes."]


def conversation(conv, n):
    return [(conv, rng.choice([i, i, i, None, i + 2]), rng.choice(ROLES[:2] * 3 + ROLES), rng.choice(SAYS) + rng.choice(["", f"{rng.random()}."]))
            for i in range(n)]


@pytest.mark.parametrize("bits", [12, 1, 3])
def test_repair_equals_plain(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rows = []
    for conv in [*range(60), None]:
        mine = conversation(conv, rng.choice([0, 1, 2, 5, 9, 30]))
        # rows of one turn are in a fixed order only if alike: give each row a turn of its own
        turns = sorted(rng.sample(range(-5, 60), len(mine)))
        rows += [(conv, t, r[2], r[3]) for t, r in zip(turns, mine)]
        rows += [(conv, None, "user", "No turn."), (conv, None, "user", "No turn.")] if conv in (3, None) else []
        rows += [(conv, 70, None, "x."), (conv, 71, "user", None)] if conv in (4, 5) else []
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame([(*r, "extra", 1) for r in rows], schema + ", key string, at int").repartition(5)
    convs = list(dict.fromkeys(r[0] for r in rows))
    want = plain.repair(plain.damage(rows), convs)
    same(repair.repair(repair.damage(table), table).collect(), want)
    lines = {}
    for r in repair.repaired_turns(repair.damage(table)).orderBy("place").collect():
        lines.setdefault(None if r.conv_id is None else int(r.conv_id), []).append(f"{r.role}:{r.text}")
    digests = {r[0]: r[-1] for r in want}
    assert all(hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == digests[c] for c in convs)


def test_repair_of_one_long_conversation(spark, monkeypatch):
    """Blocks of one conversation over many partitions, most texts repeated."""
    monkeypatch.setattr(repair, "BLOCK_BITS", 4)
    rows = [(1, i, rng.choice(ROLES), rng.choice(SAYS)) for i in range(300)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    same(repair.repair(table, table).collect(), plain.repair(rows, [1]))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bytebpe.digests(docs, RANKS, P.PATTERN).collect() == []
    assert alignment.align(docs, A, B).collect() == []
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damage(none), none).collect() == []


def test_registered_queries(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    lib = plain.tiktoken_encoding()
    got = {r.doc_id: r for r in op11_byte_bpe(spark, SMALL).collect()}
    for doc_id, text in docs:
        ids = lib.encode_ordinary(text or "")
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256) == (
            len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
    short = sorted(docs, key=lambda r: len(r[1] or ""))[:60]
    got = {r.doc_id: r for r in op12_token_alignment(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for row in plain.align(short):
        r = got[row[0]]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == row[1:5]
        assert r.groups_sha256 == (hashlib.sha256(row[7].encode()).hexdigest() if row[1] else "")
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").orderBy("conv_id", "turn").collect()]
    same(op13_conversation_repair(spark, SMALL).collect(), plain.repair(plain.damage(rows), list(dict.fromkeys(r[0] for r in rows))))
