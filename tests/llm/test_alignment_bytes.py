"""The byte check of the alignment's tokens."""

import public_tokenizers

from rillet.llm import alignment


def test_pair_compares_each_pre_token_once():
    pair = alignment.Pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    seen = []

    class Counted(list):
        def __getitem__(self, i):
            seen.append(i)
            return list.__getitem__(self, i)

    pair.a_bytes = Counted(pair.a_bytes)
    (a, b), = pair.tokens(["word and " * 1000])
    assert len(a) >= 2000 and len(b) >= 2000
    assert len(seen) < 20
    # a pre-token whose tokens do not give it back leaves its whole text without tokens
    pair = alignment.Pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    pair.a_bytes[pair.a.encode(" word").ids[0]] = b"?"
    found = pair.tokens(["a word", "and so", "word"])
    assert [len(a) > 0 for a, _ in found] == [False, True, False]
    assert [len(b) > 0 for _, b in found] == [False, True, False]
