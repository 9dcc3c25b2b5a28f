"""Plain versions of byte-level BPE, cross-tokenizer alignment and conversation repair."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import public_tokenizers as P
import sentencepiece
import tiktoken
from tokenizers import Tokenizer


def tiktoken_encoding():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def align(docs):
    """Rows of op12 (groups as text) from (doc_id, text) pairs, all token pairs compared."""
    a_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in seen}
    for b in range(256):
        if b not in seen:
            byte_of[chr(256 + len(byte_of) - len(seen))] = b
    vocab = a_lib.get_vocab(with_added_tokens=False)
    a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items() if all(c in byte_of for c in t)}

    def b_of(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    linked, counts = [], Counter()
    for doc_id, text in docs:
        a = b = []
        links, groups = [], ""
        if text:
            raw = (" " + text).encode()
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            if b"".join(a_bytes[i] for i in a) != raw or b"".join(map(b_of, b)) != raw:
                a = b = []
            spans = []
            for ids, of in ((a, a_bytes.get), (b, b_of)):
                at, out = 0, []
                for i in ids:
                    out.append((at, at + len(of(i)), i))
                    at += len(of(i))
                spans.append(out)
            links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if max(x[0], y[0]) < min(x[1], y[1])]
            cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
            groups = ";".join("|".join(",".join(str(i) for s, e, i in side if lo <= s and e <= hi) for side in spans)
                              for lo, hi in zip([0, *cuts], cuts))
        counts.update(links)
        linked.append((doc_id, a, b, links, groups))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(d, len(a), len(b), groups.count("|"), len(links), sum(counts[p] == best[p[1]] for p in links),
             sum(counts[p] for p in links), groups) for d, a, b, links, groups in linked]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def repair(rows, convs):
    """Rows of op13 from damaged (conv, turn, role, text) rows in order and all conversations."""
    out = []
    for conv in convs:
        mine = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0))
        faults, seen = [], set()
        for _, _, role, text in mine:
            core = text.strip(" \t\n\x0b\x0c\r")
            faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else ".")
            seen.add((role, text))

        @lru_cache(None)
        def best(i, state, inserted=0):
            """Least (cost, audit, lines) from row i; state is the last initial kept."""
            found = []
            if i == len(mine):
                if state in ("", "a"):
                    found.append((0, "", ()))
            else:
                _, _, role, text = mine[i]
                c, audit, lines = best(i + 1, state)
                found.append((4 + c, "D" + audit, lines))
                if faults[i] not in "bd":
                    more = 3 if faults[i] == "t" else 0
                    first = role[:1]
                    if first and (state + first in ("s", "u", "su", "ua", "au")):
                        c, audit, lines = best(i + 1, first)
                        found.append((more + c, "K" + audit, (f"{role}:{text}", *lines)))
                    new = "assistant" if state == "u" else "user"
                    c, audit, lines = best(i + 1, new[0])
                    found.append((3 + more + c, "R" + audit, (f"{new}:{text}", *lines)))
            if inserted < 3:
                new = "assistant" if state == "u" else "user"
                c, audit, lines = best(i, new[0], inserted + 1)
                found.append((3 + c, "I" + audit, (f"{new}:", *lines)))
            return min(found) if found else (10**9, "", ())

        cost, audit, lines = best(0, "")
        turns = [r[1] for r in mine if r[1] is not None]
        roles = [r[2][:1] for r in mine]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"),
                    faults.count("d"), faults.count("t"),
                    sum(x + y not in ("su", "ua", "au") for x, y in zip(roles, roles[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out
