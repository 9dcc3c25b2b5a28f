"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib

import numpy as np
import xxhash

KINDS = ("email", "ip", "card", "phone")
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_spans(text):
    out = []
    for rank, kind in enumerate(KINDS):
        for m in re.finditer(RULES[kind], text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


def pii_digest(text):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in pii_spans(text)).encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def substring_dedup(docs, length=13):
    first = {}
    for d, t in docs:
        if d is None:
            continue
        w = words(t)
        for i in range(len(w) - length + 1):
            k = tuple(w[i:i + length])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i:i + length])] < d:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def line_dedup(docs, least=10):
    def key(line):
        return lower_ascii(line.strip("\x20\t\n\x0b\x0c\r"))
    holders = {}
    for d, t in docs:
        if d is not None:
            for line in (t or "").split("\n"):
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(key(x)) < least or min(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def simhash(text, n=4, seed=42):
    w = words(lower_ascii(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_of(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def simhash_components(docs, distance=4):
    ids = [d for d, _ in docs]
    fp = np.array([simhash(t) for _, t in docs], dtype=np.uint64)
    links = [(ids[i], ids[j]) for i in range(len(ids))
             for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= distance) if j > i]
    comp = component_of(ids, links)
    return [(d, f"{f:016x}", comp[d]) for d, f in zip(ids, fp.tolist())]


def cosine_links(rows, least=0.93):
    """rows: (id, vector, label). Returns the set of linked index pairs."""
    ok = [i for i, (d, v, y) in enumerate(rows) if d is not None and y is not None and v is not None and len(v)
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = set()
    for a, i in enumerate(ok):
        for j in ok[a + 1:]:
            x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(x) == len(y):
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    out.add((i, j))
    return out


def topk(rows, k=5, scale=256):
    """rows: (id, vector); queries are ids divisible by 50."""
    ok = [(i, d, [int(np.floor(scale * float(x))) for x in v]) for i, (d, v) in enumerate(rows)
          if d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, d, q in ok:
        if d % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), e) for j, e, c in ok if j != i and len(c) == len(q))[:k]
            out += [(d, r + 1, e, -s) for r, (s, e) in enumerate(best)]
    return out


def fold(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts
