"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, size: int) -> frozenset:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_duplicates(rows: list[tuple], size: int, percent: int) -> dict:
    """doc_id -> (number of shingles, component)."""
    sets = {i: shingles(t, size) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for x in ids:
        for y in ids:
            if x < y and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeated_bytes(rows: list[tuple], length: int = 200) -> Counter:
    """(doc_id, bytes, removed, spans, digest of the rest) of every row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out: Counter = Counter()
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        rest = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out[(i, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())] += 1
    return out
