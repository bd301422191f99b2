"""Plain versions of the operators for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text):
    w = [lower(x) for x in WORD.findall(text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(rows):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id)], in order."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return out


def kept_bytes(rows, window=50):
    """[(doc_id, text)] -> [(doc_id, n_bytes, n_removed, n_spans, kept_sha256)], in order."""
    last = 2**63  # null
    data = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in data:
        for s in range(len(b) - window + 1):
            w = b[s : s + window]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - window + 1):
            if first[b[s : s + window]] < d:
                gone[s : s + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((None if d == last else d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def same(a, b):
    """Equal as multisets of rows."""
    return Counter(map(tuple, a)) == Counter(map(tuple, b))
