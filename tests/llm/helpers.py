"""Small tables and brute-force versions for the operator tests."""

import hashlib
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [tuple(r) + (None,) * (4 - len(r)) + (None if r[1] is None else len(r[1]),) for r in rows]
    return spark.createDataFrame(full, DOCS)


def words(n, seed=0, vocabulary=5000):
    """n words drawn by a fixed linear congruence."""
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(f"w{x % vocabulary}")
    return out


def shingle_set(text, size):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) or frozenset([tuple(w)])


def brute_components(rows, size, percent):
    """doc_id -> (n_shingles, component_id) by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_repeats(rows, length=200):
    """Per row (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j : j + length] for _, b in raw for j in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def table(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
