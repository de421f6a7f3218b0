"""Plain versions of the operators, for comparison."""

import hashlib
import zlib

import numpy as np


def words(text):
    return (text or "").encode().split()


def packing_ok(rows, ids_of, window=2048):
    """rows: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ids_of: doc_id to ids. Returns padding."""
    sequences, spans = {}, {}
    for d, s, n, crc, total, q, o in sorted(rows, key=lambda r: (r[5], r[6])):
        ids = ids_of[d]
        assert total == len(ids) and 0 < n and s + n <= total
        assert crc == zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())
        assert sequences.get(q, 0) == o
        sequences[q] = o + n
        spans.setdefault(d, []).append((s, n))
    for d, found in spans.items():
        at = 0
        for s, n in sorted(found):
            assert s == at
            at += n
        assert at == len(ids_of[d])
    assert set(spans) == set(ids_of) and all(v <= window for v in sequences.values())
    return sum(0 if v & (v - 1) == 0 else window - v for v in sequences.values())


def strip(docs, window=50):
    """doc_id to (n_words, n_removed, kept) for [(doc_id, text)], doc_ids distinct."""
    first = {}
    for d, t in sorted(docs):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = b"\1" * window
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), len(w) - len(kept), b" ".join(kept))
    return out


def sha(kept):
    return hashlib.sha256(kept).hexdigest()


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs, n=3, percent=90):
    """doc_id to (set size, component) for [(doc_id, text)]."""
    sets = {d: shingles(t, n) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(d for d in sets if sets[d])
    for i, a in enumerate(names):
        for b in names[:i]:
            x, y = len(sets[a]), len(sets[b])
            if 100 * min(x, y) < percent * max(x, y):
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (x + y - both):
                u, v = find(a), find(b)
                parent[max(u, v)] = min(u, v)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def nearest(vectors, query, k=5):
    """[(vec_id, cosine)] of the k nearest of {vec_id: vector} to the row query."""
    q = np.array(vectors[query], float)
    found = [(-float(q @ np.array(v) / (np.linalg.norm(q) * np.linalg.norm(v))), i) for i, v in vectors.items() if i != query]
    return [(i, -c) for c, i in sorted(found)[:k]]
