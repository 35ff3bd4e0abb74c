"""Plain, slow versions of what the operators must give."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def shingles(text):
    words = [w for w in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked(rows):
    """[(doc_id, text)] -> {row: (n_shingles, component_id)} by comparing everything."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    for i, s in enumerate(sets):
        common = Counter(j for g in s for j in at[g] if j < i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = (len(sets[i]), min(ids) if ids else None)
    return [out[i] for i in range(len(rows))]


def without_repeats(rows, length=400):
    """[(doc_id, text)] -> [(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]."""
    data = [(t or "").encode() for _, t in rows]
    count = Counter(hash(d[i : i + length]) for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, np.int64)
        for i in range(len(d) - length + 1):
            if count[hash(d[i : i + length])] > 1:
                gone[i] += 1
                gone[min(len(d), i + length)] -= 1
        mask = np.cumsum(gone)[: len(d)] > 0
        spans = int(np.count_nonzero(np.diff(np.concatenate(([0], mask.astype(int)))) == 1))
        kept = bytes(np.frombuffer(d, np.uint8)[~mask])
        out.append((doc_id, len(d), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def crc(text):
    return zlib.crc32((text or "").encode())


def spoken(turns):
    """[(role, text)] -> the contract's digests."""
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def shares(sizes, share=1.5, cap=2.0, weights=(5, 2, 1)):
    """{source: size} -> {source: target}, by capping and sharing again until nothing is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: cap * sizes[s] for s in over}
        open_ -= over
    return target


def nearest(vectors, queries, k=20):
    """{id: vector} -> [(query, rank, id, score)]."""
    ids = np.array(sorted(vectors))
    m = np.array([vectors[i] for i in ids], np.float64)
    out = []
    for q in queries:
        score = (m * np.asarray(vectors[q], np.float64)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
        out += [(q, r + 1, int(ids[j]), score[j]) for r, j in enumerate(order)]
    return out
