"""Plain versions of the operators, one document at a time, for small inputs."""

import hashlib

import numpy as np


class Groups:
    """Union-find whose roots are the smallest members."""

    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def root(self, n):
        while self.parent[n] != n:
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def near_duplicates(docs, n, similarity=80):
    """{doc: (set size, component, kept)} of (doc, text) pairs by comparing all pairs."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    groups = Groups([d for d, _ in sets])
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            both = len(x & y)
            if both and 100 * both >= similarity * (len(x) + len(y) - both):
                groups.join(a, b)
    return {d: (len(s), groups.root(d), groups.root(d) == d) for d, s in sets}


def remove_repeats(docs, window=50):
    """{doc: (words, removed, digest, kept words)} of (doc, text) pairs."""
    words = {d: (t or "").encode().split() for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i : i + window]), d)
    out = {}
    for d, own in words.items():
        keep = [True] * len(own)
        for i in range(len(own) - window + 1):
            if first[tuple(own[i : i + window])] < d:
                keep[i : i + window] = [False] * window
        left = [w for w, k in zip(own, keep) if k]
        text = b" ".join(left)
        out[d] = (len(own), keep.count(False), hashlib.sha256(text).hexdigest(), text.decode())
    return out


def linked_vectors(rows, threshold=0.93):
    """{id: (links, component, kept)} of (id, vector, label) rows."""
    groups = Groups([r[0] for r in rows])
    links = {r[0]: 0 for r in rows}
    good = []
    for i, v, label in rows:
        ok = v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)
        if ok and any(v):
            good.append((i, np.array(v, float) / np.linalg.norm(np.array(v, float)), label))
    for k, (a, x, p) in enumerate(good):
        for b, y, q in good[k + 1 :]:
            if p == q and len(x) == len(y) and float(x @ y) >= threshold:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    return {i: (links[i], groups.root(i), groups.root(i) == i) for i in links}


def pack_cost(total, documents, sentences, size, costs):
    """Least cost of cutting by trying every earlier place for every cut."""
    free = {0, total, *documents}
    bounds = free | set(sentences)
    ordered = sorted(bounds)
    longest = max(b - a for a, b in zip(ordered, ordered[1:]))
    inside = {b + size * k for b in bounds for k in range(1, longest // size + 2)} - bounds
    places = sorted(p for p in bounds | inside if p <= total)
    least = {0: 0.0}
    for p in places[1:]:
        penalty = 0.0 if p in free else costs.sentence if p in bounds else costs.inside
        found = []
        for q in places:
            length = p - q
            if 0 < length <= size and q in least:
                whole = p in free and length & (length - 1) == 0
                found.append(least[q] + (0 if whole else size - length))
        if found:
            least[p] = min(found) + penalty + costs.sequence
    return least[total]
