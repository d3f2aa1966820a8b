"""Plain, slow forms of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def least_reachable(nodes, links):
    part = {n: n for n in nodes}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        part[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    w = words((text or "").translate(UPPER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_duplicates(docs, size, percent=80):
    """{id: (set size, component)} of {id: text}."""
    sets = {i: shingles(t, size) for i, t in docs.items()}
    ids = sorted(docs)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]
    ]
    named = least_reachable(ids, links)
    return {i: (len(sets[i]), named[i]) for i in ids}


def remove_repeated(docs, length):
    """{id: (words, removed, kept text)} of {id: text}."""
    first = {}
    for i in sorted(docs):
        w = words(docs[i])
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k : k + length]), i)
    out = {}
    for i, t in docs.items():
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def near_vectors(vectors, cosine):
    """{id: (links, component)} of {id: list of floats}."""
    good = {
        i: np.array(v, float) for i, v in vectors.items()
        if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)
    }
    ids = sorted(good)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if len(good[a]) == len(good[b])
        and good[a] @ good[b] / np.sqrt((good[a] @ good[a]) * (good[b] @ good[b])) >= cosine
    ]
    count = defaultdict(int)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    named = least_reachable(vectors, links)
    return {i: (count[i], named[i]) for i in vectors}


def seats(targets, house):
    """Sainte-Laguë, one seat after another."""
    out = [0] * len(targets)
    for _ in range(house):
        best = max(range(len(targets)), key=lambda i: (targets[i] / (2 * out[i] + 1), -i))
        out[best] += 1
    return out


def filled(sizes, weights, share, most):
    """Targets by dealing out again and again."""
    target, stopped = [0.0] * len(sizes), set()
    while True:
        rest = share * sum(sizes) - sum(most * sizes[i] for i in stopped)
        w = sum(weights[i % len(weights)] for i in range(len(sizes)) if i not in stopped)
        new = set()
        for i, s in enumerate(sizes):
            target[i] = most * s if i in stopped else weights[i % len(weights)] * rest / w
            if target[i] >= most * s and i not in stopped:
                new.add(i)
        if not new:
            return target
        stopped |= new
