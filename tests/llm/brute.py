"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from math import log10

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def hexed(text):
    return hashlib.sha256(text.encode()).hexdigest()


class Sets:
    """Union-find that keeps the smallest member."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        a, b = self.find(x), self.find(y)
        self.parent[max(a, b)] = min(a, b)


def shingles(text):
    found = words((text or "").translate(LOWER))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i:i + 5]) for i in range(len(found) - 4))


def near_duplicates(docs, percent=85):
    """{doc_id: (size, component)} of {doc_id: text}"""
    sets = {i: shingles(t) for i, t in docs.items()}
    joined, index = Sets(), {}
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in index.get(s, ()))
        for j, both in shared.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                joined.join(i, j)
        for s in sets[i]:
            index.setdefault(s, []).append(i)
    return {i: (len(s), joined.find(i)) for i, s in sets.items()}


def remove_repeats(docs, width=20):
    """[(doc_id, words, removed, kept text)] of (doc_id, text) rows in order"""
    seen, out = set(), []
    for i, text in docs:
        found = words(text)
        gone = [False] * len(found)
        for at in range(len(found) - width + 1):
            window = tuple(found[at:at + width])
            if window in seen:
                gone[at:at + width] = [True] * width
            seen.add(window)
        out.append((i, len(found), sum(gone), " ".join(w for w, g in zip(found, gone, strict=True) if not g)))
    return out


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    found = words(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(found[i:i + 8]) for i in range(len(found) - 7)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed


def language_model(docs):
    """({doc_id: (held out, tokens, known, base score)}, N, V) of {doc_id: text}"""
    cut = {i: [*words((t or "").translate(LOWER)), None] for i, t in docs.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts = Counter(t for i, ts in cut.items() if not held[i] for t in ts)
    total, kinds = sum(counts.values()), len(counts)
    out = {
        i: (held[i], len(ts), sum(counts[t] > 0 for t in ts),
            sum(log10((counts[t] + 1) / (total + kinds + 1)) for t in ts))
        for i, ts in cut.items()}
    return out, total, kinds


def links(vectors, least=0.9):
    """{id: (links, component)} of {id: vector or None}, by the textbook formula"""
    import numpy as np

    good = {i: np.array(v, float) for i, v in vectors.items() if v and None not in v}
    good = {i: v for i, v in good.items() if np.isfinite(v).all() and v.any()}
    joined, count = Sets(), Counter()
    ids = sorted(good)
    for a, i in enumerate(ids):
        for j in ids[:a]:
            u, v = good[i], good[j]
            if len(u) == len(v) and u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= least:
                joined.join(i, j)
                count[i] += 1
                count[j] += 1
    return {i: (count[i], joined.find(i)) for i in vectors}


def best_fit(items, capacity):
    """[(bin, offset)] of (size, source, cluster) in order, by looking at every open bin"""
    bins, out = [], []
    for size, source, cluster in items:
        fits = [
            b for b in bins if b["room"] >= size and (source is None or source not in b["sources"])
            and (cluster is None or cluster not in b["clusters"])]
        if fits:
            least = min(b["room"] for b in fits)
            chosen = min((b for b in fits if b["room"] == least), key=lambda b: b["since"])
        else:
            chosen = {"number": len(bins), "room": capacity, "sources": set(), "clusters": set(), "since": 0}
            bins.append(chosen)
        out.append((chosen["number"], capacity - chosen["room"]))
        chosen["room"] -= size
        chosen["sources"].add(source)
        chosen["clusters"].add(cluster)
        chosen["since"] = len(out)
    return out
