"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def lines(docs: dict[int, str | None]):
    """doc_id -> (n_lines, n_dropped, kept text)."""
    parts = {i: (t or "").split("\n") for i, t in docs.items()}
    keys = {i: [lower(x.strip(" \t\n\x0b\x0c\r")) for x in p] for i, p in parts.items()}
    held = defaultdict(set)
    for i, ks in keys.items():
        for k in ks:
            if len(k) >= 40:
                held[k].add(i)
    gone = {k: max(v) for k, v in held.items() if len(v) >= 5}
    out = {}
    for i, p in parts.items():
        kept = [x for x, k in zip(p, keys[i], strict=True) if gone.get(k, i) == i]
        out[i] = (len(p), len(p) - len(kept), "\n".join(kept))
    return out


def shingle_sets(docs: dict[int, str | None], n: int = 4):
    out = {}
    for i, t in docs.items():
        w = SPACED.findall(lower(t or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else (
            {tuple(w)} if w else set()
        )
    return out


def jaccard(docs: dict[int, str | None]):
    """doc_id -> (n_shingles, component_id)."""
    sets = shingle_sets(docs)
    groups = Groups(docs)
    ids = [i for i in docs if sets[i]]
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                groups.link(a, b)
    return {i: (len(sets[i]), groups.find(i)) for i in docs}


def repeats(docs: dict[int, str | None], window: int):
    """doc_id -> (n_words, n_removed, kept text)."""
    words = {i: SPACED.findall(t or "") for i, t in docs.items()}
    count = Counter(
        tuple(w[k : k + window]) for w in words.values() for k in range(len(w) - window + 1)
    )
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (len(w), sum(gone), " ".join(kept))
    return out


def leaks(docs: dict[int, str | None], items: list[tuple], window: int = 10):
    """doc_id -> (n_words, n_hit, item ids)."""
    grams = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text or ""))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            grams[tuple(w[k : k + size])].add(item)
    out = {}
    for i, t in docs.items():
        w = ALNUM.findall(lower(t or ""))
        hit, found = [False] * len(w), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if (g := tuple(w[k : k + size])) in grams:
                    hit[k : k + size] = [True] * size
                    found |= grams[g]
        out[i] = (len(w), sum(hit), sorted(found))
    return out
