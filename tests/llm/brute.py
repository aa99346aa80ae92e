"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


class Katz:
    """Recursive Katz model on lists of tokens."""

    def __init__(self, texts, order, discounts, cutoff=5):
        self.order, self.cutoff = order, cutoff
        self.counts = {m: Counter() for m in range(1, order + 1)}
        for t in texts:
            for m in self.counts:
                self.counts[m].update(tuple(t[i:i + m]) for i in range(len(t) - m + 1))
        self.tokens = sum(self.counts[1].values())
        self.d = {}
        for m, c in self.counts.items():
            have = Counter(c.values())
            self.d[m] = discounts([have[r] for r in range(1, cutoff + 2)])
        self.freed = sum((1 - self.factor(1, c)) * c for c in self.counts[1].values())
        self.known = {}
        self.context = defaultdict(list)
        for m in range(2, order + 1):
            for g in self.counts[m]:
                self.context[g[:-1]].append(g)

    def factor(self, m, r):
        return self.d[m][r - 1] if r <= self.cutoff else 1.0

    def p(self, gram):
        if gram not in self.known:
            self.known[gram] = self._p(gram)
        return self.known[gram]

    def masses(self, context):
        if (context, "masses") not in self.known:
            followers, m = self.context[context], len(context) + 1
            total = sum(self.counts[m][g] for g in followers)
            high = sum(self.factor(m, self.counts[m][g]) * self.counts[m][g] for g in followers) / total if total else 0
            self.known[context, "masses"] = total, high, sum(self.p(g[1:]) for g in followers)
        return self.known[context, "masses"]

    def _p(self, gram):
        m = len(gram)
        r = self.counts[m][gram]
        if m == 1:
            freed = self.freed
            if not self.tokens:
                return 1.0
            if not freed:
                return r / (self.tokens + 1) if r else 1 / (self.tokens + 1)
            return self.factor(1, r) * r / self.tokens if r else freed / self.tokens
        total, high, low = self.masses(gram[:-1])
        if not total:
            return self.p(gram[1:])
        base, left = (total + 1, 1 / (total + 1)) if high > 1 - 1e-12 else (total, 1 - high)
        if r:
            return self.factor(m, r) * r / base
        return left / (1 - low) * self.p(gram[1:])

    def score(self, t):
        return sum(math.log10(self.p(tuple(t[max(0, i - self.order + 1):i + 1]))) for i in range(len(t)))


def fingerprint(text, length=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + length]) for i in range(max(1, len(w) - length + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def linked(fps, radius=3):
    """Smallest id reachable from each id under links of at most ``radius`` bits."""
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def cut(docs, length):
    """(id, text) pairs: what is left of each text, and the number of removed bytes and runs."""
    first = {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p:p + length], i)
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g))
    return out


def repetition(text, lengths=(5, 6, 7, 8, 9, 10)):
    text = text or ""
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
           "n_dup_lines": repeated, "n_repeat_words": len(inside)}
    for n in lengths:
        grams, later = set(), set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in grams:
                later |= set(range(i, i + n))
            grams.add(tuple(w[i:i + n]))
        out[f"chars_{n}"] = sum(len(w[i]) for i in later)
    return out
