"""Plain Python versions of the contracts, for comparison."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    digits = [int(c) for c in reversed(s)]
    doubled = [sum(divmod(2 * d, 10)) for d in digits[1::2]]
    return (sum(digits[::2]) + sum(doubled)) % 10 == 0


def pii_ok(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in found.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def pii(text):
    return [
        (k, m.start(), m.end())
        for k, rx in PII.items()
        for m in re.finditer(rx, text or "")
        if pii_ok(k, m[0])
    ]


def base_stats(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {
        k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)
    }
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(covered),
    )


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs):
    """doc_id -> smallest linked id; ``docs``: (doc_id, text)."""
    root = {i: i for i, _ in docs if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, shingles(t)) for i, t in docs if i is not None]
    lists = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            lists[g].append(k)
    for k, (i, s) in enumerate(sets):
        shared = Counter(j for g in s for j in lists[g] if j < k)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(sets[j][0])
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """source -> target by repeated water filling; sources in order, None last."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [
        s for s in sizes if s is None
    ]
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    wanted, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (wanted - sum(cap * sizes[s] for s in capped)) / max(1e-12, sum(w[s] for s in free))
        over = {s for s in free if level * w[s] > cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in capped else level * w[s] for s in order}
        capped |= over


def xx(word, seed=42):
    """Spark's xxhash64 of one string, as a signed long."""
    import xxhash

    h = xxhash.xxh64_intdigest(word.encode(), seed=seed)
    return h - (1 << 64) if h >> 63 else h


def winnow(text, k=4, w=8):
    """[(40-bit hash, position)] by the definition."""
    mask = (1 << 64) - 1
    words = WORD.findall(text or "")
    if not words:
        return []
    if len(words) < k:
        return [((xx(" ".join(words)) & mask) >> 24, 0)]
    h = [xx(x) & mask for x in words]
    rot = lambda x, r: ((x << r) | (x >> (64 - r))) & mask
    grams = []
    for i in range(len(h) - k + 1):
        g = 0
        for j in range(k):
            g ^= rot(h[i + j], k - 1 - j) if j < k - 1 else h[i + j]
        grams.append(g)
    out = []
    for s in range(max(1, len(grams) - w + 1)):
        window = range(s, min(s + w, len(grams)))
        # Smallest high 40 bits as a signed long, rightmost of ties.
        signed = lambda i: (grams[i] >> 24) - ((1 << 40) if grams[i] >> 63 else 0)
        best = min(window, key=lambda i: (signed(i), -i))
        if not out or out[-1][1] != best:
            out.append((grams[best] >> 24, best))
    return out
