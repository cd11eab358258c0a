"""Plain versions of the operators, for small inputs."""

import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def spaced(text):
    return SPACED.findall(text or "")


def base_rules(text):
    text = text or ""
    w = spaced(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    where = defaultdict(list)
    for i in range(len(w) - 4):
        where[tuple(w[i:i + 5])].append(i)
    hit = {p for at in where.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed)


def _signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(parts):
    """Spark's xxhash64 of values given as bytes, each seeding the next."""
    h = 42
    for v in parts:
        h = xxhash.xxh64_intdigest(v, seed=h)
    return _signed(h)


def _hash(*values):
    """Spark's xxhash64 of words (UTF-8) or longs (8 bytes)."""
    return chained([v.encode() if isinstance(v, str) else struct.pack("<q", v) for v in values])


def grams(text, buckets):
    one = [_hash(x) for x in spaced(text)]
    return [x % buckets for x in one + [_hash(a, b) for a, b in zip(one, one[1:])]]


def quality(docs, trusted, buckets, smoothing, min_score):
    """doc_id -> (score, kept)."""
    raw, good = Counter(), Counter()
    for i, t in docs:
        g = grams(t, buckets)
        raw.update(g)
        if i in trusted:
            good.update(g)
    n, m = sum(raw.values()), sum(good.values())
    ratio = {b: math.log((good[b] + smoothing) / (c * (m / n) + smoothing)) for b, c in raw.items()}
    out = {}
    for i, t in docs:
        g = grams(t, buckets)
        s = sum(ratio[b] for b in g) / len(g) if g else 0.0
        out[i] = (s, not base_rules(t)[-1] and s >= min_score)
    return out


def fingerprint(text, n=3):
    w = SPACED.findall((text or "").translate(LOWER))
    if not w:
        return 0
    sh = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, bits=2):
    """[(doc_id, fp)] -> component id of each, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(prints))]


def removed(texts, n=35):
    """Per text the flags of removed words."""
    words = [spaced(t) for t in texts]
    count = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i:i + n])] > 1:
                gone[i:i + n] = [True] * n
        out.append(gone)
    return out


def contaminated(text, items, n=10):
    """(n_words, n_hit, sorted item ids as strings)."""
    w = PLAIN.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item_id, t in items:
        x = PLAIN.findall((t or "").translate(LOWER))
        k = min(n, len(x))
        for i in range(len(x) - k + 1 if k else 0):
            for p in range(len(w) - k + 1):
                if w[p:p + k] == x[i:i + k]:
                    hit.update(range(p, p + k))
                    found.add("null" if item_id is None else str(item_id))
    return len(w), len(hit), sorted(found)
