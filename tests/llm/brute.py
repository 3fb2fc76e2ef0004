"""Plain Python versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 2 ** 63 - 1


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def key(rows):
    return sorted(rows, key=repr)


def secret_base(text):
    out = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text or "", re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


def pii_base(text):
    out = [(m.start(), 0, m.end())
           for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19:
            total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1]))
            if total % 10 == 0:
                out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def simhash(text, shingle=4):
    w = WORD.findall(lower_ascii(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_duplicates(rows, radius=4):
    """(id, fingerprint, component id) of (id, text) rows."""
    f = np.array([simhash(t) for _, t in rows], np.uint64)
    parent = list(range(len(f)))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x
    for i in range(len(f)):
        for j in np.nonzero(np.bitwise_count(f[i + 1:] ^ f[i]) <= radius)[0]:
            parent[root(i)] = root(i + 1 + int(j))
    groups = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        groups[root(i)].append(d)
    return [(d, f"{int(f[i]):016x}", min((x for x in groups[root(i)] if x is not None), default=None))
            for i, (d, _) in enumerate(rows)]


def contamination(docs, items, window=10):
    """(id, n_words, hit words, item ids) of (id, text) rows."""
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = collections.defaultdict(set)
    for item, text in items:
        w = rx.findall(lower_ascii(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(item)
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        w = rx.findall(lower_ascii(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if items_here := grams.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    found |= items_here
        out.append((doc, len(w), hit, {str(x) for x in found if x is not None}))
    return out


def top_k(rows, k=5):
    """(query, rank, vec, score) of (id, vector) rows."""
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in {(i, tuple(v)) for i, v in ok if i % 50 == 0}:
        best = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Target of every source: share by weight, cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        rest, mass = total - sum(out.values()), sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / mass > most * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / mass for s in free}
        for s in over:
            out[s] = most * sizes[s]
            free.discard(s)
    return out


def repeats(rows, window=20):
    """(id, n_words, n_removed, kept words) of (id, text) rows."""
    rows = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in rows:
        for i in range(len(w) - window + 1):
            k, at = tuple(w[i:i + window]), (LAST if d is None else d, i)
            first[k] = min(first.get(k, at), at)
    out = []
    for d, w in rows:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < (LAST if d is None else d, i):
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


def archive(rows):
    """(page, bytes, digest, type, refers_to) of (page, url, html) rows."""
    holders = collections.defaultdict(list)
    for page, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 1000:
            holders[p].append(page)
    out = []
    for page, _, html in rows:
        p = (html or "").encode()
        original = max((x for x in holders.get(p, []) if x is not None), default=None)
        revisit = len(holders.get(p, [])) > 1 and original is not None and page != original
        out.append((page, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response",
                    original if revisit else None))
    return out
