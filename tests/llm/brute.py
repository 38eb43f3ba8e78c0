"""Plain Python versions of what the operators return, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LONG = "lorem " * 3000 + "\n" + "ipsum dolor " * 2000


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(i):
    return zlib.crc32(str(i).encode()) % 5


def base_scores(rows):
    words = {i: [*split(low(t)), None] for i, t in rows}
    c = Counter(w for i, ws in words.items() if fold(i) != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in ws)) for i, ws in words.items()}


def contamination(rows, bench, window=13):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    wins = defaultdict(set)
    for item, t in bench:
        w = cut(t)
        for j in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[j:j + window])].add(item)
    out = []
    for i, t in rows:
        w, hit, items = cut(t), set(), set()
        for n in {len(k) for k in wins}:
            for j in range(len(w) - n + 1):
                if got := wins.get(tuple(w[j:j + n])):
                    hit.update(range(j, j + n))
                    items |= got
        ids = ",".join(sorted(map(str, items)))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def near_components(rows):
    sets = {}
    for i, t in rows:
        w = split(low(t))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def substring_dedup(rows, window=50):
    first = {}
    words = {i: split(t) for i, t in rows}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][j:j + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j:j + window])] < i:
                gone.update(range(j, j + window))
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def nearest(vectors, queries, k):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], dtype=float)
    out = {}
    for q in queries:
        s = x @ x[ids == q][0]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def base_spans(text):
    """The contract's three kinds, each by its own words."""
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return [(k, s, e) for s, _, e, k in sorted(found)]
