"""Plain versions of the operators, over lists of rows."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def targets(rows, weights=(5, 2, 1), most=3):
    """Target per source, by resharing until none is above its cap."""
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(words(text))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, target, free = sum(size.values()), {}, set(size)
    while free:
        left = budget - sum(target.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * size[s]}
        if not over:
            return size, {**target, **share}
        for s in over:
            target[s] = most * size[s]
        free -= over
    return size, target


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(rows, percent=80):
    """doc_id -> (set size, smallest id reachable); ids are distinct and not null."""
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def cut(rows, length=50):
    """doc_id, text rows -> one tuple per row: id, bytes, removed, spans, kept bytes."""
    first = {}
    for d, text in rows:
        raw = (text or "").encode()
        if d is not None:
            for i in range(len(raw) - length + 1):
                w = raw[i : i + length]
                first[w] = min(first.get(w, d), d)
    out = []
    for d, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        if d is not None:
            for i in range(len(raw) - length + 1):
                if first[raw[i : i + length]] < d:
                    gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.concatenate(([False], gone[:-2]))).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), int(gone.sum()), spans, kept))
    return out


def quality(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    count = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def verdicts(rows):
    """Per row ``(text, host)`` whether it is kept: base rule, then shrunken host rates by the method of moments."""
    measured = []
    for text, host in rows:
        n, chars, symbols, dup, _, base = quality(text)
        lines = [x for x in (text or "").split("\n") if words(x)]
        measured.append((host, base, not base and 100 * symbols > 20 * chars, not base and 100 * dup > 50 * len(lines)))
    size, rejected, watched = Counter(m[0] for m in measured), set(), [set(), set(), set()]
    total = len(measured)
    for k in range(3):
        fails = Counter(m[0] for m in measured if m[k + 1])
        mean = sum(fails.values()) / total
        spread = sum(fails[h] ** 2 / n for h, n in size.items()) / total - mean**2 - mean * (1 - mean) * (len(size) - 1) / total
        room = 1 - sum(n * n for n in size.values()) / total**2
        between = spread / room if room > 0 else 0
        strength = max(mean * (1 - mean) / between - 1, 1) if between > 0 else 1e9
        for h, n in size.items():
            rate = (fails[h] + mean * strength) / (n + strength)
            if rate > 0.6:
                rejected.add(h)
            if rate > 0.01:
                watched[k].add(h)
    return [not base and h not in rejected and not (sym and h in watched[1]) and not (lin and h in watched[2]) for h, base, sym, lin in measured]


def top_k(rows, queries, k=10, scale=1024):
    """Rows ``(id, vector)``; the result per query id in order of rank."""
    good = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if queries(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
