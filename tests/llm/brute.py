"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re

import xxhash

LAST = 2**63 - 1


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def removed(rows, width, tokens, join):
    """Per row ``(n, removed, spans, sha256 of what stays)``, in row order."""
    docs = [(LAST if d is None else d, tokens(t or "")) for d, t in rows]
    first = {}
    for d, own in docs:
        for i in range(len(own) - width + 1):
            key = tuple(own[i : i + width])
            first[key] = min(first.get(key, LAST), d)
    out = []
    for d, own in docs:
        gone = bytearray(len(own))
        for i in range(len(own) - width + 1):
            if first[tuple(own[i : i + width])] < d:
                gone[i : i + width] = b"\1" * width
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = join([x for x, g in zip(own, gone, strict=True) if not g])
        out.append((len(own), sum(gone), spans, sha(kept)))
    return out


def words(text: str) -> list[str]:
    return [w for w in re.split("[\x20\x09-\x0d]+", text) if w]


def simhash(text: str) -> int:
    own = text.encode().lower().split()
    if not own:
        return 0
    grams = [b" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))]
    hashed = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


def components(rows, radius=3):
    """Each row's least identifier reachable over near fingerprints."""
    prints = [(LAST if d is None else d, simhash(t or "")) for d, t in rows]
    label = [d for d, _ in prints]
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints):
                if label[j] < label[i] and bin(a ^ b).count("1") <= radius:
                    label[i], changed = label[j], True
    return [(d, f"{f:016x}", c) for (d, f), c in zip(prints, label, strict=True)]


def winnowed(text: str, gram=3, window=4):
    own, hashed = words(text), []
    for i in range(max(len(own) - gram, 0) + 1):
        h = 42
        for w in own[i : i + gram]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        hashed.append(h & 0xFFFFFFFF)
    out = []
    for i in range(max(len(hashed) - window + 1, 1)):
        part = hashed[i : i + window]
        place = i + max(j for j, h in enumerate(part) if h == min(part))
        if (min(part), place) not in out:
            out.append((min(part), place))
    return out


def likeness(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return len(x & y) / len(x | y)


def runs(own, min_length=6, min_power=4):
    """``(start, length, period)`` of all periodic runs, every period tried."""
    n, out = len(own), set()
    for q in range(1, n // min_power + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and own[j] == own[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_power * q):
                part = own[i : j + q]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    out.add((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out)


def nearest(vectors, k=16, rounds=3, scale=64, dims=64):
    """Rows ``(id, cluster, distance)``, sums and centroids, by trying all."""
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in vectors
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (sha(f"1:{'' if r[0] is None else r[0]}"), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def assigned():
        far = [[sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centroids] for _, v in kept]
        return [min((d, c) for c, d in enumerate(own)) for own in far]

    for _ in range(rounds):
        now = assigned()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, n) in zip(kept, now, strict=True) if n == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    now = assigned()
    sums = [sum(d for d, n in now if n == c) for c in range(len(centroids))]
    digests = [sha(",".join(map(str, c))) for c in centroids]
    return [(i, c, d, sums[c], sum(sums), digests[c]) for (i, _), (d, c) in zip(kept, now, strict=True)]


def set_of(text):
    own = text.encode().lower().split()
    if len(own) < 3:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 3]) for i in range(len(own) - 2)}


def linked_sets(rows, percent=85):
    """Rows ``(id, size, component, kept)`` by comparing all pairs."""
    sets = [(LAST if d is None else d, set_of(t or "")) for d, t in rows]
    label = [d for d, _ in sets]
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(sets):
            for j, (_, b) in enumerate(sets):
                if label[j] < label[i] and a and 100 * len(a & b) >= percent * len(a | b):
                    label[i], changed = label[j], True
    return [(d, len(s), c, d == c) for (d, s), c in zip(sets, label, strict=True)]
