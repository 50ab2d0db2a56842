"""Plain Python answers for small tables of documents."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, k: int = 5) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) of each row of (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    lead: dict[int, list] = {}
    for i, (d, _) in enumerate(rows):
        lead.setdefault(find(i), []).append(d)
    names = {c: min((d for d in ids if d is not None), default=None) for c, ids in lead.items()}
    return [(d, len(s), names[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def removal(texts: list[str | None], length: int) -> list[tuple]:
    """(bytes, removed, spans, digest) of each text."""
    raws = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raws for i in range(len(b) - length + 1))
    out = []
    for b in raws:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def sources(rows: list[tuple], weights=(5, 2, 1), epochs=1.5, cap=2.0) -> dict:
    """source -> (size, target), by sharing the excess again and again."""
    size = Counter()
    for source, n in rows:
        size[source] += n
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = {}, epochs * sum(size.values()), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = cap * size[s]
            left -= target[s]
        free -= over
    return {s: (size[s], target[s]) for s in names}


def mixed(rows: list[tuple], slots: int, finest: int, cap=2.0) -> list[tuple]:
    """(doc_id, size, taken) of (doc_id, text, source) rows: the tokens are laid out in shuffled order and every slot takes its block."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    targets = sources([(s, n) for (_, _, s), n in zip(rows, size, strict=True)])
    common = math.ceil(sum(t for _, t in targets.values()) / slots)
    block = {s: max(1, min(common, math.floor(t / finest))) for s, (_, t) in targets.items()}
    upto, borders = 0.0, []
    for s, (_, t) in targets.items():
        upto += t / block[s]
        borders.append((upto, s))
    tokens = {s: [] for s in targets}

    def key(i):
        d, t, _ = rows[i]
        inner = "" if t is None else hashlib.md5(t.encode()).hexdigest()
        return hashlib.md5(f"mix|{'' if d is None else d}|{inner}".encode()).hexdigest(), i

    for i in sorted(range(len(rows)), key=key):
        tokens[rows[i][2]] += [i] * size[i]
    taken, turn = Counter(), Counter()
    for slot in range(math.floor(upto)):
        point = slot * 2654435769 % 2 ** 32
        s = next(s for b, s in borders if point < math.floor(b / upto * 2 ** 32))
        blocks = math.ceil(len(tokens[s]) / block[s])
        if turn[s] < math.floor(blocks * cap):
            first = turn[s] % blocks * block[s]
            taken.update(tokens[s][first:first + block[s]])
        turn[s] += 1
    return [(d, size[i], taken[i]) for i, (d, _, _) in enumerate(rows)]
