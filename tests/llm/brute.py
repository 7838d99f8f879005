"""Plain single-process versions of what the operators do."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = " \t\n\v\f\r"


def words(text: str | None) -> list[str]:
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def components(nodes, edges) -> dict:
    """node -> smallest reachable node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in root}


def fingerprint(text: str | None) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = words(lowered)
    if not ws:
        return 0
    shingles = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    prints = {i: fingerprint(t) for i, t in docs}
    ids = list(prints)
    edges = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 2]
    found = components(ids, edges)
    return {i: (prints[i], found[i]) for i in ids}


def near_vectors(rows: list[tuple[int, list | None, int | None]], threshold: float = 0.98) -> dict[int, tuple[int, int]]:
    def sound(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float), label) for i, v, label in rows if sound(v, label)]
    edges = []
    for n, (a, x, p) in enumerate(good):
        for b, y, q in good[n + 1 :]:
            if p == q and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                edges.append((a, b))
    links = defaultdict(int)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    found = components([i for i, _, _ in rows], edges)
    return {i: (links[i], found[i]) for i, _, _ in rows}


def without_repeats(docs: list[tuple[int, str | None]], width: int = 35) -> dict[int, tuple[int, int, str]]:
    split = {i: words(t) for i, t in docs}
    seen = defaultdict(int)
    for ws in split.values():
        for at in range(len(ws) - width + 1):
            seen[tuple(ws[at : at + width])] += 1
    out = {}
    for i, ws in split.items():
        gone = [False] * len(ws)
        for at in range(len(ws) - width + 1):
            if seen[tuple(ws[at : at + width])] > 1:
                gone[at : at + width] = [True] * width
        out[i] = (len(ws), sum(gone), " ".join(w for w, x in zip(ws, gone) if not x))
    return out


def edit_distance(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def bpe(data: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """Merge the pair of lowest rank, leftmost first, until none is left."""
    parts = [bytes([b]) for b in data]
    while True:
        best = min(((ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))), default=(1 << 60, 0))
        if best[0] == 1 << 60:
            return parts
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def normalised(line: str) -> str:
    kept = "".join(c if ord(c) >= 128 or c.isalnum() else " " for c in line.lower())
    return " ".join(words(kept))


def near_pairs(pairs: list[tuple[str, str]], similarity: float) -> list[bool]:
    """Which pairs are similar, by the textbook table, a row of many pairs at a time; pairs leave when no way is short enough."""
    out = [False] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda i: len(pairs[i][1]))
    begin = 0
    while begin < len(order):
        width = len(pairs[order[begin]][1])
        some = order[begin : begin + max(1, 400_000 // (width + 1))]
        begin += len(some)
        x, y = ([np.frombuffer(pairs[i][k].encode("utf-32-le"), np.uint32).astype(np.int64) for i in some] for k in (0, 1))
        tall, wide = np.array([len(z) for z in x]), np.array([len(z) for z in y])
        a, b = np.full((len(some), tall.max()), -1), np.full((len(some), wide.max()), -2)
        for i, (p, q) in enumerate(zip(x, y, strict=True)):
            a[i, : len(p)], b[i, : len(q)] = p, q
        most = ((1 - similarity) * np.maximum(tall, wide) + 1e-9).astype(np.int64)
        who, steps = np.arange(len(some)), np.arange(b.shape[1] + 1)
        row = np.tile(steps, (len(some), 1))
        for i in range(a.shape[1]):
            new = np.concatenate([np.full((len(row), 1), i + 1), np.minimum(row[:, 1:] + 1, row[:, :-1] + (b[who] != a[who, i, None]))], axis=1)
            row = np.minimum.accumulate(new - steps, axis=1) + steps
            for k in np.flatnonzero(tall[who] == i + 1):
                out[some[who[k]]] = bool(row[k, wide[who[k]]] <= most[who[k]])
            if i % 16 == 15 or (tall[who] == i + 1).any():
                stay = (tall[who] > i + 1) & (row.min(axis=1) <= most[who])
                who, row = who[stay], row[stay]
                if not len(who):
                    break
    return out


def similar_lines(docs: list[tuple[int, str | None]], similarity: float = 0.8) -> tuple[set[tuple[int, int]], list]:
    """(id, line number) of the lines that go, and the links, by nothing but the edit similarity in code points.

    Pairs that cannot reach it are passed over by their counts of runs of one to three characters: an edit takes and adds
    as many as a run is long.
    """
    uses = [(i, n, normalised(line)) for i, body in sorted(docs) for n, line in enumerate((body or "").split("\n"))]
    uses = [u for u in uses if u[2]]
    place = {}
    for i, n, norm in uses:
        place.setdefault(norm, (i, n))
    names = sorted(place, key=len)
    bins = np.zeros((3, len(names), 1024), np.int16)
    for i, x in enumerate(names):
        for q in (1, 2, 3):
            for k in range(len(x) - q + 1):
                bins[q - 1, i, hash(x[k : k + q]) % 1024] += 1
    size = np.array([len(x) for x in names])
    maybe = []
    for b, y in enumerate(names):
        most = int((1 - similarity) * len(y) + 1e-9)
        near = np.arange(int(np.searchsorted(size[:b], len(y) - most)), b)
        for q in (1, 2, 3):
            if len(near):
                near = near[np.abs(bins[q - 1, near].astype(np.int32) - bins[q - 1, b]).sum(axis=1) <= 2 * q * most]
        maybe += [(names[a], y) for a in near]
    edges = [p for p, near in zip(maybe, near_pairs(maybe, similarity), strict=True) if near]
    root = components(names, edges)
    first = {}
    for norm in names:
        r = root[norm]
        first[r] = min(first.get(r, place[norm]), place[norm])
    return {(i, n) for i, n, norm in uses if first[root[norm]] != (i, n)}, edges


def quality_keeps(text: str | None) -> bool:
    """The quality rules, from their description."""
    text = text or ""
    ws = words(text)
    n, chars = len(ws), sum(map(len, ws))
    if n < 50:
        return False

    def inside(width: int, first_too: bool) -> set[int]:
        seen, out = defaultdict(list), set()
        for i in range(n - width + 1):
            seen[tuple(ws[i : i + width])].append(i)
        for starts in seen.values():
            if len(starts) > 1:
                for i in starts if first_too else starts[1:]:
                    out.update(range(i, i + width))
        return out

    if 100 * len(inside(3, True)) > 50 * n:
        return False
    for width, most in {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items():
        if sum(len(ws[i]) for i in inside(width, False)) / chars > most:
            return False
    lines = [x for x in text.split("\n") if words(x)]
    seen, again = set(), []
    for x in lines:
        if x in seen:
            again.append(x)
        seen.add(x)
    if len(again) >= 2 and len(again) / len(lines) > 0.30:
        return False
    return sum(len(x.encode()) for x in again) / sum(len(x.encode()) for x in lines) <= 0.20


def similar_texts(docs: list[tuple[int, str]], width: int = 5) -> dict[int, int]:
    """id -> smallest id reachable by a Jaccard similarity of 0.8 of the sets of five-word shingles."""
    sets = {}
    for i, text in docs:
        ws = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        size = min(width, len(ws))
        sets[i] = {tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)} if ws else set()
    ids = sorted(sets)
    edges = []
    for n, a in enumerate(ids):
        for b in ids[:n]:
            p, q = sets[a], sets[b]
            common = len(p & q)
            if 5 * common >= 4 * (len(p) + len(q) - common):
                edges.append((a, b))
    return components(ids, edges)
