"""Plain, slow versions of the operators, over Python lists."""

from __future__ import annotations

import hashlib
import re

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def jaccard(rows: list[tuple[int, str | None]], percent: int = 75, width: int = 5) -> dict[int, tuple[int, int]]:
    """doc_id -> (set size, smallest doc_id reachable)."""
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    label = {i: i for i in sets}
    order, changed = sorted(sets), True
    near = [
        (i, j)
        for i in order
        for j in order
        if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    while changed:
        changed = False
        for i, j in near:
            low = min(label[i], label[j])
            changed |= label[i] != low or label[j] != low
            label[i] = label[j] = low
    return {i: (len(sets[i]), label[i]) for i in order}


def repeats(rows: list[tuple[int, str | None]], width: int = 400) -> dict[int, tuple[int, int, int, str]]:
    """doc_id -> (bytes, removed bytes, removed runs, hex digest of the rest)."""
    data = {i: (text or "").encode() for i, text in rows}
    seen: dict[bytes, int] = {}
    for x in data.values():
        for k in range(len(x) - width + 1):
            h = hashlib.blake2b(x[k : k + width], digest_size=12).digest()
            seen[h] = seen.get(h, 0) + 1
    out = {}
    for i, x in data.items():
        gone = bytearray(len(x))
        reach = 0
        for k in range(len(x) - width + 1):
            if seen[hashlib.blake2b(x[k : k + width], digest_size=12).digest()] > 1:
                for j in range(max(k, reach), k + width):
                    gone[j] = 1
                reach = k + width
        runs = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        rest = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out[i] = (len(x), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def kept_lines(rows: list[tuple[int, str | None]], min_words: int) -> dict[int, list[str]]:
    """doc_id -> lines with words that stay: all runs of at least `min_words` words that occur earlier are gone."""
    lines = {i: [x for x in (text or "").split("\n") if x.split()] for i, text in sorted(rows)}
    seen: set[tuple[str, ...]] = set()
    out = {}
    for i, own in lines.items():
        gone: set[int] = set()
        for a in range(len(own)):  # earlier places first
            for b in range(a + 1, len(own) + 1):
                run = tuple(own[a:b])
                if sum(len(x.split()) for x in run) >= min_words:
                    if run in seen:
                        gone.update(range(a, b))
                    seen.add(run)
        out[i] = [x for k, x in enumerate(own) if k not in gone]
    return out
