"""Plain one-machine forms of the operators, for comparison on small tables."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text: str) -> str:
    """A-Z to lower case, nothing else."""
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingle_set(text: str | None, width: int) -> set:
    words = WORD.findall(fold(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


def near_duplicates(rows: list[tuple], width: int, percent: int) -> dict:
    """doc_id -> (n_shingles, component) by comparing all pairs; doc_ids are unique."""
    sets = {d: shingle_set(t, width) for d, t in rows}
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    where: dict = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    for d, s in sets.items():
        near: dict = {}
        for x in s:
            for e in where[x]:
                if e < d:
                    near[e] = near.get(e, 0) + 1
        for e, both in near.items():
            if 100 * both >= percent * (len(s) + len(sets[e]) - both):
                a, b = sorted((root(d), root(e)))
                up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}
