"""The pipeline's stages against plain forms."""

import re
from collections import Counter

import brute
import corpus_pipeline as P
from conftest import SF

from dyelake.sources.tables import table

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(text, width=10):
    words = WORDS.findall(brute.fold(text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def holds(text, items):
    words = WORDS.findall(brute.fold(text or ""))
    return any(tuple(words[i : i + n]) in own for n, own in items.items() for i in range(len(words) - n + 1))


def test_stages(spark):
    docs = table(spark, SF, "documents")
    rows = {r["doc_id"]: r for r in docs.collect()}
    known = P.language(spark, docs, SF)
    assert known.columns == docs.columns
    kept = {r["doc_id"] for r in known.collect()}
    assert kept == {d for d, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}

    want = {d for d, (_, c) in brute.near_duplicates([(d, rows[d]["text"]) for d in kept], 5, 80).items() if c == d}
    single = P.near_dedup(spark, known, SF)
    assert single.columns == docs.columns and {r["doc_id"] for r in single.collect()} == want

    items: dict = {}
    for r in table(spark, SF, "benchmark").collect():
        for w in windows(r["text"]):
            items.setdefault(len(w), set()).add(w)
    clean = P.decontamination(spark, single, SF)
    want = {d for d in want if not holds(rows[d]["text"], items)}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == want

    mixed = P.mixing(spark, clean, SF)
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(times) <= want and max(times.values()) <= 2

    out = P.sharding(spark, mixed, SF).collect()
    assert Counter(r["doc_id"] for r in out) == times
    by: dict = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values()) and max(by) < P.SHARDS
