"""Exact and proximity matches against a plain search."""

import hashlib
import random
import re
import time

import brute
import numpy as np
import pytest

from dyelake.llm import decontaminate as D

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(brute.fold(text or ""))


def plain(text, items, width, span):
    own, hit, exact, near = words(text), set(), set(), set()
    for item, other in items:
        test = words(other)
        for w in [test[i : i + width] for i in range(max(1, len(test) - width + 1))] if test else []:
            for i in range(len(own) - len(w) + 1):
                if own[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    exact.add(item)
            if any(set(w) <= set(own[i : i + span]) for i in range(max(1, len(own) - span + 1))):
                near.add(item)
    names = sorted("" if i is None else str(i) for i in exact)
    return len(own), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit), len(near | exact)


@pytest.mark.parametrize(("width", "span", "block"), [(4, 6, 10**6), (4, 6, 60), (3, 3, 10**6), (5, 4, 10**6)])
def test_against_a_plain_search(spark, width, span, block):
    rng = random.Random(width * span)
    say = lambda n: " ".join(rng.choice(("a", "B", "c3", "dé", "e-f", "x", "y", "zz")) for _ in range(n))
    items = [(i, say(rng.choice((1, 2, 4, 7)))) for i in range(12)] + [(None, "x y zz"), (3, "x y zz"), (40, None), (41, "--")]
    docs = [(d, say(rng.choice((0, 3, 9, 40)))) for d in range(60)] + [(None, say(20)), (5, None), (6, items[0][1]), (6, items[0][1])]
    rows = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, text string, segment string, items int").repartition(3)
    out = D.contamination(rows, spark.createDataFrame(items, "item_id long, text string"), width, span, block)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"]
    want = sorted(((d, *plain(t, items, width, span)) for d, t in docs), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want


def test_ids_of_any_type(spark):
    rows = spark.createDataFrame([(b"\x01", "one two three"), (None, "two")], "doc_id binary, text string")
    out = {r["doc_id"] and bytes(r["doc_id"]): r["n_hit"] for r in D.contamination(rows, spark.createDataFrame([("x", "two three")], "item_id string, text string"), 2).collect()}
    assert out == {b"\x01": 2, None: 0}


def test_longest_window_of_a_proximity_search(spark):
    rows = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="62 words"):
        D.contamination(rows, rows.withColumnRenamed("doc_id", "item_id"), 63, 70).collect()
    assert D.contamination(rows, rows.withColumnRenamed("doc_id", "item_id"), 63).first()["n_hit"] == 2


def test_a_million_windows_take_little_more_time(spark):
    rng = np.random.default_rng(1)
    say = lambda n: " ".join(f"w{i}" for i in (rng.pareto(0.7, n) * 30).astype(np.int64) % 60_000)
    docs = spark.createDataFrame([(i, say(2000)) for i in range(300)], "doc_id long, text string")
    took = []
    for n in (250, 2000):
        tests = D.test_windows([(i, say(500)) for i in range(n)], 10)
        assert len(tests.length) > 480 * n
        began = time.time()
        D.search(D.positional_index(docs, tests.terms, 15), tests, 14, 15).count()
        took.append(time.time() - began)
    assert took[1] < 8 * took[0] + 5
