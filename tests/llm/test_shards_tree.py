"""The k-d tree against a plain one that sorts all documents."""

import random

import numpy as np
import pytest
from conftest import SF

from dyelake.llm import sharding
from dyelake.sources.tables import table


def plain_tree(rows, shards):
    """doc_id -> shard: always the dimension of the widest scaled spread, cut nearest to the goal in bytes."""
    value = np.array([[r[d] for d in sharding.DIMENSIONS] for r in rows])
    span = value.max(0) - value.min(0)
    value = (value - value.min(0)) / np.where(span > 0, span, 1.0)
    size, tie = np.array([r["size"] for r in rows]), np.array([r["tie"] for r in rows])
    out = {}

    def split(own, first, count):
        if count == 1 or not len(own):
            out.update({rows[i]["doc_id"]: first for i in own})
            return
        dim = int(np.argmax(value[own].std(axis=0)))
        own = own[np.lexsort((tie[own], value[own, dim]))]
        goal = size[own].sum() * (count // 2) / count
        upto = np.concatenate(([0], np.cumsum(size[own])))
        cut = int(np.argmin(np.abs(upto - goal)))
        split(own[:cut], first, count // 2)
        split(own[cut:], first + count // 2, count - count // 2)

    split(np.arange(len(rows)), 0, shards)
    return out


@pytest.mark.parametrize("shards", [2, 7, 16])
def test_every_cut_is_the_plain_trees(spark, shards):
    seen = sharding.points(table(spark, SF, "documents"))
    rows = seen.collect()
    got = {r["doc_id"]: r["shard"] for r in sharding.kd_tree(seen, shards, slack=0.0).collect()}
    want = plain_tree(rows, shards)
    assert got.keys() == want.keys()
    # A cut that two documents of equal distance could make may fall either way.
    assert sum(got[d] != want[d] for d in got) <= 0.02 * len(got)


def test_sizes_are_near_equal_and_copies_together(spark):
    docs = table(spark, SF.replace("sf0.001", "sf0.01"), "documents")
    rows = sharding.kd_shards(docs, 40).collect()
    total = {}
    for r in rows:
        total[r["shard"]] = total.get(r["shard"], 0) + r["size"]
    mean = sum(total.values()) / 40
    assert len(total) == 40 and max(total.values()) < mean + max(r["size"] for r in rows)
    shards = {}
    for r in rows:
        shards.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shards.values()) < 0.02 * len(shards)


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(None, None, None, None), (1, "", "en", None), (2, "x" * 300_000, None, "a"), (3, "same", "en", "a"), (3, "same", "de", "b"), (3, "same", "de", "b")]
    rows += [(i, "w " * rng.randrange(1, 400), rng.choice(("en", "de")), rng.choice(("a", "b"))) for i in range(10, 200)]
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, lang string, source string, node int, size string")
    out = sharding.kd_shards(docs, 6).collect()
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Copies that differ in language and source are one point.
    assert len({r["shard"] for r in out if r["doc_id"] == 3}) == 1
    assert sharding.kd_shards(docs.limit(0), 6).count() == 0
    assert sharding.kd_shards(docs.select("doc_id", "text"), 3).count() == len(rows)
