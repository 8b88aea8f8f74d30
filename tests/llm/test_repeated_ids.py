"""Near-dedup of rows whose doc_ids repeat or are null."""

import random

from dyelake.llm import stages

SCHEMA = "doc_id long, text string, lang string"


def say(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))


def test_only_near_copies_go(spark):
    a, b, c, d, e = map(say, range(5))
    rows = [(1, a, "en"), (1, a, "en"), (1, b, "en"), (2, f"{a} more", "en"), (3, c, "en"), (None, f"{c} more", "en"), (None, d, "en"), (None, d, "en"), (4, e, "en"), (4, e, "de")]
    bare = [(5, "", "en"), (5, " \n", "en"), (5, None, "en"), (None, None, "en")]
    want = sorted([(1, a, "en"), (1, b, "en"), (3, c, "en"), (None, d, "en"), *bare], key=repr)
    seen = set()
    for seed in range(3):
        mixed = random.Random(seed).sample(rows + bare, len(rows + bare))
        out = [tuple(r) for r in stages.one_of_each_group(spark.createDataFrame(mixed, SCHEMA).repartition(1 + seed)).collect()]
        assert sorted((r for r in out if r[0] != 4), key=repr) == want
        (last,) = (r for r in out if r[0] == 4)
        assert last[1] == e
        seen.add(last)
    assert len(seen) == 1
