"""Percentiles of many groups against percentile(), with bins that are opened again."""

import random

import pytest
from pyspark.sql import functions as F

from dyelake.operators import quantiles as Q


def rows(kind):
    rng = random.Random(kind)
    if kind == "spread":
        return [(rng.choice(["a", "a", "a", "b", None]), "x", rng.choice([-1, 1]) * 10 ** rng.uniform(-200, 200)) for _ in range(3000)]
    if kind == "ties":  # half 0, half 1: the median lies between
        return [("a", "x", float(i % 2)) for i in range(1000)] + [("b", "x", 7.0)] * 500 + [("c", "x", None)] * 3
    return [(rng.choice("aab"), rng.choice("xy"), float(rng.choice([rng.randrange(40), rng.gauss(0, 1000)]))) for _ in range(4000)] + [("z", None, 1.5), ("a", "x", None), ("n", "x", float("nan")), ("n", "x", 2.0), ("n", "x", 1.0)]


@pytest.mark.parametrize("kind", ["spread", "ties", "mixed"])
@pytest.mark.parametrize("few", [20, 4096])
def test_percentiles(spark, monkeypatch, kind, few):
    monkeypatch.setattr(Q, "FEW", few)
    df = spark.createDataFrame(rows(kind), "g string, h string, v double").repartition(5)
    at = [0.0, 0.1, 0.25, 0.5, 0.731, 0.99, 1.0]
    got = {(r["g"], r["h"]): r["q"] for r in Q.percentiles(df, ["g", "h"], "v", at).collect()}
    want = {(r["g"], r["h"]): r["q"] for r in df.groupBy("g", "h").agg(F.percentile("v", F.array(*map(F.lit, at))).alias("q")).collect() if r["q"]}
    assert got.keys() == want.keys()
    for k, q in want.items():
        assert all(a == b or abs(a - b) <= 1e-12 * max(abs(a), abs(b)) or (a != a and b != b) for a, b in zip(got[k], q, strict=True)), (k, got[k], q)


def test_all_rows_as_one_group_and_none(spark):
    df = spark.range(1, 10_002).select(F.col("id").cast("double").alias("v"))
    assert Q.named_percentiles(df, [], F.col("v") * 2, {"median": 0.5, "p90": 0.9}).collect() == [(10_002.0, 18_002.0)]
    assert Q.percentiles(df.limit(0), [], "v", [0.5]).count() == 0


def test_rounds_open_bins_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(Q, "FEW", 50)
    sizes = []
    plain = Q._open
    monkeypatch.setattr(Q, "_open", lambda values, targets: (sizes.append(targets.agg(F.max("distinct")).first()[0]), plain(values, targets))[1])
    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("v"))
    assert Q.percentiles(df, [], "v", [0.5]).collect()[0]["q"] == df.agg(F.percentile("v", F.array(F.lit(0.5)))).first()[0]
    assert 1 < len(sizes) < 5 and all(b < a / 20 for a, b in zip(sizes, sizes[1:], strict=False))
