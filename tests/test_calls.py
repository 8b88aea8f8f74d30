"""Calls and curves against plain loops over random calls."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dyelake.operators import calls as C
from dyelake.operators import curves as R

STEPS = 7


def drawn(seed, n=240, peps=6):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        true = rng.randint(1, peps)
        out.append((true, true if rng.random() < 0.55 else rng.randint(0, peps), rng.randint(0, 20) / 20))
    return out


@pytest.fixture(scope="module", params=[21, 22])
def rows(request):
    return drawn(request.param)


@pytest.fixture(scope="module")
def calls(spark, rows):
    return spark.createDataFrame(rows, "true_pep_i int, pred_pep_i int, score double").repartition(3)


def peps(spark, n=7):
    return spark.range(n).select(F.col("id").cast("int").alias("pep_i"))


def plain_curve(rows, subset, prior):
    own = [r for r in rows if r[0] in subset or r[1] in subset]
    n_true, out = sum(t in subset for t, _, _ in own), []
    for t in R.thresholds(STEPS):
        seen = [r for r in own if r[2] >= t]
        right, called = sum(a == b for a, b, _ in seen), sum(p in subset for _, p, _ in seen)
        out.append((right / called if called else 0.0, right / n_true if n_true else 0.0))
    return [(round(p, 9), round(r * prior, 9)) for p, r in out if r > 0 or not any(x for _, x in out)]


@pytest.mark.parametrize("subset", [{1, 2, 3, 4, 5, 6}, {2}, {1, 5}])
def test_curve(spark, rows, calls, subset):
    prior = peps(spark).withColumn("prior", F.lit(0.8))
    out = R.pr_curve(calls, peps(spark).filter(F.col("pep_i").isin(*subset)), prior, STEPS).orderBy(F.desc("score")).collect()
    assert [(round(r["prec"], 9), round(r["recall"], 9)) for r in out] == plain_curve(rows, subset, 0.8)


def test_nothing_right_keeps_every_step(spark):
    wrong = spark.createDataFrame([(3, 4, 0.9), (4, 3, 0.2)] * 6, "true_pep_i int, pred_pep_i int, score double")
    out = R.pr_curve(wrong, peps(spark).filter("pep_i > 0"), peps(spark).withColumn("prior", F.lit(1.0)), 3).collect()
    assert [(r["prec"], r["recall"]) for r in out] == [(0.0, 0.0)] * 3


def test_scaled_confusion(spark, rows, calls):
    by = {0: 0.0, 1: 1.0, 2: 1.3, 3: 2.7, 4: 5.0, 5: 1.1, 6: 3.9}
    out = {(r[0], r[1]): r[2] for r in C.scale_by_abundance(C.conf_mat(calls), spark.createDataFrame(list(by.items()), "pep_i int, abundance double")).collect()}
    assert out == {(p, t): int(n * by[t]) for (p, t), n in Counter((p, t) for t, p, _ in rows).items()}
    with pytest.raises(Exception, match="at least 1"):
        C.scale_by_abundance(C.conf_mat(calls), spark.createDataFrame([(k, 0.5) for k in by], "pep_i int, abundance double")).collect()


@pytest.mark.parametrize("n_false", [1, 3])
def test_false_calls(rows, calls, n_false):
    cells = Counter((p, t) for t, p, _ in rows)
    want = set()
    for pep in range(1, 7):
        for kind, side in (("FP", {t: n for (p, t), n in cells.items() if p == pep}), ("FN", {p: n for (p, t), n in cells.items() if t == pep})):
            total = sum(side.values())
            others = sorted((x for x in side if x != pep), key=lambda x: (-side[x], x))[:n_false]
            want |= {(pep, kind, i, x, round(side[x] / total, 9)) for i, x in enumerate(others) if x != 0}
    got = C.false_calls(C.conf_mat(calls), n_false).collect()
    assert {(r["pep_i"], r["false_type"], r["false_i"], r["false_pep_i"], round(r["false_weight"], 9)) for r in got} == want and len(got) == len(want)


def test_score_at_precision(spark):
    points = [(4, 0.35, 0.7, 0.4), (4, 0.55, 0.5, 0.5), (4, 0.55, 0.3, 0.5), (4, 0.75, 0.1, 0.8), (9, 0.3, 0.9, 0.3)]
    prs = spark.createDataFrame(points, "pep_i int, prec double, recall double, score double")
    out = {r["pep_i"]: (r["prec"], r["recall"], r["score"]) for r in R.score_at_precision(prs, 0.5).collect()}
    assert out == {4: (0.55, 0.5, 0.5), 9: (0.0, 0.0, 0.0)}


def test_threshold_keeps_rows(rows, calls):
    out = Counter(tuple(r) for r in C.threshold_calls(calls, 0.6).collect())
    assert out == Counter((t, p if s >= 0.6 else 0, s) for t, p, s in rows)


def test_fdr(spark, rows, calls):
    got = {r["score"]: (r["n_calls"], r["n_decoys"], r["fdr"]) for r in C.fdr(calls, spark.createDataFrame([(2,), (6,)], "pep_i int")).collect()}
    assert got.keys() == {s for _, _, s in rows}
    for score, (n, decoys, rate) in got.items():
        above = [p for _, p, s in rows if s >= score]
        assert (n, decoys) == (len(above), sum(p in (2, 6) for p in above)) and abs(rate - decoys / n) < 1e-12


def test_samples(calls, rows):
    few = C.subsample(calls, 50)
    assert few.count() == 50 and few.exceptAll(calls).count() == 0
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, C.subsample(calls.repartition(5), 50).collect()))
    again = Counter(tuple(r) for r in C.sample_calls(calls, 2.0).collect())
    assert set(again) <= set(rows) and 1.4 * len(rows) < sum(again.values()) < 2.6 * len(rows) and max(again.values()) > 2
    assert sum(C.sample_calls(calls, 0.0).count() for _ in range(1)) == 0
