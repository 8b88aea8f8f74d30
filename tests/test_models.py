"""Isolation, decay fits and the forest against plain forms and known answers."""

import math

import numpy as np
import pytest

from dyelake.operators.fits import decay_half_life, decay_rates
from dyelake.operators.forest import rf_classify, rf_train
from dyelake.operators.survey import best_schemes, isolation


def plain_isolation(tracks, reads, k):
    owner = {}
    for t, p, n in sorted(reads, key=lambda r: (r[0], -r[2], r[1])):
        owner.setdefault(t, p)
    near = {t: sorted((sum((a - b) ** 2 for a, b in zip(v, w)), u) for u, w in tracks.items())[:k] for t, v in tracks.items()}
    out = {}
    for pep in {p for _, p, _ in reads}:
        kept = total = 0
        lost = {}
        for t, p, n in reads:
            if p != pep:
                continue
            local, product = owner[t] == pep, 1.0
            for d, u in near[t]:
                if u != t and (owner[u] == pep) != local:
                    product *= 1 - math.exp(-0.8 * d)
            kept, total = kept + n * (product if local else 1 - product), total + n
            if not local:
                lost[owner[t]] = lost.get(owner[t], 0) + n * product
        worst = min((-v, o) for o, v in lost.items())[1] if lost and max(lost.values()) > 0 else 0
        out[pep] = (round(kept / total, 9), worst)
    return out


@pytest.mark.parametrize("k", [1, 3, 10])
def test_isolation(spark, k):
    draw = np.random.default_rng(4)
    tracks = {i: tuple(int(x) for x in (i % 3, i // 3 % 3, i // 9)) for i in range(18)}
    reads = sorted({(int(t), int(p)): int(n) for t, p, n in zip(draw.integers(0, 18, 60), draw.integers(1, 9, 60), draw.integers(1, 50, 60))}.items())
    reads = [(t, p, n) for (t, p), n in reads] + [(t, 9, 1) for t in tracks]
    got = isolation(spark.createDataFrame([(t, list(v)) for t, v in tracks.items()], "dyt_i int, dyetrack array<int>"), spark.createDataFrame(reads, "dyt_i int, pep_i int, n_reads long"), k)
    found, want = {r.pep_i: (r.isolation, r.contention_pep_i) for r in got.collect()}, plain_isolation(tracks, reads, k)
    assert {p: c for p, (_, c) in found.items()} == {p: c for p, (_, c) in want.items()}
    assert {p: i for p, (i, _) in found.items()} == pytest.approx({p: i for p, (i, _) in want.items()}, abs=1e-8)


def test_half_lives(spark):
    rows = [(f, 0, c, 400.0 + 9000 * 0.5 ** (c / h)) for f, h in ((1, 3.0), (2, 7.5)) for c in range(14)]
    rows += [(3, 0, c, 5.0) for c in range(4)] + [(4, 0, None, 1.0), (5, 0, 1, None)]
    got = {r.field_i: r.half_lives for r in decay_half_life(spark.createDataFrame(rows, "field_i int, channel_i int, cycle_i int, signal double")).collect()}
    assert got[1] == pytest.approx([3.0], rel=1e-6) and got[2] == pytest.approx([7.5], rel=1e-6)
    assert got[3] is None and got[4] is None and got[5] is None
    assert decay_half_life(spark.createDataFrame([], "field_i int, channel_i int, cycle_i int, signal double")).count() == 0


def test_two_rates():
    x = np.arange(40.0)
    rates = decay_rates(x, 5000 * np.exp(-0.9 * x) + 3000 * np.exp(-0.08 * x) + 100, 2)
    assert sorted(rates) == pytest.approx([0.08, 0.9], rel=1e-4)


def test_forest(spark):
    draw = np.random.default_rng(2)
    make = lambda n: [(int(p), [float((p == 3) * 5 + x), float((p == 8) * 5 + y)]) for p, x, y in zip(draw.choice([3, 8, 11], n), *draw.normal(0, 0.5, (2, n)))]
    model = rf_train(spark.createDataFrame(make(900), "true_pep_i int, vec array<double>"), 250, min_leaf=5)
    out = rf_classify(spark.createDataFrame(make(300), "true_pep_i int, vec array<double>"), model, keep_all=True).collect()
    assert sum(r.true_pep_i == r.pred_pep_i for r in out) >= 290
    assert all(len(r.scores) == 3 and max(r.scores) == r.score for r in out)
    with pytest.raises(Exception, match="columns"):
        rf_classify(spark.createDataFrame([([1.0],)], "vec array<double>"), model).collect()


def test_objectives(spark):
    rows = [(0, 1, 9.0, 4, 1), (0, 1, 1.0, 4, 2), (1, 2, 6.0, 9, 1), (1, 2, 5.0, 9, 2)]
    survey = spark.createDataFrame(rows, "run_i int, pro_i int, nn_dist double, pep_len int, flu_count int")
    lengths = spark.createDataFrame([(1, 20), (2, 30)], "pro_i int, length int")
    first = {o: tuple(best_schemes(survey, 1, o, lengths).collect()[0][1:]) for o in ("nn_dist", "nn_dist_avg", "nn_dist_min", "coverage")}
    assert first == {"nn_dist": (0, 9.0), "nn_dist_avg": (1, 5.5), "nn_dist_min": (1, 5.0), "coverage": (1, 0.18)}
