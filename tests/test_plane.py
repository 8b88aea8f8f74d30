"""Grid joins against all pairs."""

import random

import pytest

from dyelake.operators import plane as P

SCHEMA = "peak_i int, field_i int, aln_x double, aln_y double, l string, level int"


def frame(spark, rows):
    return spark.createDataFrame([(i, f, x, y, "clash", 3) for i, (f, x, y) in enumerate(rows)], SCHEMA).repartition(4)


def drawn(kind, n):
    rng = random.Random(kind)
    if kind == "one field":
        return [(0, rng.uniform(0, 512), rng.uniform(0, 512)) for _ in range(n)]
    if kind == "clusters":  # dense ones, far from each other, lone points, copies
        own = [(rng.randrange(2), rng.choice([0, 1e6]) + rng.gauss(0, 1e-3), rng.gauss(0, 1e-3)) for _ in range(n - 40)]
        return own + own[:30] + [(0, rng.uniform(-1e7, 1e7), rng.uniform(-1e7, 1e7)) for _ in range(10)]
    return [(rng.randrange(5), float(rng.randrange(60)), float(rng.randrange(60))) for _ in range(n)] + [(9, 3.0, 4.0), (8, 1.0, 1.0), (8, 1.0, 1.0), (7, None, 2.0)]


@pytest.mark.parametrize("kind", ["one field", "clusters", "lattice"])
def test_nearest_other(spark, kind):
    rows = drawn(kind, 600)
    got = {r["peak_i"]: r for r in P.crowding(frame(spark, rows), 0.5).collect()}
    assert len(got) == len(rows)
    for i, (f, x, y) in enumerate(rows):
        d = [((x - u) ** 2 + (y - v) ** 2) ** 0.5 for g, u, v in rows if None not in (x, u) and g == f and (u, v) != (x, y)]
        if d:
            assert abs(got[i]["closest"] - min(d)) < 1e-9 * max(1, min(d)) and got[i]["crowded"] == (got[i]["closest"] < 0.5)
        else:
            assert got[i]["closest"] is None and got[i]["crowded"] is False


def test_points_that_go_on_become_few(spark, monkeypatch):
    sizes = []
    plain = P._around
    monkeypatch.setattr(P, "_around", lambda df: (sizes.append(df.count()), plain(df))[1])
    P.nearest_other(frame(spark, drawn("one field", 5000)).selectExpr("field_i", "aln_x AS x", "aln_y AS y")).count()
    assert sizes[0] == 5000 and all(b < 0.7 * a for a, b in zip(sizes, sizes[1:], strict=False))


@pytest.mark.parametrize("kind", ["one field", "lattice"])
def test_outside_rects(spark, kind):
    rng = random.Random(3)
    rows = drawn(kind, 800)
    rects = []
    for _ in range(60):
        w, h = rng.choice([0.25, 1, 8, 300]), rng.choice([0.25, 3, 64, 0, -1])
        l, b = rng.uniform(-50, 500), float(rng.randrange(-50, 500))
        rects.append((rng.choice([0, 0, 1, 2]), l, l + w, b, b + h))
    rects += [(0, None, 5.0, 0.0, 9.0), rects[0]]
    got = {r["peak_i"] for r in P.outside_rects(frame(spark, rows), spark.createDataFrame(rects, "field_i int, l double, r double, b double, t double")).collect()}
    inside = lambda f, x, y: any(g == f and None not in (x, l) and l <= x < r and b <= y < t for g, l, r, b, t in rects)
    assert got == {i for i, p in enumerate(rows) if not inside(*p)}


def test_no_rectangles(spark):
    peaks = frame(spark, drawn("lattice", 20))
    none = spark.createDataFrame([], "field_i int, l double, r double, b double, t double")
    assert P.outside_rects(peaks, none).count() == peaks.count() and P.crowding(peaks.limit(0)).count() == 0


def test_rectangles_meet_cells_not_fields(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rects = spark.createDataFrame([(0, 1.0, 9.0, 1.0, 9.0)], "field_i int, l double, r double, b double, t double")
        plan = P.outside_rects(frame(spark, drawn("one field", 50)), rects)._jdf.queryExecution().executedPlan().toString()
        semi = next(x for x in plan.split("\n") if "LeftSemi" in x)
        assert "cx" in semi and "cy" in semi and "level" in semi
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
