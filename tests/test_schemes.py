"""Sweeps, label sets, sets by digest, places of peptides and one pass of evaluation, against plain forms."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from dyelake.operators import curves as R
from dyelake.operators import relations as J
from dyelake.operators import schemes as S
from dyelake.operators import sequences as Q


def test_any_slice_of_a_sweep(spark):
    axes = {"a": ["x", "y", "z"], "b": spark.createDataFrame([(5,), (3,), (9,), (3,)], "b int"), "c": [["p", "q"], ["r"]]}
    want = [(i, a, b, c) for i, (a, b, c) in enumerate(itertools.product("xyz", [3, 5, 9], [["p", "q"], ["r"]]))]
    assert sorted(tuple(r) for r in S.sweep(spark, axes).collect()) == want
    assert sorted(tuple(r) for r in S.sweep(spark, axes, 4, 11).collect()) == want[4:11]
    assert S.sweep(spark, axes, 18, 99).count() == 0
    assert "CartesianProduct" not in S.sweep(spark, axes)._jdf.queryExecution().executedPlan().toString()


def test_a_long_sweep_is_made_in_parts(spark):
    out = S.sweep(spark, {c: list(range(1000)) for c in "abc"}, 10**9 - 3)
    assert sorted(tuple(r) for r in out.collect()) == [(10**9 - k, 999, 999, 1000 - k) for k in (3, 2, 1)]


def test_label_sets():
    assert S.label_sets_of("A, B,C:2+S,T") == [["A", "B", "S", "T"], ["A", "C", "S", "T"], ["B", "C", "S", "T"]]
    assert S.label_sets_of("A,B") == [["A", "B"]]
    for bad in ("A,B:2", "A:1:2", "A,B,C:1+S+T", "A,B:0"):
        with pytest.raises(ValueError):
            S.label_sets_of(bad)


@pytest.fixture(scope="module")
def survey(spark):
    rng = random.Random(5)
    rows = [(i % 3, rng.randrange(1, 9), i, rng.randrange(3, 20), rng.randrange(2), rng.randrange(1, 3), rng.randrange(4), float(rng.randrange(9))) for i in range(300)]
    df = spark.createDataFrame(rows, "run_i int, pro_i int, pep_i int, pep_len int, p2 int, flu_count int, n_dyes_max_any_ch int, nn_dist double")
    pros = spark.createDataFrame([(i, f"p{i}", int(i in (2, 5, 7))) for i in range(10)], "pro_i int, pro_id string, pro_report int")
    return rows, df, pros, pros.select("pro_i", F.lit(50).alias("length"))


def test_what_limits_leave_and_lose(survey):
    rows, df, pros, lengths = survey
    wanted = S.Wanted(poi_only=True, max_pep_len=5, allow_p2=False, max_dyes=1, n_peps=2, metric="dist_avg")
    out = S.best_peptides(df, pros, lengths, wanted).collect()
    for run in range(3):
        asked = {r[1] for r in rows if r[0] == run and r[1] in (2, 5, 7)}
        left = sorted((r for r in rows if r[0] == run and r[1] in (2, 5, 7) and r[3] <= 5 and r[4] == 0 and r[5] == 1 and r[6] <= 1), key=lambda r: (-r[7], r[3], r[6], r[2]))
        own = {r["pep_i"]: r for r in out if r["run_i"] == run}
        top = [(k + 1, r) for p in asked for k, r in enumerate([r for r in left if r[1] == p][:2])]
        assert set(own) == {r[2] for _, r in top}
        share = len({r[1] for r in left}) / len(asked)
        for rank, r in top:
            same = [x[7] for k, x in top if k == rank]
            mean = sum(same) / len(same)
            got = own[r[2]]
            assert got["nn_rank"] == rank and abs(got["nn_dist_avg"] - (mean if share == 1 else mean * (1 - share))) < 1e-12 and got["nn_dist_min"] == (min(same) if share == 1 else 0)
            assert got["n_lost"] == len(asked) - len({x[1] for x in left}) and got["nn_unique"] == len(left) and abs(got["nn_coverage"] - sum(x[3] for x in left) / 150) < 1e-12


def test_all_proteins_are_of_interest_where_none_is_marked(spark, survey):
    _, df, pros, _ = survey
    none = pros.withColumn("pro_report", F.lit(0))
    assert S.domain(df, none, S.Wanted(poi_only=True, unique_flus_only=False)).rows.count() == df.count()
    with pytest.raises(ValueError, match="sites"):
        S.domain(df, pros, S.Wanted(objective="ptms"))


def test_sites_asked_for_by_name(spark, survey):
    rows, df, pros, _ = survey
    sites = spark.createDataFrame([(i, 1, i % 40) for i in range(0, 300, 2)], "pep_i int, n_pep_ptms int, ptm int")
    asked = S.domain(df, pros, S.Wanted(objective="ptms", ptms=[2, 4, 99], unique_flus_only=False), sites)
    lost = {tuple(r) for r in S.lost(asked).collect()}
    have = {(r[0], r[2] % 40) for r in rows if r[2] % 2 == 0}
    assert lost == {(run, p) for run in range(3) for p in (2, 4, 99) if (run, p) not in have}


def test_sets_by_digest(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(60), rng.choice("abcd")) for _ in range(100)] + [(99, None), (5, "a")]
    keys, members = J.set_dictionary(spark.createDataFrame(rows, "k int, m string").repartition(3), "k", "m")
    want: dict = {}
    for k, m in rows:
        if m:
            want.setdefault(k, set()).add(m)
    of: dict = {}
    for r in members.collect():
        of.setdefault(r["set_id"], set()).add(r["m"])
    found = {r["k"]: r for r in keys.collect()}
    assert found.keys() == want.keys() and len(of) == len({frozenset(s) for s in want.values()})
    assert all(of[found[k]["set_id"]] == s and found[k]["n"] == len(s) for k, s in want.items())


def test_false_calls_list_the_proteins_of_a_fluorosequence(spark):
    """F1 of round 3: the list of proteins had gone from the rows, which had only its digest and number."""
    report = [(1, "B"), (2, "A"), (3, "B"), (4, "C"), (5, None), (6, "A"), (7, "B")]
    flus = dict.fromkeys((1, 2, 3), "x") | {4: "y", 5: "z"} | dict.fromkeys((6, 7), "w")
    falses = [(1, 4), (2, 1), (3, 99), (4, 5), (5, 2), (6, 7)]
    got = J.falses_flus(
        spark.createDataFrame(falses, "pep_i int, false_pep_i int").repartition(3), spark.createDataFrame(report, "pep_i int, pro_id string").repartition(3), spark.createDataFrame([*flus.items()], "pep_i int, flustr string"),
    )[0]
    pro = dict(report)
    of = {f: sorted({pro[p] for p in flus if flus[p] == f and pro[p]}) for f in flus.values()}
    want = {(p, q, pro[p], flus[p], len(m) or None, ",".join(m) or None, pro.get(q), flus.get(q)) for p, q in falses for m in [of[flus[p]]]}
    shown = got.select("pep_i", "false_pep_i", "pro_id", "flustr", "n_flu_pros", "flu_pros", "false_pro_id", "false_flustr").collect()
    assert len(shown) == len(falses) and {tuple(r) for r in shown} == want
    assert (3, 99, "B", "x", 2, "A,B", None, None) in want


def test_places_of_very_many_peptides(spark):
    rng = random.Random(2)
    seq = "".join(rng.choice("AK") for _ in range(60_000))
    df = spark.createDataFrame([(1, seq), (5, "KK"), (2, ""), (3, None), (4, "A")], "k int, s string")
    out = Q.cleave(df, "k", "s", ["lysc"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = out.collect()
    long = [r for r in rows if r["k"] == 1]
    assert "".join(r["seqstr"] for r in long) == seq and len(long) > 20_000
    assert all(seq[r["pep_start"] : r["pep_stop"]] == r["seqstr"] for r in long)
    assert [tuple(r) for r in rows if r["k"] != 1] == [(5, 0, 1, "K"), (5, 1, 2, "K"), (4, 0, 1, "A")]


def test_steps_are_those_of_the_thresholds(spark):
    steps = R.thresholds(50)
    scores = [*steps, *(s + 1e-12 for s in steps), *(s - 1e-12 for s in steps), -3.0, -0.0, 1.0, 7.0, float("inf"), float("-inf"), None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in scores], "s double").coalesce(1).select(R.step_of(F.col("s"), 50)).collect()]
    assert got == [50 if s is None else sum(t > s for t in steps) for s in scores]


def test_evaluation_reads_calls_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    rng = random.Random(4)
    rows = [(rng.choice(["test", "train"]), rng.randrange(6), rng.randrange(6), rng.random()) for _ in range(500)]
    calls = spark.createDataFrame(rows, "part string, true_pep_i int, pred_pep_i int, score double").mapInArrow(counted, "part string, true_pep_i int, pred_pep_i int, score double")
    prior = spark.createDataFrame([(i, 1.0) for i in range(6)], "pep_i int, prior double")
    plain, scaled, totals = R.evaluate(calls, prior, prior.withColumnRenamed("prior", "abundance"), 10, "part")
    assert plain.count() and scaled.count() and reads.value == 500
    assert totals == {"n_calls": 500, "n_nul": sum(r[2] == 0 for r in rows), "n_correct": sum(r[1] == r[2] for r in rows)}
    for part in ("test", "train"):
        own = calls.filter(F.col("part") == part)
        for mine, alone in ((plain, R.pr_curve_by_pep(own, prior, 10)), (scaled, R.pr_by_pep_with_abundance(own, prior.withColumnRenamed("prior", "abundance"), prior, 10))):
            a, b = (sorted((r["pep_i"], -r["score"], r["prec"], r["recall"], round(r["auc"], 12)) for r in d.collect()) for d in (mine.filter(F.col("part") == part), alone))
            assert a == b


def test_one_value_by_channel(spark):
    dyes = [(0, "d1", "z", 0.1, 1.0, 1.0, 0.1), (1, "d2", "a", 0.1, 1.0, 1.0, 0.1), (2, "d3", "z", 0.1, 1.0, 2.0, 0.1)]
    labels = spark.createDataFrame([("D", "l", "d1", 0.0, 0.0), ("K", "m", "d2", 0.0, 0.5)], "aa string, label_name string, dye_name string, p_failure_to_bind double, p_failure_to_attach double")
    table = lambda some: spark.createDataFrame(some, "place int, dye_name string, channel_name string, p_failure double, beta double, sigma double, p_bleach double")
    assert {(r["aa"], r["ch_i"], round(r["p_bright"], 9)) for r in J.label_table(labels, table(dyes[:2])).collect()} == {("D", 0, 0.9), ("K", 1, 0.45)}
    with pytest.raises(Exception, match="one beta, sigma and bleaching"):
        J.label_table(labels, table(dyes)).collect()
