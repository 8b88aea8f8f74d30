"""Queries that do the whole job where their SQL forms do less: compared with plain forms over all rows."""

import duckdb
import numpy as np
import pytest
from conftest import SF

from dyelake.operators import nearest as nearest_tracks
from dyelake.operators.survey import knn_dyetracks
from dyelake.plans.adapters import duck
from dyelake.plans.all_queries import ORACLE_SQL, QUERIES
from dyelake.plans.radmat_queries import CYCLES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


def test_photometry_table_has_every_cycle(spark, con):
    got = QUERIES["photometry_table"](spark, SF)
    want: dict = {}
    for peak, cycle, signal in con.execute(duck("SELECT peak_i, cycle_i, signal FROM radmat")).fetchall():
        want.setdefault(peak, {})[cycle] = signal
    assert 4 < 1 + max(c for own in want.values() for c in own) <= (n := CYCLES) and [c for c in got.columns if c.startswith("FRAME")] == [f"FRAME {c}" for c in range(n)]
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        own = want[r["H"]]
        assert {c: r[f"FRAME {c}"] for c in range(n) if r[f"FRAME {c}"] is not None} == own
        assert r["CATEGORY"] == f"({', '.join(str(own.get(c, 0) > 30000) for c in range(n))})"


def test_a_table_of_more_cycles_is_an_error(spark):
    from dyelake.operators.radmat import signal_by_field_cycle
    from dyelake.sources.fields import photometry_table

    rows = spark.createDataFrame([(0, 0, 1, c, 1.0) for c in range(4)], "field_i int, channel_i int, peak_i int, cycle_i int, signal double")
    for made in (photometry_table(rows, 0.5, 3), signal_by_field_cycle(rows, 3)):
        with pytest.raises(Exception, match="more than 3 cycles"):
            made.collect()
    assert photometry_table(rows, 0.5, 4).count() == signal_by_field_cycle(rows, 5).count() == 1


def test_raw_coordinates_has_every_cycle(spark, con):
    rows = con.execute(duck("SELECT r.peak_i, r.cycle_i, r.field_i, aln_x, aln_y FROM radmat r JOIN peaks p ON p.peak_i = r.peak_i")).fetchall()
    raw = [(p, c, x - ((c + 1) * 4 - f), y - (f * 3 - 20)) for p, c, f, x, y in rows]
    want = sorted(x for x in raw if 100 <= x[2] < 400 and 100 <= x[3] < 400)
    got = sorted((r["peak_i"], r["cycle_i"], r["raw_x"], r["raw_y"]) for r in QUERIES["raw_coordinates"](spark, SF).collect())
    assert got == want and max(c for _, c, *_ in got) > 6


def nearest(ids, vecs, k):
    v = np.array(vecs, np.float64)
    out = []
    for i, x in zip(ids, v, strict=True):
        d = ((v - x) ** 2).sum(1)
        out += [(i, ids[j], round(float(d[j]), 6), n + 1) for n, j in enumerate(sorted(range(len(ids)), key=lambda j: (round(d[j], 9), ids[j]))[:k])]
    return sorted(out)


def test_knn_dyetracks_searches_every_vector(spark, con):
    ids, vecs = zip(*con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY 1").fetchall(), strict=True)
    got = QUERIES["knn_dyetracks"](spark, SF)
    assert sorted((r["row_i"], r["dyt_i"], r["dist2"], r["rank"]) for r in got.collect()) == nearest(ids, vecs, 4)


@pytest.mark.parametrize("block_rows", [4, 4096])
def test_knn_dyetracks_of_copies_and_far_vectors(spark, block_rows, monkeypatch):
    monkeypatch.setattr(nearest_tracks, "BLOCK_TRACKS", block_rows)
    rng = np.random.default_rng(5)
    vecs = [*([[1.0, 2.0, 3.0]] * 9), *rng.integers(-2, 3, (12, 3)).astype(float).tolist(), *(1e6 + rng.integers(0, 3, (9, 3))).tolist()]
    ids = [int(i) for i in rng.permutation(len(vecs))]
    rows = spark.createDataFrame(list(zip(ids, vecs, strict=True)), "row_i long, vec array<double>")
    got = knn_dyetracks(rows, rows.withColumnRenamed("row_i", "dyt_i"), 4)
    assert sorted((r["row_i"], r["dyt_i"], round(r["dist2"], 6), r["rank"]) for r in got.collect()) == sorted(nearest(*zip(*sorted(zip(ids, vecs, strict=True)), strict=True), 4))


def test_coverage_without_a_unique_peptide_is_null_as_in_sql(spark, tmp_path):
    """Twice the parts: no fluorosequence is a peptide's own any more."""
    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.sql(f"COPY (FROM '{SF}/{t}.parquet') TO '{tmp_path}/{t}.parquet'")
    con.sql(f"COPY (SELECT p_partkey + k * 1000000 AS p_partkey, * EXCLUDE (p_partkey, k) FROM '{SF}/part.parquet', range(2) r(k)) TO '{tmp_path}/part.parquet'")
    for t in ("lineitem", "supplier", "part"):
        con.sql(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["protein_coverage"]).fetchall()
    assert want == [(None,)] == [tuple(r) for r in QUERIES["protein_coverage"](spark, str(tmp_path)).collect()]


def test_residues_are_made_after_their_join(spark):
    """Residues of many peptides never go to the driver as a side of a broadcast join."""
    df = QUERIES["pepseqs_no_decoys"](spark, SF)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")
    # The first join is that of residues or tokens.
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert physical.index("SortMergeJoin") < physical.index("BroadcastHashJoin") if "BroadcastHashJoin" in physical else "SortMergeJoin" in physical


def test_lists_that_rows_share_are_written_once(spark, tmp_path, monkeypatch):
    """Thirty lists of 100 KB for 1,500 rows, some of them without one: 150 MB of text in a few MB of files, in parcels of few rows."""
    from dyelake.operators import relations as J

    monkeypatch.setattr(J, "PARCEL_ROWS", 20, raising=False)
    rng = np.random.default_rng(3)
    names = {f"f{i}": sorted(rng.bytes(50).hex() for _ in range(1000)) for i in range(30)}
    report = spark.createDataFrame([(i * 1000 + j, p) for i, own in enumerate(names.values()) for j, p in enumerate(own)] + [(-1, None)], "pep_i int, pro_id string")
    flus = spark.createDataFrame([(i * 1000 + j, f) for i, f in enumerate(names) for j in range(1000)] + [(-1, "none")], "pep_i int, flustr string")
    falses = spark.createDataFrame([(i * 1000 + j % 7, j) for i in range(30) for j in range(50)] + [(-1, j) for j in range(9)], "pep_i int, false_pep_i int")
    J.falses_flus(falses.repartition(3), report, flus)[0].write.parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out").select("pep_i", "false_pep_i", "flu_pros", "n_flu_pros", "false_flustr").collect()
    lists = {k: ",".join(own) for k, own in names.items()}
    want = [(i * 1000 + j % 7, j, lists[f"f{i}"], 1000, "f0") for i in range(30) for j in range(50)] + [(-1, j, None, None, "f0") for j in range(9)]
    assert sorted(map(tuple, got), key=lambda r: r[:2]) == sorted(want, key=lambda r: r[:2])
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 20_000_000
