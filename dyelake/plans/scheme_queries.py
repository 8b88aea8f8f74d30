"""Queries over best peptides, experiment designs and sweeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from dyelake.operators import relations as J
from dyelake.operators import schemes as S
from dyelake.operators import survey as V
from dyelake.plans.adapters import over, view
from dyelake.plans.registry import query
from dyelake.plans.sequence_queries import _SITES

_POI = "SELECT pro_i FROM pros WHERE pro_report > 0 OR NOT (SELECT bool_or(pro_report > 0) FROM pros)"
_SITE_ROWS = f"sites AS (SELECT pep_i, CAST(len(s) AS INT) AS n_pep_ptms, unnest(s) AS ptm FROM (SELECT pep_i, {_SITES} AS s FROM peps JOIN pros USING (pro_i) WHERE NOT pro_is_decoy))"


def _facts(rows: str = "d") -> str:
    return f"""cov AS (SELECT run_i, sum(CASE WHEN flu_count = 1 AND pro_i IN ({_POI}) THEN pep_len ELSE 0 END) / (SELECT sum(100 + pro_i % 9) FROM pros WHERE pro_i IN ({_POI})) AS nn_coverage,
count(*) FILTER (flu_count = 1) AS nn_unique FROM {rows} GROUP BY 1)"""


_BEST_FIRST = "nn_dist DESC, pep_len, n_dyes_max_any_ch, pep_i"


def _ranked(key: str, top: str, order: str, n_runs: int) -> str:
    """SQL of a job's best runs from d (rows left), q (requested) and top (rows by nn_rank)."""
    return f"""{_facts()}, st AS (SELECT run_i, nn_rank, avg(nn_dist) AS a, min(nn_dist) AS m FROM {top} GROUP BY ALL),
fp AS (SELECT run_i, coalesce(f, 0) / n AS filter_pass, n - coalesce(f, 0) AS n_lost FROM (SELECT run_i, count(*) AS n FROM q GROUP BY 1) LEFT JOIN (SELECT run_i, count(DISTINCT {key}) AS f FROM d JOIN q USING (run_i, {key}) GROUP BY 1) USING (run_i)),
o AS (SELECT t.*, nn_coverage, nn_unique, filter_pass, n_lost, CASE WHEN filter_pass = 1 THEN a ELSE a * (1 - filter_pass) END AS nn_dist_avg, CASE WHEN filter_pass = 1 THEN m ELSE 0 END AS nn_dist_min FROM {top} t JOIN st USING (run_i, nn_rank) JOIN cov USING (run_i) JOIN fp USING (run_i)),
b AS (SELECT run_i, max(({order})) AS best FROM o GROUP BY 1), r AS (SELECT run_i, row_number() OVER (ORDER BY best DESC, run_i) AS run_rank FROM b)
SELECT CAST(run_rank AS INT) AS run_rank, run_i, pro_i, pep_i, CAST(nn_rank AS INT) AS nn_rank, nn_dist, round(nn_dist_avg, 9) AS nn_dist_avg, nn_dist_min, round(nn_coverage, 9) AS nn_coverage, nn_unique, round(filter_pass, 9) AS filter_pass, n_lost FROM o JOIN r USING (run_i) WHERE run_rank <= {n_runs}"""


_COLUMNS = ["run_rank", "run_i", "pro_i", "pep_i", "nn_rank", "nn_dist", "nn_dist_avg", "nn_dist_min", "nn_coverage", "nn_unique", "filter_pass", "n_lost"]


def _tables(spark, sf_dir):
    pros = view(spark, sf_dir, "pros")
    return view(spark, sf_dir, "survey"), pros, pros.select("pro_i", (100 + F.col("pro_i") % 9).alias("length"))


def _sites(spark, sf_dir):
    return J.peps_ptms(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), to_rows=True).select("pep_i", "n_pep_ptms", "ptm")


def _shown(df, *columns):
    return df.withColumns({c: F.round(c, 9) for c in ("nn_dist_avg", "nn_coverage", "filter_pass") if c in df.columns}).select(*columns)


@query(f"""WITH d AS (SELECT * FROM survey WHERE pep_len <= 40), {_facts()}, t AS (SELECT *, row_number() OVER (PARTITION BY run_i ORDER BY {_BEST_FIRST}) AS p FROM d)
SELECT run_i, pro_i, pep_i, nn_dist, round(nn_coverage, 9) AS nn_coverage, nn_unique FROM t JOIN cov USING (run_i) WHERE p <= 50""")
def best_peptides(spark, sf_dir):
    """T-3: the fifty most isolated peptides of each run, with the run's coverage and unique peptides."""
    out = S.best_peptides(*_tables(spark, sf_dir), S.Wanted(max_pep_len=40, unique_flus_only=False, n_peps=50))
    return _shown(out, "run_i", "pro_i", "pep_i", "nn_dist", "nn_coverage", "nn_unique")


_POI_ROWS = f"q AS (SELECT DISTINCT run_i, pro_i FROM survey WHERE pro_i IN ({_POI})), d AS (SELECT * FROM survey WHERE pro_i IN ({_POI}) AND n_dyes_max_any_ch <= 2 AND p2 = 0 AND pep_len <= 20)"


@query(f"WITH {_POI_ROWS}, top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_i, pro_i ORDER BY {_BEST_FIRST}) AS nn_rank FROM d) WHERE nn_rank <= 2), {_ranked('pro_i', 'top', 'nn_dist_avg, nn_dist_min, nn_coverage', 2)}")
def best_schemes_of_interest(spark, sf_dir):
    """T-2, T-3, P-8: the two best runs by mean distance of each rank, of proteins of interest within limits, with their peptides and what was lost."""
    wanted = S.Wanted(poi_only=True, max_dyes=2, allow_p2=False, max_pep_len=20, unique_flus_only=False, n_peps=2, metric="dist_avg")
    return _shown(S.best_schemes(*_tables(spark, sf_dir), wanted, 2), *_COLUMNS)


@query(f"WITH q AS (SELECT DISTINCT run_i, pro_i FROM survey), d AS (SELECT * FROM survey), top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_i, pro_i ORDER BY {_BEST_FIRST}) AS nn_rank FROM d) WHERE nn_rank <= 3), {_ranked('pro_i', 'top', 'nn_dist_min, nn_dist_avg, nn_coverage', 3)}")
def best_schemes_of_all(spark, sf_dir):
    """T-2, T-3: runs by the least distance of each rank, with three peptides of every protein."""
    return _shown(S.best_schemes(*_tables(spark, sf_dir), S.Wanted(unique_flus_only=False, n_peps=3, metric="dist_min"), 3), *_COLUMNS)


_PTM_ROWS = f"{_SITE_ROWS}, j AS (SELECT survey.*, n_pep_ptms, ptm FROM survey JOIN sites USING (pep_i)), q AS (SELECT DISTINCT run_i, ptm FROM j), d AS (SELECT * FROM j WHERE n_pep_ptms <= 1 AND p2 = 0 AND pep_len <= 12)"


@query(f"WITH {_PTM_ROWS}, top AS (SELECT *, 1 AS nn_rank FROM d), {_ranked('ptm', 'top', 'nn_coverage, nn_dist_avg, nn_dist_min', 2)}".replace("pep_i, CAST(nn_rank", "pep_i, ptm, CAST(nn_rank"))
def best_schemes_of_sites(spark, sf_dir):
    """T-2, T-3, P-8: runs by coverage, of peptides with one modification site, a row a site."""
    wanted = S.Wanted(objective="ptms", max_ptms=1, allow_p2=False, max_pep_len=12, unique_flus_only=False, metric="coverage")
    return _shown(S.best_schemes(*_tables(spark, sf_dir), wanted, 2, _sites(spark, sf_dir)), *_COLUMNS, "ptm")


@query(f"WITH {_SITE_ROWS} SELECT run_i, pep_i, n_pep_ptms, ptm FROM survey JOIN sites USING (pep_i) WHERE pro_i IN ({_POI}) AND n_pep_ptms <= 2 AND ptm IN (1, 3, 5, 8, 9, 10) AND flu_count <> 0")
def survey_of_sites(spark, sf_dir):
    """P-8: survey rows of proteins of interest, of at most two sites, at some of them."""
    wanted = S.Wanted(poi_only=True, max_ptms=2, ptms=[1, 3, 5, 8, 9, 10], unique_flus_only=False)
    survey, pros, _ = _tables(spark, sf_dir)
    return S.domain(survey, pros, wanted, _sites(spark, sf_dir)).rows.select("run_i", "pep_i", "n_pep_ptms", "ptm")


@query(f"WITH {_POI_ROWS} SELECT run_i, pro_i FROM q WHERE (run_i, pro_i) NOT IN (SELECT (run_i, pro_i) FROM d)")
def lost_proteins(spark, sf_dir):
    """T-3, U-3: proteins of interest that limits left without a peptide, by run."""
    survey, pros, _ = _tables(spark, sf_dir)
    return S.lost(S.domain(survey, pros, S.Wanted(poi_only=True, max_dyes=2, allow_p2=False, max_pep_len=20, unique_flus_only=False)))


@query(f"""WITH d AS (SELECT * FROM survey WHERE pep_len <= 30), {_facts()}, u AS (SELECT run_i, max(nn_dist) FILTER (flu_count = 1) AS nn_dist FROM d GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY nn_coverage DESC, nn_dist DESC NULLS LAST, nn_unique DESC, run_i) AS INT) AS run_rank, run_i, nn_unique AS nn_uniques, round(nn_coverage, 9) AS nn_coverage, nn_dist FROM cov JOIN u USING (run_i)""")
def schemes_by_coverage(spark, sf_dir):
    """T-2: runs by coverage of proteins of interest."""
    out = S.schemes_by_coverage(*_tables(spark, sf_dir), S.Wanted(max_pep_len=30, unique_flus_only=False), 10)
    return _shown(out, "run_rank", "run_i", "nn_uniques", "nn_coverage", "nn_dist")


@query("""WITH p AS (SELECT DISTINCT p_type AS protease FROM part), l AS (SELECT [a.x, b.x, 'suffix'] AS label_set, row_number() OVER (ORDER BY a.x, b.x) AS i FROM (SELECT DISTINCT p_brand AS x FROM part) a JOIN (SELECT DISTINCT p_brand AS x FROM part) b ON a.x < b.x),
e AS (SELECT DISTINCT p_size AS err_beta FROM part) SELECT row_number() OVER (ORDER BY protease, i, err_beta) - 1 AS scheme_i, protease, label_set, err_beta FROM p, l, e""")
def scheme_sweep(spark, sf_dir):
    """J-25, F-14: every protease with every label set (two labels and a suffix) and error, from values that the table has."""
    part = over(spark, sf_dir, "SELECT p_type, p_brand, p_size FROM part")
    labels = V.label_sets(part.select(F.col("p_brand").alias("label")).distinct(), 2, ["suffix"])
    return S.sweep(spark, {"protease": part.select("p_type"), "label_set": labels, "err_beta": part.select("p_size")})


@query("""WITH n AS (SELECT x, y, z, row_number() OVER (ORDER BY x, y, z) - 1 AS dyt_i FROM range(0, 4) a(x), range(0, 4) b(y), range(0, 4) c(z) WHERE y BETWEEN x - 1 AND x AND z BETWEEN y - 1 AND y)
SELECT dyt_i, [CAST(x AS INT), CAST(y AS INT), CAST(z AS INT)] AS dyetrack, count(d0) AS n_reads FROM n LEFT JOIN reads ON d0 = x AND d1 = y AND d2 = z GROUP BY ALL""")
def step_dyetracks(spark, sf_dir):
    """M-4: all tracks that drop one dye at a time, and how many reads have each."""
    reads = view(spark, sf_dir, "reads").groupBy(F.array("d0", "d1", "d2").alias("dyetrack")).agg(F.count(F.lit(1)).alias("n_reads"))
    return V.step_dyetracks(spark, 3, 3).join(reads, "dyetrack", "left").na.fill(0, ["n_reads"]).select(F.col("dyt_i").cast("long").alias("dyt_i"), "dyetrack", "n_reads")
