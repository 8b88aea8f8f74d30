"""Queries over surveys, runs and dyetracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from dyelake.operators import survey as S
from dyelake.plans.adapters import over, view
from dyelake.plans.registry import query


@query("SELECT run_i, pep_i, pro_i FROM survey WHERE pep_len <= 30 AND n_dyes_max_any_ch <= 2 AND p2 = 0 AND pro_i IN (SELECT pro_i FROM pros WHERE pro_report > 0)")
def survey_filters(spark, sf_dir):
    """P-8: survey rows within limits, of reported proteins."""
    return S.survey_filters(view(spark, sf_dir, "survey"), 30, 2, False, view(spark, sf_dir, "pros").filter("pro_report > 0")).select("run_i", "pep_i", "pro_i")


@query("SELECT count(*) FILTER (flu_count = 1) AS n_uniques, max(nn_dist) AS max_nn_dist, round(avg(nn_dist), 9) AS avg_nn_dist, min(nn_dist) AS min_nn_dist FROM survey")
def nn_stats(spark, sf_dir):
    """A-38: unique peptides and distances."""
    return S.nn_stats(view(spark, sf_dir, "survey")).withColumn("avg_nn_dist", F.round("avg_nn_dist", 9))


@query("SELECT (SELECT sum(pep_len) FROM survey WHERE flu_count = 1 AND pro_i IN (SELECT pro_i FROM pros)) / sum(100 + pro_i % 9) AS coverage FROM pros")
def protein_coverage(spark, sf_dir):
    """A-37: share of residues in unique peptides."""
    return S.coverage(view(spark, sf_dir, "survey"), view(spark, sf_dir, "pros").select("pro_i", (100 + F.col("pro_i") % 9).alias("length")))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY run_i, pro_i ORDER BY nn_dist DESC, pep_len, n_dyes_max_any_ch, pep_i) AS nn_rank FROM survey), t AS (SELECT * FROM r WHERE nn_rank <= 3)
SELECT run_i, pro_i, pep_i, CAST(nn_rank AS INT) AS nn_rank, nn_dist, round(avg(nn_dist) OVER w, 9) AS nn_dist_avg, min(nn_dist) OVER w AS nn_dist_min FROM t WINDOW w AS (PARTITION BY run_i, nn_rank)""")
def rank_peps_per_protein(spark, sf_dir):
    """W-14: the three most isolated peptides of each protein and run."""
    return S.rank_peps_per_protein(view(spark, sf_dir, "survey"), 3).withColumn("nn_dist_avg", F.round("nn_dist_avg", 9))


@query("SELECT run_i, pep_i, nn_dist FROM survey ORDER BY nn_dist DESC, pep_len, n_dyes_max_any_ch, pep_i, run_i LIMIT 20")
def max_nn_dist_peps(spark, sf_dir):
    """T-3: the twenty most isolated peptides."""
    return S.max_nn_dist_peps(view(spark, sf_dir, "survey"), 20).select("run_i", "pep_i", "nn_dist")


@query("SELECT run_name, max(job_i) AS job_i, arg_max(status, (job_i, status)) AS status FROM runs GROUP BY 1")
def latest_runs(spark, sf_dir):
    """W-15: of runs of one name, the last job's."""
    return S.latest_runs(view(spark, sf_dir, "runs"))


_BEST = """f AS (SELECT *, bool_or(recall >= 0.7) OVER (PARTITION BY pep_i) AS fine FROM prs), g AS (SELECT *, CASE WHEN fine THEN prec ELSE recall END AS a, CASE WHEN fine THEN recall ELSE prec END AS b FROM f WHERE recall >= 0.7 OR NOT fine),
o AS (SELECT *, row_number() OVER (PARTITION BY pep_i, run_i ORDER BY a DESC, b DESC, score DESC, prec DESC, recall DESC) AS r FROM g),
best AS (SELECT pep_i, run_i, prec, recall, score, CAST(row_number() OVER (PARTITION BY pep_i ORDER BY a DESC, b DESC, run_i) AS INT) AS rank FROM o WHERE r = 1)"""


@query(f"WITH {_BEST} SELECT * FROM best WHERE rank <= 2")
def best_prec_at_recall(spark, sf_dir):
    """W-7, J-16: each peptide's two best runs."""
    return S.best_prec_at_recall(view(spark, sf_dir, "prs"), 0.7, 2)


@query(f"WITH {_BEST} SELECT run_i, count(*) OVER (PARTITION BY run_i) AS n, pep_i FROM best WHERE rank = 1")
def runs_by_best_peps(spark, sf_dir):
    """A-43: how many peptides each run is best for, and which."""
    return S.runs_by_best_peps(S.best_prec_at_recall(view(spark, sf_dir, "prs"), 0.7, 1))


@query("WITH b AS (SELECT run_i, max(nn_dist) AS best, sum(nn_dist) AS t FROM survey GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY best DESC, t DESC, run_i) AS INT) AS run_rank, run_i, best FROM b ORDER BY run_rank LIMIT 2")
def best_schemes(spark, sf_dir):
    """T-2: the two best runs."""
    return S.best_schemes(view(spark, sf_dir, "survey"), 2)


@query("SELECT dyt_i, pep_i, n_reads FROM (SELECT *, row_number() OVER (PARTITION BY dyt_i ORDER BY n_reads DESC, pep_i) AS r FROM dyepeps) WHERE r = 1")
def most_likely_pep(spark, sf_dir):
    """W-16: each dyetrack's likeliest peptide."""
    return S.most_likely_pep(view(spark, sf_dir, "dyepeps"))


@query("SELECT dyt_i, CAST(sum(n_reads) AS BIGINT) AS weight FROM dyepeps GROUP BY 1")
def dyt_weights(spark, sf_dir):
    """A-15: reads of each dyetrack."""
    return S.dyt_weights(view(spark, sf_dir, "dyepeps"))


_TRACKS = "c AS (SELECT pep_i, d0, d1, d2, count(*) AS n_reads FROM reads GROUP BY ALL), t AS (SELECT d0, d1, d2, row_number() OVER (ORDER BY d0 + d1 + d2 > 0, d0, d1, d2) - CASE WHEN (SELECT count(*) FROM c WHERE d0 + d1 + d2 = 0) > 0 THEN 1 ELSE 0 END AS dyt_i FROM (SELECT DISTINCT d0, d1, d2 FROM c))"


@query(f"WITH {_TRACKS} SELECT CAST(dyt_i AS INT) AS dyt_i, pep_i, n_reads FROM c JOIN t USING (d0, d1, d2)")
def dyetrack_catalogue(spark, sf_dir):
    """A-14: dyetracks numbered and counted by peptide."""
    return S.dyetrack_catalogue(view(spark, sf_dir, "reads").select("pep_i", F.array("d0", "d1", "d2").alias("dyetrack")))[1]


@query("SELECT pep_i, count(*) FILTER (d0 + d1 + d2 > 0) / count(*) AS recall FROM reads GROUP BY 1")
def pep_recalls(spark, sf_dir):
    """A-14: share of a peptide's reads that aren't dark."""
    return S.dyetrack_catalogue(view(spark, sf_dir, "reads").select("pep_i", F.array("d0", "d1", "d2").alias("dyetrack")))[2]


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), d AS (SELECT a.vec_id AS row_i, b.vec_id AS dyt_i, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS dist2 FROM e a, e b),
r AS (SELECT *, row_number() OVER (PARTITION BY row_i ORDER BY round(dist2, 9), dyt_i) AS rank FROM d) SELECT row_i, dyt_i, round(dist2, 6) AS dist2, CAST(rank AS INT) AS rank FROM r WHERE rank <= 4""")
def knn_dyetracks(spark, sf_dir):
    """J-23: the four nearest tracks of every vector; every vector is a track."""
    rows = over(spark, sf_dir, "SELECT vec_id AS row_i, embedding AS vec FROM embeddings")
    return S.knn_dyetracks(rows, rows.withColumnRenamed("row_i", "dyt_i"), 4).withColumn("dist2", F.round("dist2", 6))


@query("SELECT a.p_brand, b.p_size FROM (SELECT DISTINCT p_brand FROM part) a, (SELECT DISTINCT p_size FROM part) b")
def param_sweep(spark, sf_dir):
    """J-25: all combinations of two parameters' values."""
    part = over(spark, sf_dir, "SELECT p_brand, p_size FROM part")
    return S.param_sweep(part.select("p_brand").distinct(), part.select("p_size").distinct())


@query("SELECT DISTINCT pro_id AS lost FROM pros WHERE pro_i NOT IN (SELECT pro_i FROM survey WHERE pep_len <= 20)")
def domain_loss(spark, sf_dir):
    """U-3: proteins that a filter left without peptides."""
    from dyelake.operators.relations import domain_loss as lost

    pros = view(spark, sf_dir, "pros")
    kept = S.survey_filters(view(spark, sf_dir, "survey"), 20).join(pros.select("pro_i", "pro_id"), "pro_i")
    return lost(pros, kept, "pro_id")


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS r, list_transform(embedding::DOUBLE[], lambda x: floor(abs(x) * 10)) AS d FROM embeddings),
s AS (SELECT vec_id, list_sum(list_transform(r, lambda x: x * x)) AS a, 2 * list_sum(list_transform(list_zip(r, d), lambda x: x[1] * x[2])) AS b FROM v) SELECT vec_id, round(CASE WHEN b > 0 THEN a / b ELSE 10 END, 6) AS k FROM s""")
def fit_row_k(spark, sf_dir):
    """M-3: each row's scale against its dyetrack."""
    rows = over(spark, sf_dir, "SELECT vec_id, embedding FROM embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("radrow"))
    rows = rows.withColumn("dyetrack", F.transform("radrow", lambda x: F.floor(F.abs(x) * 10).cast("double")))
    return S.fit_row_k(rows, 2.0).select("vec_id", F.round("k", 6).alias("k"))


@query("SELECT * FROM calls WHERE true_pep_i IN (SELECT pep_i FROM peps JOIN pros USING (pro_i) WHERE NOT pro_is_decoy)")
def train_of_real_peps(spark, sf_dir):
    """J-24: calls of real proteins' peptides."""
    return S.train_of_real_peps(view(spark, sf_dir, "calls"), view(spark, sf_dir, "peps"), view(spark, sf_dir, "pros"))


@query("SELECT run_name, count(DISTINCT status) AS n FROM runs GROUP BY 1 HAVING count(DISTINCT status) > 1")
def differing_across_runs(spark, sf_dir):
    """U-6: runs of one name whose values differ."""
    return S.differing_across_runs(view(spark, sf_dir, "runs"), "run_name", "status")


@query("WITH b AS (SELECT DISTINCT n_name AS x FROM nation) SELECT a.x AS first, b.x AS second FROM b a, b WHERE a.x < b.x")
def label_sets(spark, sf_dir):
    """F-14: all pairs of labels."""
    from dyelake.sources.tables import table

    out = S.label_sets(table(spark, sf_dir, "nation").select(F.col("n_name").alias("label")).distinct(), 2)
    return out.select(F.col("labels")[0].alias("first"), F.col("labels")[1].alias("second"))


@query("SELECT CASE WHEN run_i < 2 THEN 0 ELSE 1 END AS run_i, CASE WHEN run_i < 2 THEN 'early' ELSE 'late' END AS run_name, true_pep_i, pred_pep_i, score FROM calls")
def all_runs(spark, sf_dir):
    """U-1: runs' frames as one table."""
    calls = view(spark, sf_dir, "calls")
    return S.all_runs((0, "early", calls.filter("run_i < 2")), (1, "late", calls.filter("run_i >= 2")))


@query("""WITH k AS (SELECT run_i, true_pep_i, pred_pep_i, CAST(round(score * 50) AS INT) AS q FROM calls), r AS (SELECT *, row_number() OVER (PARTITION BY true_pep_i ORDER BY md5(concat_ws(':', 'draw', run_i, true_pep_i, pred_pep_i, q)), run_i, true_pep_i, pred_pep_i, q) AS r FROM k)
SELECT * EXCLUDE (r) FROM r WHERE r <= 5""")
def subsample_per_class(spark, sf_dir):
    """T-6: at most five rows of each true peptide, drawn by a hash that SQL has too."""
    from dyelake.operators.calls import subsample_per_class as sample

    rows = view(spark, sf_dir, "calls").select("run_i", "true_pep_i", "pred_pep_i", F.round(F.col("score") * 50).cast("int").alias("q"))
    text = F.concat_ws(":", F.lit("draw"), *(F.col(c).cast("string") for c in rows.columns))
    return sample(rows, 5, draw=F.md5(text.cast("binary")))


@query("SELECT pros.pro_id, peps.pep_i, run_i, score, prec, recall FROM peps JOIN pros USING (pro_i) LEFT JOIN prs ON prs.pep_i = peps.pep_i WHERE NOT pro_is_decoy")
def peps_prs_report(spark, sf_dir):
    """J-16: real proteins' peptides with every run's points."""
    report = view(spark, sf_dir, "peps").join(view(spark, sf_dir, "pros").filter("NOT pro_is_decoy"), "pro_i").select("pep_i", "pro_id")
    return S.peps_prs_report(report, view(spark, sf_dir, "prs")).select("pro_id", "pep_i", "run_i", "score", "prec", "recall")


_REPORT = "SELECT prs.run_i, prs.pep_i, score, prec, p2, pep_start, pep_stop, flu_count, n_dyes_max_any_ch, pro_i, seq AS seqstr, pep_start % 3 AS n_pep_ptms, pep_stop AS ptm FROM prs JOIN survey ON survey.pep_i = prs.pep_i JOIN pep_strings s ON s.pep_i = prs.pep_i"


@query(f"SELECT run_i, pep_i, score, prec FROM ({_REPORT}) WHERE run_i IN (0, 1, 2) AND run_i NOT IN (2) AND p2 = 0 AND pep_stop - pep_start <= 40 AND n_dyes_max_any_ch <= 2 AND n_pep_ptms <= 1")
def best_run_prefilters(spark, sf_dir):
    """P-9: points of chosen runs and of peptides within limits."""
    rows = S.best_run_prefilters(over(spark, sf_dir, _REPORT), [0, 1, 2], [2], False, max_pep_len=40, max_dyes=2, max_ptms=1)
    return rows.select("run_i", "pep_i", "score", "prec")


@query(f"SELECT run_i, pep_i, ptm FROM ({_REPORT}) WHERE flu_count = 1 AND ptm <= 12 AND ptm >= 5")
def best_run_prefilters_of_sites(spark, sf_dir):
    """P-9: points of peptides of a fluorosequence of their own, with chosen sites."""
    return S.best_run_prefilters(over(spark, sf_dir, _REPORT), unique_peps=True, ptms=list(range(5, 13))).select("run_i", "pep_i", "ptm")


@query("WITH b AS (SELECT DISTINCT pep_stop FROM survey) SELECT pep_stop, pep_stop IN (SELECT pep_stop FROM survey WHERE pep_len <= 20 AND p2 = 0) AS remains FROM b")
def remaining_and_removed(spark, sf_dir):
    """U-4: which sites a filter leaves and which it removes."""
    rows = view(spark, sf_dir, "survey")
    return S.remaining_and_removed(rows, S.survey_filters(rows, 20, allow_p2=False), "pep_stop")


_COUNTS = "SELECT CAST(s_suppkey % 50 AS INT) AS dyt_i, CAST(max(s_suppkey % 4) AS INT) AS top FROM supplier GROUP BY 1"


@query(f"WITH t AS ({_COUNTS}), j AS (SELECT top FROM calls_k JOIN t USING (dyt_i)) SELECT top AS count_class, round(count(*) / (SELECT count(*) FROM j), 9) AS share FROM j GROUP BY 1")
def count_class_summary(spark, sf_dir):
    """A-40: shares of calls by the largest count of their track."""
    from dyelake.operators.calls import count_class_summary as summary

    tracks = over(spark, sf_dir, _COUNTS).select("dyt_i", F.array(F.lit(0), "top").alias("dyetrack"))
    return summary(view(spark, sf_dir, "calls_k"), tracks).withColumn("share", F.round("share", 9))


@query("SELECT true_pep_i, score, round(exp(-((score - 0.5) / 0.2) * ((score - 0.5) / 0.2) / 2), 9) AS weight FROM calls")
def gaussian_weights(spark, sf_dir):
    """F-12: a Gaussian of every score."""
    from dyelake.functions.numbers import gaussian

    return view(spark, sf_dir, "calls").select("true_pep_i", "score", F.round(gaussian("score", 0.5, 0.2), 9).alias("weight"))


@query()
def subsample(spark, sf_dir):
    """T-5: a thousand calls, drawn by hash."""
    from dyelake.operators.calls import subsample as sample

    return sample(view(spark, sf_dir, "calls"), 1000)


@query()
def sample_calls(spark, sf_dir):
    """T-5: as many calls again, drawn with replacement."""
    from dyelake.operators.calls import sample_calls as sample

    return sample(view(spark, sf_dir, "calls"), 1.0)


@query()
def limit_peptides(spark, sf_dir):
    """T-7: peptide 0 and a hundred others."""
    from dyelake.operators.sequences import limit_peptides as limited

    return limited(view(spark, sf_dir, "peps"), 100)


# Signals of tracks that were read, a little off: one row a line.
_SIGNALS = """SELECT CAST(peak_i AS BIGINT) * 64 + cycle_i AS row_i, pep_i, signal, d0, d1, d2, noise FROM (SELECT peak_i, cycle_i, signal, noise, CAST(floor(signal) AS INT) AS pep_i,
CAST(floor(signal / 7) AS INT) % 3 AS d0, CAST(floor(noise) AS INT) % 3 AS d1, CAST(floor(signal / 11) AS INT) % 2 AS d2 FROM radmat)"""


def _signals(spark, sf_dir):
    """(row_i, dyetrack, vec): each line's track and its signals, with errors of about a tenth."""
    rows = over(spark, sf_dir, _SIGNALS)
    off = lambda c: (F.pmod(F.xxhash64("row_i", F.lit(c)), F.lit(2001)) - 1000) / 10000.0
    lit = [F.when(F.col(c) > 0, 7000.0 * F.col(c) * (1 + off(c))).otherwise(1000.0 * off(c)) for c in ("d0", "d1", "d2")]
    return rows.select("row_i", F.array("d0", "d1", "d2").alias("dyetrack"), (F.col("row_i") % 300).cast("int").alias("pep_i"), F.array(*lit).alias("vec"))


def _catalogue(rows):
    tracks, dyepeps, _ = S.dyetrack_catalogue(rows.select("pep_i", "dyetrack"))
    return tracks.withColumnRenamed("dyetrack", "vec"), dyepeps


@query()
def classify_nn(spark, sf_dir):
    """M-1: every row's likeliest track and peptide of its eight nearest."""
    from dyelake.operators.classify import classify_nn as classify

    rows = _signals(spark, sf_dir)
    return classify(rows.select("row_i", "vec"), *_catalogue(rows))


@query()
def score_against_all(spark, sf_dir):
    """M-2: likelihood and scale of each fiftieth row with every track."""
    from dyelake.operators.classify import score_against_all as score

    rows = _signals(spark, sf_dir)
    return score(rows.filter("row_i % 50 = 0").select("row_i", "vec"), _catalogue(rows)[0])


@query("WITH b AS (SELECT run_i, avg(nn_dist) AS best, sum(nn_dist) AS t FROM survey GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY best DESC, t DESC, run_i) AS INT) AS run_rank, run_i, round(best, 9) AS best FROM b")
def best_schemes_by_mean(spark, sf_dir):
    """T-2: runs by their peptides' mean distance."""
    return S.best_schemes(view(spark, sf_dir, "survey"), 10, "nn_dist_avg").withColumn("best", F.round("best", 9))


@query("WITH b AS (SELECT run_i, min(nn_dist) AS best, sum(nn_dist) AS t FROM survey GROUP BY 1) SELECT CAST(row_number() OVER (ORDER BY best DESC, t DESC, run_i) AS INT) AS run_rank, run_i, best FROM b")
def best_schemes_by_least(spark, sf_dir):
    """T-2: runs by the least distance of their peptides."""
    return S.best_schemes(view(spark, sf_dir, "survey"), 10, "nn_dist_min")


@query("""WITH b AS (SELECT run_i, coalesce(sum(pep_len) FILTER (flu_count = 1), 0) / (SELECT sum(100 + pro_i % 9) FROM pros) AS best, sum(nn_dist) AS t FROM survey WHERE pro_i IN (SELECT pro_i FROM pros) GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY best DESC, t DESC, run_i) AS INT) AS run_rank, run_i, round(best, 9) AS best FROM b""")
def best_schemes_by_coverage(spark, sf_dir):
    """T-2: runs by the residues in peptides of a fluorosequence of their own."""
    lengths = view(spark, sf_dir, "pros").select("pro_i", (100 + F.col("pro_i") % 9).alias("length"))
    return S.best_schemes(view(spark, sf_dir, "survey"), 10, "coverage", lengths).withColumn("best", F.round("best", 9))


@query(f"""WITH {_TRACKS}, dp AS (SELECT dyt_i, pep_i, n_reads FROM c JOIN t USING (d0, d1, d2)), o AS (SELECT dyt_i, arg_min(pep_i, (-n_reads, pep_i)) AS owner FROM dp GROUP BY 1),
nn AS (SELECT a.dyt_i, b.dyt_i AS other, pow(a.d0 - b.d0, 2) + pow(a.d1 - b.d1, 2) + pow(a.d2 - b.d2, 2) AS d FROM t a, t b), k AS (SELECT *, row_number() OVER (PARTITION BY dyt_i ORDER BY d, other) AS r FROM nn),
n AS (SELECT k.dyt_i, owner, 1 - exp(-0.8 * d) AS p FROM k JOIN o ON o.dyt_i = other WHERE r <= 10 AND k.dyt_i <> other),
w AS (SELECT dp.dyt_i, dp.pep_i, any_value(n_reads) AS n_reads, any_value(o.owner) AS owner, coalesce(product(n.p), 1) AS q FROM dp JOIN o USING (dyt_i) LEFT JOIN n ON n.dyt_i = dp.dyt_i AND (n.owner = dp.pep_i) <> (o.owner = dp.pep_i) GROUP BY 1, 2),
i AS (SELECT pep_i, round(sum(n_reads * CASE WHEN owner = pep_i THEN q ELSE 1 - q END) / sum(n_reads), 9) AS isolation FROM w GROUP BY 1),
l AS (SELECT pep_i, owner, round(sum(n_reads * q), 9) AS lost FROM w WHERE owner <> pep_i GROUP BY 1, 2), m AS (SELECT pep_i, arg_min(owner, (-lost, owner)) AS contention_pep_i FROM l WHERE lost > 0 GROUP BY 1)
SELECT i.pep_i, isolation, coalesce(contention_pep_i, 0) AS contention_pep_i FROM i LEFT JOIN m ON m.pep_i = i.pep_i""")
def isolation(spark, sf_dir):
    """A-39: how surely each peptide's reads are told from others', and which peptide takes most of them."""
    tracks, dyepeps, _ = S.dyetrack_catalogue(view(spark, sf_dir, "reads").select("pep_i", F.array("d0", "d1", "d2").alias("dyetrack")))
    return S.isolation(tracks, dyepeps, 10).withColumn("isolation", F.round("isolation", 9))


@query()
def rf_classify(spark, sf_dir):
    """M-5, M-6: every row's class by a forest that learned from three quarters of them, at most two thousand a class."""
    from dyelake.operators.forest import rf_classify as classify
    from dyelake.operators.forest import rf_train

    tracks = F.col("dyetrack")
    rows = _signals(spark, sf_dir).select("row_i", (1 + tracks[0] + 3 * tracks[1] + 9 * tracks[2]).alias("true_pep_i"), "vec")
    model = rf_train(rows.filter(F.pmod(F.xxhash64("row_i"), F.lit(4)) != 2).select("true_pep_i", "vec"), 2000, min_leaf=10)
    return classify(rows, model).select("row_i", "true_pep_i", "pred_pep_i", "score")
