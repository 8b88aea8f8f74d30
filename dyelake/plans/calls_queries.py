"""Queries over calls: filters, confusion, precision and recall, curves, false calls, FDR."""

from __future__ import annotations

from pyspark.sql import functions as F

from dyelake.operators import calls as C
from dyelake.operators import curves as R
from dyelake.plans.adapters import over, view
from dyelake.plans.registry import query

#: The decoys' peptides, and 50 score thresholds as DuckDB sees them.
DECOYS = "SELECT pep_i FROM peps JOIN pros ON peps.pro_i = pros.pro_i WHERE pro_is_decoy"
RUNS = [0, 1, 2, 3, 4]


def _steps(n: int) -> str:
    return "(VALUES " + ", ".join(f"({i}, CAST({t!r} AS DOUBLE))" for i, t in enumerate(R.thresholds(n))) + ") s(step, t)"


@query("""WITH th AS (SELECT true_pep_i, CASE WHEN score >= 0.5 THEN pred_pep_i ELSE 0 END AS pred_pep_i FROM calls),
p AS (SELECT pred_pep_i AS pep_i, count(*) AS n_pred, count(*) FILTER (pred_pep_i = true_pep_i) AS hits FROM th GROUP BY 1), t AS (SELECT true_pep_i AS pep_i, count(*) AS n_true FROM th GROUP BY 1)
SELECT peps.pep_i, CASE WHEN n_pred > 0 THEN hits / n_pred ELSE 0 END AS precision, CASE WHEN n_true > 0 THEN coalesce(hits, 0) / n_true ELSE 0 END AS recall, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true
FROM peps LEFT JOIN p USING (pep_i) LEFT JOIN t USING (pep_i)""")
def precision_recall_by_pep(spark, sf_dir):
    """P-3, A-1, A-2: precision and recall of every peptide above a score threshold."""
    return C.precision_recall(C.conf_mat(view(spark, sf_dir, "calls"), 0.5), view(spark, sf_dir, "peps"))


@query("SELECT run_i, count(*) AS n FROM calls WHERE true_pep_i = pred_pep_i GROUP BY run_i")
def correct_calls_by_run(spark, sf_dir):
    """P-1: right calls by run."""
    return C.correct_calls(view(spark, sf_dir, "calls")).groupBy("run_i").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT run_i, true_pep_i, pred_pep_i, score FROM calls WHERE true_pep_i <> pred_pep_i")
def incorrect_calls(spark, sf_dir):
    """P-1: wrong calls."""
    return C.incorrect_calls(view(spark, sf_dir, "calls"))


@query("SELECT * FROM calls_k WHERE dyt_i <> 0 AND pep_i <> 0 AND k >= 1.01 AND k <= 1.05 AND score >= 0.3")
def filtered_calls(spark, sf_dir):
    """P-2: calls in a range of k, of a least score."""
    return C.filter_calls(view(spark, sf_dir, "calls_k"), k_range=(1.01, 1.05), score_range=(0.3, None))


@query("SELECT CASE WHEN score >= 0.7 THEN pred_pep_i ELSE 0 END AS pred_pep_i, true_pep_i, count(*) AS n FROM calls GROUP BY 1, 2")
def conf_mat(spark, sf_dir):
    """A-1: the sparse confusion matrix above a threshold."""
    return C.conf_mat(view(spark, sf_dir, "calls"), 0.7)


@query("SELECT count(*) AS n FROM calls WHERE pred_pep_i > 0 AND true_pep_i > 0")
def n_calls(spark, sf_dir):
    """A-3: calls of real peptides."""
    return C.n_calls(C.conf_mat(view(spark, sf_dir, "calls")))


@query("""SELECT pred_pep_i, true_pep_i, CAST(trunc(count(*) * any_value(abundance)) AS BIGINT) AS n FROM calls JOIN prices ON prices.pep_i = true_pep_i GROUP BY 1, 2""")
def conf_mat_by_abundance(spark, sf_dir):
    """A-4: confusion counts scaled by the true peptide's abundance."""
    return C.scale_by_abundance(C.conf_mat(view(spark, sf_dir, "calls")), view(spark, sf_dir, "prices"))


@query("SELECT true_pep_i AS pep_i, count(*) AS n, round(avg(score), 9) AS score FROM calls GROUP BY 1")
def average_scores(spark, sf_dir):
    """A-10: number and mean score of calls by true peptide."""
    return C.average_scores(view(spark, sf_dir, "calls")).withColumn("score", F.round("score", 9))


_FALSE = """c AS (SELECT pred_pep_i, true_pep_i, count(*) AS n FROM calls GROUP BY 1, 2),
b AS (SELECT 'FP' AS false_type, pred_pep_i AS pep_i, true_pep_i AS false_pep_i, n FROM c UNION ALL SELECT 'FN', true_pep_i, pred_pep_i, n FROM c),
r AS (SELECT *, sum(n) OVER (PARTITION BY false_type, pep_i) AS total, row_number() OVER (PARTITION BY false_type, pep_i, pep_i = false_pep_i ORDER BY n DESC, false_pep_i) - 1 AS false_i FROM b),
f AS (SELECT pep_i, false_type, CAST(false_i AS INT) AS false_i, false_pep_i, n / total AS false_weight FROM r WHERE pep_i <> false_pep_i AND false_i < 3 AND false_pep_i <> 0 AND pep_i <> 0)"""


@query(f"WITH {_FALSE} SELECT * FROM f")
def false_calls(spark, sf_dir):
    """W-6: the three most frequent confusions of every peptide, of either side."""
    return C.false_calls(C.conf_mat(view(spark, sf_dir, "calls")), 3)


@query(f"""WITH d AS ({DECOYS}), m AS (SELECT score, count(*) AS n, count(d.pep_i) AS k FROM calls LEFT JOIN d ON d.pep_i = pred_pep_i GROUP BY score)
SELECT score, CAST(sum(n) OVER (ORDER BY score DESC) AS BIGINT) AS n_calls, CAST(sum(k) OVER (ORDER BY score DESC) AS BIGINT) AS n_decoys, sum(k) OVER (ORDER BY score DESC) / sum(n) OVER (ORDER BY score DESC) AS fdr FROM m""")
def fdr(spark, sf_dir):
    """W-3: false-discovery rate by score."""
    return C.fdr(view(spark, sf_dir, "calls"), over(spark, sf_dir, DECOYS))


@query("SELECT peps.pep_i, count(pred_pep_i) AS n_pred FROM peps LEFT JOIN (SELECT * FROM calls WHERE score >= 0.4) c ON c.pred_pep_i = peps.pep_i GROUP BY 1")
def pred_counts(spark, sf_dir):
    """A-16: calls of every peptide, zeros included."""
    return C.pred_counts(view(spark, sf_dir, "calls"), view(spark, sf_dir, "peps"), 0.4)


@query("SELECT peps.pep_i, count(pred_pep_i) AS n_pred FROM peps LEFT JOIN calls ON calls.pred_pep_i = peps.pep_i GROUP BY 1 ORDER BY n_pred DESC, pep_i LIMIT 25")
def top_classes(spark, sf_dir):
    """T-1: the 25 most called peptides."""
    return C.top_classes(C.pred_counts(view(spark, sf_dir, "calls"), view(spark, sf_dir, "peps")), 25)


@query("WITH a AS (SELECT run_i, count(*) AS n FROM calls GROUP BY 1) SELECT pred_pep_i, " + ", ".join(f"count(*) FILTER (run_i = {r}) / max((SELECT n FROM a WHERE run_i = {r})) AS run_{r}" for r in RUNS) + " FROM calls GROUP BY 1")
def run_abundance_matrix(spark, sf_dir):
    """A-17: each peptide's share of every run's calls."""
    return C.run_abundance_matrix(view(spark, sf_dir, "calls"), RUNS, share=True)


@query(f"""SELECT count(*) AS n_calls, count(*) FILTER (pred_pep_i = 0) AS n_nul, count(d.pep_i) AS n_decoy, count(*) FILTER (pred_pep_i = true_pep_i) AS n_correct, count(DISTINCT pred_pep_i) AS n_peps
FROM calls LEFT JOIN ({DECOYS}) d ON d.pep_i = pred_pep_i""")
def call_summary(spark, sf_dir):
    """A-18: counts over all calls."""
    return C.call_summary(view(spark, sf_dir, "calls"), over(spark, sf_dir, DECOYS))


@query(f"""WITH d AS ({DECOYS}), k AS (SELECT CASE WHEN d.pep_i IS NOT NULL THEN 'decoy' WHEN pred_pep_i = true_pep_i THEN 'right' ELSE 'wrong' END AS kind, CAST(least(18, floor(score * 19)) AS INT) AS bin
FROM calls LEFT JOIN d ON d.pep_i = pred_pep_i) SELECT kind, bin, count(*) / sum(count(*)) OVER (PARTITION BY kind) AS share FROM k GROUP BY kind, bin""")
def score_histogram(spark, sf_dir):
    """A-19: score histograms of right, wrong and decoy calls."""
    return C.score_histogram(view(spark, sf_dir, "calls"), over(spark, sf_dir, DECOYS))


_CURVE = """g AS (SELECT {by}step, t, count(*) FILTER (true_pep_i = pred_pep_i AND p) AS correct, count(*) FILTER (p) AS predicted FROM x, {steps} WHERE score >= t GROUP BY ALL),
a AS (SELECT {by}count(*) FILTER (tr) AS n FROM x GROUP BY ALL),
r AS (SELECT {by}k.step, k.t, CASE WHEN predicted > 0 THEN correct / predicted ELSE 0 END AS prec, CASE WHEN n > 0 THEN coalesce(correct, 0) / n ELSE 0 END AS raw FROM a CROSS JOIN {steps2} LEFT JOIN g USING ({by}step)),
c AS (SELECT *, (raw - coalesce(lag(raw) OVER (w ORDER BY step), 0)) * prec AS area, max(raw) OVER w AS best FROM r WINDOW w AS ({part})),
z AS (SELECT *, sum(area) OVER ({part} ORDER BY step) AS auc FROM c)"""


def _curve(by: str, n: int) -> str:
    return _CURVE.format(by=f"{by}, " if by else "", part=f"PARTITION BY {by}" if by else "", steps=_steps(n), steps2=_steps(n).replace(" s(", " k("))


@query(f"""WITH x AS (SELECT pep_i, score, true_pep_i, pred_pep_i, pep_i = pred_pep_i AS p, pep_i = true_pep_i AS tr FROM (SELECT unnest(list_distinct([true_pep_i, pred_pep_i])) AS pep_i, * FROM calls)),
{_curve("pep_i", 20)}
SELECT pep_i, t AS score, round(prec, 9) AS prec, round(raw * prior, 9) AS recall, round(auc, 9) AS auc FROM z JOIN priors USING (pep_i) WHERE pep_i > 0 AND (raw > 0 OR best = 0)""")
def pr_curve_by_pep(spark, sf_dir):
    """A-7, A-9, W-4: precision and recall curves of every peptide in one pass."""
    out = R.pr_curve_by_pep(view(spark, sf_dir, "calls"), view(spark, sf_dir, "priors"), 20)
    return out.withColumns({n: F.round(n, 9) for n in ("prec", "recall", "auc")})


_SUBSET = "SELECT pep_i FROM peps WHERE pro_i IN (SELECT pro_i FROM pros WHERE pro_report = 1)"


@query(f"""WITH s AS ({_SUBSET}), x AS (SELECT score, true_pep_i, pred_pep_i, pred_pep_i IN (SELECT pep_i FROM s) AS p, true_pep_i IN (SELECT pep_i FROM s) AS tr FROM calls),
{_curve("", 50)} SELECT t AS score, round(prec, 9) AS prec, round(raw * (SELECT avg(prior) FROM priors WHERE pep_i IN (SELECT pep_i FROM s)), 9) AS recall, round(auc, 9) AS auc FROM z WHERE raw > 0 OR best = 0""")
def pr_curve_of_reported(spark, sf_dir):
    """A-5, A-9: one curve of all peptides of reported proteins."""
    out = R.pr_curve(view(spark, sf_dir, "calls"), over(spark, sf_dir, _SUBSET), view(spark, sf_dir, "priors"))
    return out.withColumns({n: F.round(n, 9) for n in ("prec", "recall", "auc")})


@query(f"""WITH c2 AS (SELECT score, a.pro_i AS true_pep_i, b.pro_i AS pred_pep_i FROM calls JOIN peps a ON a.pep_i = true_pep_i JOIN peps b ON b.pep_i = pred_pep_i),
x AS (SELECT pro_i, score, true_pep_i, pred_pep_i, pro_i = pred_pep_i AS p, pro_i = true_pep_i AS tr FROM (SELECT unnest(list_distinct([true_pep_i, pred_pep_i])) AS pro_i, * FROM c2)),
{_curve("pro_i", 20)}, b AS (SELECT pro_i, greatest(0, max(prior)) AS prior FROM peps JOIN priors USING (pep_i) GROUP BY 1)
SELECT pro_i, t AS score, round(prec, 9) AS prec, round(raw * prior, 9) AS recall, round(auc, 9) AS auc FROM z JOIN b USING (pro_i) WHERE pro_i > 0 AND (raw > 0 OR best = 0)""")
def pr_curve_by_pro(spark, sf_dir):
    """A-6: curves of every protein."""
    out = R.pr_curve_by_pro(view(spark, sf_dir, "calls"), view(spark, sf_dir, "peps"), view(spark, sf_dir, "priors"), 20)
    return out.withColumns({n: F.round(n, 9) for n in ("prec", "recall", "auc")})


def _abundance(calls: str, n: int, by: str = "") -> str:
    """SQL of the curves through abundances: of the calls, and apart by the given column."""
    return f"""ka AS (SELECT {by}step, t, CASE WHEN score >= t THEN pred_pep_i ELSE 0 END AS pred, true_pep_i, CAST(trunc(count(*) * any_value(abundance)) AS BIGINT) AS m
FROM {calls} JOIN prices ON prices.pep_i = true_pep_i, {_steps(n)} GROUP BY ALL),
pa AS (SELECT {by}pred AS pep_i, step, sum(m) AS n, sum(m) FILTER (pred = true_pep_i) AS hits FROM ka GROUP BY ALL), qa AS (SELECT {by}true_pep_i AS pep_i, step, sum(m) AS n FROM ka GROUP BY ALL),
ea AS (SELECT * FROM (SELECT * FROM priors WHERE pep_i > 0) CROSS JOIN {_steps(n)}{f" CROSS JOIN (SELECT DISTINCT {by.rstrip(', ')} FROM ka) b" if by else ""}),
ra AS (SELECT {by}pep_i, step, t, prior, CASE WHEN pa.n > 0 THEN coalesce(hits, 0) / pa.n ELSE 0 END AS prec, CASE WHEN qa.n > 0 THEN coalesce(hits, 0) / qa.n ELSE 0 END AS raw FROM ea LEFT JOIN pa USING ({by}pep_i, step) LEFT JOIN qa USING ({by}pep_i, step)),
ca AS (SELECT *, (raw - coalesce(lag(raw) OVER w, 0)) * prec AS area, max(raw) OVER w AS seen FROM ra WINDOW w AS (PARTITION BY {by}pep_i ORDER BY step)),
za AS (SELECT *, coalesce(sum(area) OVER (PARTITION BY {by}pep_i ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS auc, max(raw) OVER (PARTITION BY {by}pep_i) AS best FROM ca)"""


@query(f"WITH {_abundance('calls', 10)} SELECT pep_i, t AS score, prec, round(raw * prior, 9) AS recall, round(auc, 9) AS auc FROM za WHERE seen > 0 OR best = 0")
def pr_by_pep_with_abundance(spark, sf_dir):
    """A-8: curves of every peptide through abundance-scaled confusion counts."""
    out = R.pr_by_pep_with_abundance(view(spark, sf_dir, "calls"), view(spark, sf_dir, "prices"), view(spark, sf_dir, "priors"), 10)
    return out.withColumns({n: F.round(n, 9) for n in ("recall", "auc")})


_PARTS = "calls_in AS (SELECT CASE WHEN run_i = 4 THEN 'train' ELSE 'test' END AS part, * FROM calls)"


@query(f"""WITH {_PARTS}, x AS (SELECT part, pep_i, score, true_pep_i, pred_pep_i, pep_i = pred_pep_i AS p, pep_i = true_pep_i AS tr FROM (SELECT unnest(list_distinct([true_pep_i, pred_pep_i])) AS pep_i, * FROM calls_in)),
{_curve("part, pep_i", 10)}, {_abundance("calls_in", 10, "part, ")},
n AS (SELECT count(*) AS n_calls, count(*) FILTER (pred_pep_i = 0) AS n_nul, count(*) FILTER (pred_pep_i = true_pep_i) AS n_correct FROM calls)
SELECT u.*, n.* FROM (SELECT part, 'plain' AS kind, pep_i, t AS score, round(prec, 9) AS prec, round(raw * prior, 9) AS recall, round(auc, 9) AS auc FROM z JOIN priors USING (pep_i) WHERE pep_i > 0 AND (raw > 0 OR best = 0)
UNION ALL SELECT part, 'abundance', pep_i, t, round(prec, 9), round(raw * prior, 9), round(auc, 9) FROM za WHERE seen > 0 OR best = 0) u, n""")
def evaluate_classifier(spark, sf_dir):
    """M-7: both kinds of curves of test and training calls, and totals, from one pass over the calls."""
    calls = view(spark, sf_dir, "calls").withColumn("part", F.when(F.col("run_i") == 4, "train").otherwise("test"))
    plain, scaled, totals = R.evaluate(calls, view(spark, sf_dir, "priors"), view(spark, sf_dir, "prices"), 10, "part")
    rows = plain.withColumn("kind", F.lit("plain")).unionByName(scaled.withColumn("kind", F.lit("abundance")))
    return rows.withColumns({n: F.round(n, 9) for n in ("prec", "recall", "auc")} | {n: F.lit(v).cast("long") for n, v in totals.items()})


@query("SELECT pep_i, any_value(n) AS n, list(m ORDER BY i) AS scores FROM (SELECT pep_i, i, round(avg(v), 6) AS m, count(*) AS n FROM (SELECT label AS pep_i, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1")
def average_score_vectors(spark, sf_dir):
    """A-10: mean score vectors by true class."""
    rows = over(spark, sf_dir, "SELECT label AS true_pep_i, embedding AS scores FROM embeddings")
    return C.average_score_vectors(rows).withColumn("scores", F.transform("scores", lambda x: F.round(x, 6)))


@query("""WITH m AS (SELECT score, count(*) AS n, count(*) FILTER (true_pep_i = pred_pep_i) AS k FROM calls GROUP BY score)
SELECT score, sum(k) OVER (ORDER BY score DESC) / sum(n) OVER (ORDER BY score DESC) AS prec, sum(k) OVER (ORDER BY score DESC) / sum(k) OVER () AS recall FROM m""")
def pr_one_vs_rest(spark, sf_dir):
    """A-11: the curve with a threshold at every distinct score."""
    return R.pr_one_vs_rest(view(spark, sf_dir, "calls").select("score", (F.col("true_pep_i") == F.col("pred_pep_i")).alias("is_class")))


_AT = "WITH o AS (SELECT pep_i, prec, recall, score, row_number() OVER (PARTITION BY pep_i ORDER BY score, recall DESC, prec) AS r FROM prs WHERE prec >= 0.6)"


@query(f"{_AT} SELECT pep_i, coalesce(prec, 0) AS prec, coalesce(recall, 0) AS recall, coalesce(score, 0) AS score FROM (SELECT DISTINCT pep_i FROM prs) LEFT JOIN (SELECT * FROM o WHERE r = 1) USING (pep_i)")
def score_at_precision(spark, sf_dir):
    """W-5: the lowest score that keeps a precision, by peptide."""
    return R.score_at_precision(view(spark, sf_dir, "prs"), 0.6)


@query("SELECT pep_i, coalesce(max(prec) FILTER (recall >= 0.5), max(prec) FILTER (recall > 0), max(prec)) AS prec FROM prs GROUP BY 1")
def prec_at_min_recall(spark, sf_dir):
    """W-8: the best precision at a least recall, by peptide."""
    return R.prec_at_min_recall(view(spark, sf_dir, "prs"), 0.5)


@query("SELECT pep_i FROM prs GROUP BY 1 HAVING bool_or(prec > 0.9 AND recall > 0.5)")
def peptides_above(spark, sf_dir):
    """T-4: peptides with a point above a precision and a recall."""
    return R.peptides_above(view(spark, sf_dir, "prs"), 0.9, 0.5)


@query("""WITH b AS (SELECT pep_i, max(prec) FILTER (recall > 0) AS best FROM prs GROUP BY 1)
SELECT i / 50 AS level, count(*) FILTER (floor(best * 50 + 1e-9) >= i) / count(*) AS share FROM b, range(0, 51) t(i) GROUP BY i""")
def observability(spark, sf_dir):
    """A-20: share of peptides seen at each precision."""
    return R.observability(view(spark, sf_dir, "prs"))
