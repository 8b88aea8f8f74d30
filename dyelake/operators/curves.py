"""Precision and recall curves over score thresholds, for many classes in one pass.

A threshold's counts are sums over all calls of at least that score. Calls are counted once, by class and score
step, and running sums over the few steps give every threshold, so the work doesn't grow with classes times calls.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.numbers import ratio
from dyelake.functions.storage import written


def thresholds(n_steps: int) -> list[float]:
    """From 1 - 1/n down to 0, computed once so that all tasks compare with the same numbers."""
    return np.linspace(1 - 1 / n_steps, 0, n_steps).tolist()


def step_of(score: Column, n_steps: int) -> Column:
    """The first threshold, from the highest, that the score reaches; n_steps if none. A null score reaches none, NaN all.

    The step is worked out and then moved by one where the score, compared with the thresholds themselves, asks for it.
    """
    known = F.array(*map(F.lit, thresholds(n_steps)))
    guess = F.least(F.lit(n_steps - 1), F.greatest(F.lit(0), F.ceil((n_steps - 1) - F.least(F.greatest(score, F.lit(-1.0)), F.lit(2.0)) * n_steps).cast("int")))
    at = lambda i: F.get(known, i) <= score
    near = F.when((guess > 0) & at(guess - 1), guess - 1).when(at(guess), guess).otherwise(guess + 1)
    return F.when(score.isNull(), n_steps).when(F.isnan(score), 0).otherwise(near)


def _curve(counts: DataFrame, by: list[str], n_steps: int, prior: DataFrame | None, prior_by: list[str] | None = None) -> DataFrame:
    """From (by, step, correct, predicted, true): the curve, with counts running down the steps."""
    total = counts.groupBy(*by).agg(F.sum("true").alias("all_true"))
    grid = total.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n_steps - 1))))
    down = W.partitionBy(*by).orderBy("step")
    rows = grid.join(counts.filter(F.col("step") < n_steps), [*by, "step"], "left").withColumns({n: F.sum(F.coalesce(n, F.lit(0))).over(down) for n in ("correct", "predicted")})
    rows = rows.withColumns({"prec": ratio("correct", "predicted"), "raw": ratio("correct", "all_true")})
    rows = rows.withColumn("area", (F.col("raw") - F.coalesce(F.lag("raw").over(down), F.lit(0.0))) * F.col("prec"))
    rows = rows.withColumns({"auc": F.sum("area").over(down), "best": F.max("raw").over(W.partitionBy(*by))})
    # Leading steps without recall go, unless there is none at all.
    rows = rows.filter("raw > 0 OR best = 0")
    scale = F.lit(1.0)
    if prior is not None:
        rows = rows.join(prior, prior_by or by) if by else rows.crossJoin(F.broadcast(prior.limit(1)))
        scale = F.col("prior")
    score = F.get(F.array(*map(F.lit, thresholds(n_steps))), F.col("step"))
    return rows.select(*by, score.alias("score"), "prec", (F.col("raw") * scale).alias("recall"), "auc")


def step_cells(calls: DataFrame, n_steps: int = 50, by: tuple = (), true: str = "true_pep_i", pred: str = "pred_pep_i") -> DataFrame:
    """(by, p, t, step, n): calls counted by called and true class and score step, of which all curves are made."""
    return calls.groupBy(*by, F.col(pred).alias("p"), F.col(true).alias("t"), step_of(F.col("score"), n_steps).alias("step")).agg(F.count(F.lit(1)).alias("n"))


def _curve_of_cells(cells: DataFrame, wanted: DataFrame, n_steps: int, key: str, by: tuple = ()) -> DataFrame:
    own, none = F.col("n"), F.lit(0).cast("long")
    sides = F.when(F.col("t") == F.col("p"), F.array(F.struct(F.col("p").alias(key), own.alias("correct"), own.alias("predicted"), own.alias("true")))).otherwise(
        F.array(F.struct(F.col("p").alias(key), none.alias("correct"), own.alias("predicted"), none.alias("true")), F.struct(F.col("t").alias(key), none.alias("correct"), none.alias("predicted"), own.alias("true")))
    )
    counts = cells.select(*by, "step", F.explode(sides).alias("x")).select(*by, "step", "x.*").groupBy(*by, key, "step").agg(*(F.sum(n).alias(n) for n in ("correct", "predicted", "true")))
    return _curve(counts.join(wanted.select(key), key, "left_semi"), [*by, key], n_steps, wanted, [key])


def pr_curve_by_pep(calls: DataFrame, prior: DataFrame, n_steps: int = 50, true: str = "true_pep_i", pred: str = "pred_pep_i", key: str = "pep_i") -> DataFrame:
    """(pep_i, score, prec, recall, auc) for every peptide of ``prior`` (pep_i, prior), by thresholds from high to low.

    precision is right calls among calls of it, recall right calls among those it truly is times its prior recall; auc sums
    recall steps times precision, before the prior. Leading thresholds of no recall are left out, unless all are.
    """
    return _curve_of_cells(step_cells(calls, n_steps, (), true, pred), prior.filter(F.col(key) > 0).select(key, "prior"), n_steps, key)


def pr_curve(calls: DataFrame, subset: DataFrame, prior: DataFrame, n_steps: int = 50) -> DataFrame:
    """(score, prec, recall, auc) of all peptides of ``subset`` (pep_i) together; the prior is their mean.

    A right call is one of the true peptide, in the subset; calls with neither peptide in it don't count.
    """
    own = subset.select("pep_i").distinct()
    marked = (
        calls.join(own.select(F.col("pep_i").alias("true_pep_i"), F.lit(1).alias("t")), "true_pep_i", "left")
        .join(own.select(F.col("pep_i").alias("pred_pep_i"), F.lit(1).alias("p")), "pred_pep_i", "left")
        .filter("t = 1 OR p = 1")
    )
    same = (F.col("true_pep_i") == F.col("pred_pep_i")).cast("int")
    counts = marked.groupBy(step_of(F.col("score"), n_steps).alias("step")).agg(F.sum(same).alias("correct"), F.sum(F.coalesce("p", F.lit(0))).alias("predicted"), F.sum(F.coalesce("t", F.lit(0))).alias("true"))
    mean = prior.join(own, "pep_i", "left_semi").agg(F.avg("prior").alias("prior"))
    return _curve(counts, [], n_steps, mean)


def pr_curve_by_pro(calls: DataFrame, peps: DataFrame, prior: DataFrame, n_steps: int = 50) -> DataFrame:
    """pr_curve_by_pep of proteins (pro_i): calls go to the peptides' proteins, and a protein's prior is its best peptide's, 0 at least."""
    to = peps.select("pep_i", "pro_i")
    moved = calls.join(to.select(F.col("pep_i").alias("true_pep_i"), F.col("pro_i").alias("t_pro")), "true_pep_i").join(to.select(F.col("pep_i").alias("pred_pep_i"), F.col("pro_i").alias("p_pro")), "pred_pep_i")
    best = prior.join(to, "pep_i").groupBy("pro_i").agg(F.greatest(F.lit(0.0), F.max("prior")).alias("prior"))
    return pr_curve_by_pep(moved, best, n_steps, "t_pro", "p_pro", "pro_i")


def pr_by_pep_with_abundance(calls: DataFrame, abundance: DataFrame, prior: DataFrame, n_steps: int = 50) -> DataFrame:
    """(pep_i, score, prec, recall, auc) with every threshold's confusion counts scaled by the true peptide's abundance and truncated.

    Truncation is by cell and threshold, so cells (called, true) are carried down the steps before they are scaled; only cells
    that occur are. Calls under the threshold call peptide 0, which keeps recall's denominator whole. auc sums recall steps times precision over the thresholds above a
    row's own, before the prior. Leading thresholds of no recall are left out, unless all are.
    """
    return _abundance_of_cells(step_cells(calls, n_steps), abundance, prior, n_steps)


def _abundance_of_cells(cells: DataFrame, abundance: DataFrame, prior: DataFrame, n_steps: int, by: tuple = ()) -> DataFrame:
    # Calls of peptide 0 count as below every threshold.
    cells = cells.withColumn("step", F.when(F.col("p") == 0, n_steps).otherwise(F.col("step"))).groupBy(*by, "p", "t", "step").agg(F.sum("n").alias("n"))
    a = abundance.select(F.col("pep_i").alias("t"), "abundance")
    # A cell's running count changes only where it has calls: it is carried from there to the next such step.
    down = W.partitionBy(*by, "p", "t").orderBy("step")
    run = cells.filter(F.col("step") < n_steps).withColumns({"run": F.sum("n").over(down), "until": F.coalesce(F.lead("step").over(down) - 1, F.lit(n_steps - 1))})
    run = run.withColumn("step", F.explode(F.sequence("step", "until"))).join(a, "t").withColumn("m", (F.col("run") * F.col("abundance")).cast("long"))
    pred = run.groupBy(*by, F.col("p").alias("pep_i"), "step").agg(F.sum("m").alias("predicted"), F.sum(F.when(F.col("p") == F.col("t"), F.col("m")).otherwise(0)).alias("correct"))
    # What a true peptide's calls below the threshold amount to goes to peptide 0, also truncated.
    lost = cells.groupBy(*by, "t").agg(F.sum("n").alias("all"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_steps - 1)))
    above = run.groupBy(*by, "t", "step").agg(F.sum("m").alias("kept"), F.sum("run").alias("kept_n"))
    grid = lost.withColumn("step", every).join(above, [*by, "t", "step"], "left").na.fill(0, ["kept", "kept_n"]).join(a, "t")
    true = grid.select(*by, F.col("t").alias("pep_i"), "step", (F.col("kept") + ((F.col("all") - F.col("kept_n")) * F.col("abundance")).cast("long")).alias("true"))
    wanted = prior.filter("pep_i > 0")
    if by:
        # Parts are few: they name sets of calls that are judged apart.
        wanted = wanted.crossJoin(F.broadcast(cells.select(*by).distinct()))
    rows = wanted.withColumn("step", every).join(pred, [*by, "pep_i", "step"], "left").join(true, [*by, "pep_i", "step"], "left").na.fill(0, ["predicted", "correct", "true"])
    rows = rows.withColumns({"prec": ratio("correct", "predicted"), "raw": ratio("correct", "true")})
    down = W.partitionBy(*by, "pep_i").orderBy("step")
    rows = rows.withColumn("area", (F.col("raw") - F.coalesce(F.lag("raw").over(down), F.lit(0.0))) * F.col("prec"))
    rows = rows.withColumns({"auc": F.coalesce(F.sum("area").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)), "seen": F.max("raw").over(down), "best": F.max("raw").over(W.partitionBy(*by, "pep_i"))})
    score = F.get(F.array(*map(F.lit, thresholds(n_steps))), F.col("step"))
    return rows.filter("seen > 0 OR best = 0").select(*by, "pep_i", score.alias("score"), "prec", (F.col("raw") * F.col("prior")).alias("recall"), "auc")


def evaluate(calls: DataFrame, prior: DataFrame, abundance: DataFrame, n_steps: int = 50, part: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """One job over ``calls``: curves of every peptide, the same through abundances, and totals (n_calls, n_nul, n_correct).

    Calls are read once. They are counted by called and true peptide and score step; the counts are written, and both sets of curves are made of them. The
    totals are observed as the calls pass. With ``part``, a column that names sets of calls (test and train, say), each set is judged apart.
    """
    by = (part,) if part else ()
    totals = Observation()
    seen = calls.observe(totals, F.count(F.lit(1)).alias("n_calls"), F.count_if(F.col("pred_pep_i") == 0).alias("n_nul"), F.count_if(F.col("pred_pep_i") == F.col("true_pep_i")).alias("n_correct"))
    cells = written(step_cells(seen, n_steps, by))
    plain = _curve_of_cells(cells, prior.filter("pep_i > 0").select("pep_i", "prior"), n_steps, "pep_i", by)
    return plain, _abundance_of_cells(cells, abundance, prior, n_steps, by), totals.get


def pr_one_vs_rest(scores: DataFrame) -> DataFrame:
    """(score, prec, recall) at every distinct score of (score, is_class boolean)."""
    from dyelake.operators.calls import running

    out = running(scores, "score", {"n": F.count(F.lit(1)), "hits": F.sum(F.col("is_class").cast("long"))}, F.floor(F.col("score") * 1024))
    total = scores.agg(F.sum(F.col("is_class").cast("long")).alias("all"))
    return out.crossJoin(F.broadcast(total)).select("score", ratio("hits", "n").alias("prec"), ratio("hits", "all").alias("recall"))


def score_at_precision(prs: DataFrame, at: float, by: tuple = ("pep_i",)) -> DataFrame:
    """(by, prec, recall, score): the lowest-score point with at least that precision, of equal scores the one of most recall; zeros if none."""
    fine = F.col("prec") >= at
    best = F.min(F.when(fine, F.struct("score", (-F.col("recall")).alias("minus"), F.col("prec"))))
    rows = prs.groupBy(*by).agg(best.alias("b"))
    return rows.select(*by, F.coalesce("b.prec", F.lit(0.0)).alias("prec"), F.coalesce(-F.col("b.minus"), F.lit(0.0)).alias("recall"), F.coalesce("b.score", F.lit(0.0)).alias("score"))


def prec_at_min_recall(prs: DataFrame, least: float, by: tuple = ("pep_i",)) -> DataFrame:
    """(by, prec): the best precision at that recall or more, else at any recall above 0, else of any point."""
    at = lambda cond: F.max(F.when(cond, F.col("prec")))
    return prs.groupBy(*by).agg(F.coalesce(at(F.col("recall") >= least), at(F.col("recall") > 0), F.max("prec")).alias("prec"))


def peptides_above(prs: DataFrame, prec: float, recall: float) -> DataFrame:
    """(pep_i) with some point strictly above both."""
    return prs.groupBy("pep_i").agg(F.bool_or((F.col("prec") > prec) & (F.col("recall") > recall)).alias("above")).filter("above").select("pep_i")


def observability(prs: DataFrame, levels: int = 51) -> DataFrame:
    """(level, share): peptides with some point of recall above 0 and at least that precision, at evenly spaced levels."""
    best = prs.groupBy("pep_i").agg(F.max(F.when(F.col("recall") > 0, F.col("prec"))).alias("best"))
    # Peptides are counted by the highest level that they reach; at most ``levels`` rows are then summed.
    reach = best.groupBy(F.when(F.col("best").isNotNull(), F.floor(F.col("best") * (levels - 1) + 1e-9).cast("int")).otherwise(-1).alias("reach")).agg(F.count(F.lit(1)).alias("n"))
    steps = prs.sparkSession.range(levels).select(F.col("id").cast("int").alias("level_i"))
    rows = steps.join(F.broadcast(reach), F.lit(True), "left").groupBy("level_i").agg(F.sum(F.when(F.col("reach") >= F.col("level_i"), F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("all"))
    return rows.select((F.col("level_i") / (levels - 1)).alias("level"), ratio("n", "all").alias("share"))
