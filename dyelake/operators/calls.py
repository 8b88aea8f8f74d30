"""Calls and their evaluation: filters, sparse confusion counts, precision and recall, false calls, FDR.

A confusion matrix is a table (pred_pep_i, true_pep_i, n) of the cells that aren't zero. Peptide 0 is the
null class: calls under a score threshold are moved there, so they still count as misses.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.numbers import ratio


def correct_calls(calls: DataFrame) -> DataFrame:
    """Calls of the true peptide."""
    return calls.filter("true_pep_i = pred_pep_i")


def incorrect_calls(calls: DataFrame) -> DataFrame:
    """Calls of another peptide than the true one."""
    return calls.filter("true_pep_i != pred_pep_i")


def filter_calls(calls: DataFrame, include_nul: bool = False, k_range: tuple = (None, None), score_range: tuple = (None, None)) -> DataFrame:
    """Calls within inclusive ranges of k and score, open where None; null calls only if asked for."""
    out = calls if include_nul else calls.filter("dyt_i != 0 AND pep_i != 0")
    for name, (low, high) in (("k", k_range), ("score", score_range)):
        out = out if low is None else out.filter(F.col(name) >= low)
        out = out if high is None else out.filter(F.col(name) <= high)
    return out


def threshold_calls(calls: DataFrame, least: float) -> DataFrame:
    """All calls; those with a score under ``least`` call peptide 0."""
    return calls.withColumn("pred_pep_i", F.when(F.col("score") >= least, F.col("pred_pep_i")).otherwise(0))


def conf_mat(calls: DataFrame, least: float | None = None, by: tuple = ()) -> DataFrame:
    """(by, pred_pep_i, true_pep_i, n): how often each peptide was called as each."""
    seen = calls if least is None else threshold_calls(calls, least)
    return seen.groupBy(*by, "pred_pep_i", "true_pep_i").agg(F.count(F.lit(1)).alias("n"))


def precision_recall(cells: DataFrame, peps: DataFrame) -> DataFrame:
    """(pep_i, precision, recall, n_pred, n_true) of every peptide of ``peps``; 0 where nothing was called or true."""
    both = cells.withColumn("hit", F.when(F.col("pred_pep_i") == F.col("true_pep_i"), F.col("n")).otherwise(0))
    pred = both.groupBy(F.col("pred_pep_i").alias("pep_i")).agg(F.sum("n").alias("n_pred"), F.sum("hit").alias("hits"))
    true = both.groupBy(F.col("true_pep_i").alias("pep_i")).agg(F.sum("n").alias("n_true"))
    out = peps.select("pep_i").join(pred, "pep_i", "left").join(true, "pep_i", "left").na.fill(0, ["n_pred", "n_true", "hits"])
    return out.select("pep_i", ratio("hits", "n_pred").alias("precision"), ratio("hits", "n_true").alias("recall"), "n_pred", "n_true")


def n_calls(cells: DataFrame) -> DataFrame:
    """One row, n: calls whose true and called peptides are both real."""
    return cells.filter("pred_pep_i > 0 AND true_pep_i > 0").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def scale_by_abundance(cells: DataFrame, abundance: DataFrame) -> DataFrame:
    """Cells times the true peptide's abundance (pep_i, abundance), truncated; an abundance is 0 or at least 1."""
    bad = F.raise_error(F.lit("an abundance is 0 or at least 1"))
    checked = abundance.select(F.col("pep_i").alias("true_pep_i"), F.when((F.col("abundance") == 0) | (F.col("abundance") >= 1), F.col("abundance")).otherwise(bad.cast("double")).alias("a"))
    return cells.join(checked, "true_pep_i").select("pred_pep_i", "true_pep_i", (F.col("n") * F.col("a")).cast("long").alias("n"))


def average_scores(calls: DataFrame, which: str = "true") -> DataFrame:
    """(pep_i, n, score): number and mean score of the calls whose true or called peptide it is."""
    return calls.groupBy(F.col(f"{which}_pep_i").alias("pep_i")).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("score"))


def average_score_vectors(calls: DataFrame, which: str = "true", scores: str = "scores") -> DataFrame:
    """(pep_i, n, scores): number of calls whose true or called peptide it is, and the mean of their vectors of scores (an array a call, one of each class) element by element.

    The vectors of a peptide are of one length. Means are made of partial sums, so a peptide may have any number of calls.
    """
    of = Summarizer.metrics("count", "mean").summary(array_to_vector(F.col(scores).cast("array<double>")))
    rows = calls.filter(F.col(scores).isNotNull()).groupBy(F.col(f"{which}_pep_i").alias("pep_i")).agg(of.alias("x"))
    return rows.select("pep_i", F.col("x.count").alias("n"), vector_to_array("x.mean").alias("scores"))


def false_calls(cells: DataFrame, n_false: int) -> DataFrame:
    """(pep_i, false_type, false_i, false_pep_i, false_weight): each peptide's most frequent confusions.

    FP are the other true peptides among calls of it, FN the other calls of what it truly is; weights are shares of all its
    calls of that side. The n_false places go by number, then lowest peptide; the null class takes a place but isn't shown.
    """
    sides = []
    for kind, own, other in (("FP", "pred_pep_i", "true_pep_i"), ("FN", "true_pep_i", "pred_pep_i")):
        side = cells.select(F.col(own).alias("pep_i"), F.col(other).alias("false_pep_i"), "n", F.lit(kind).alias("false_type"))
        total = F.sum("n").over(W.partitionBy("pep_i"))
        rank = F.row_number().over(W.partitionBy("pep_i", F.col("pep_i") == F.col("false_pep_i")).orderBy(F.desc("n"), "false_pep_i")) - 1
        sides.append(side.withColumns({"total": total, "false_i": rank}))
    both = sides[0].unionByName(sides[1]).filter(f"pep_i != false_pep_i AND false_i < {n_false} AND false_pep_i != 0 AND pep_i != 0 AND n > 0")
    return both.select("pep_i", "false_type", "false_i", "false_pep_i", (F.col("n") / F.col("total")).alias("false_weight"))


def running(df: DataFrame, key: str, sums: dict[str, Column], bins: Column) -> DataFrame:
    """Sums over all rows with at least this ``key``, one row per distinct key.

    Rows are summed by key first. ``bins`` (not decreasing in key) cuts the keys into pieces whose totals are few, so no
    window spans the whole table.
    """
    by_key = df.groupBy(F.col(key)).agg(*(c.alias(n) for n, c in sums.items())).withColumn("bin", bins)
    totals = by_key.groupBy("bin").agg(*(F.sum(n).alias(f"all_{n}") for n in sums))
    above = W.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("bin", *(F.coalesce(F.sum(f"all_{n}").over(above), F.lit(0)).alias(f"above_{n}") for n in sums))
    inside = W.partitionBy("bin").orderBy(F.desc(key))
    return by_key.join(totals, "bin").select(key, *((F.col(f"above_{n}") + F.sum(n).over(inside)).alias(n) for n in sums))


def fdr(calls: DataFrame, decoy_peps: DataFrame) -> DataFrame:
    """(score, n_calls, n_decoys, fdr) at each score: the share of decoys among calls of at least that score.

    ``decoy_peps`` (pep_i) are peptides of decoy proteins. Calls of equal score come in together, so their order doesn't matter.
    """
    marked = calls.join(decoy_peps.select(F.col("pep_i").alias("pred_pep_i"), F.lit(1).alias("decoy")).distinct(), "pred_pep_i", "left")
    out = running(marked, "score", {"n_calls": F.count(F.lit(1)), "n_decoys": F.sum(F.coalesce("decoy", F.lit(0)))}, F.floor(F.col("score") * 1024))
    return out.withColumn("fdr", F.col("n_decoys") / F.col("n_calls"))


def pred_counts(calls: DataFrame, peps: DataFrame, least: float = 0.0) -> DataFrame:
    """(pep_i, n_pred): calls of each peptide of at least that score, 0 where there are none."""
    counts = calls.filter(F.col("score") >= least).groupBy(F.col("pred_pep_i").alias("pep_i")).agg(F.count(F.lit(1)).alias("n_pred"))
    return peps.select("pep_i").join(counts, "pep_i", "left").na.fill(0, ["n_pred"])


def top_classes(counts: DataFrame, n: int) -> DataFrame:
    """The ``n`` most called peptides, the lowest first among equals."""
    return counts.orderBy(F.desc("n_pred"), "pep_i").limit(n)


def run_abundance_matrix(calls: DataFrame, run_is: list[int], share: bool = False) -> DataFrame:
    """(pred_pep_i, run_<i> ...): calls by peptide and run, or shares of the run's calls."""
    cells = calls.groupBy("pred_pep_i", "run_i").agg(F.count(F.lit(1)).alias("n"))
    if share:
        cells = cells.join(calls.groupBy("run_i").agg(F.count(F.lit(1)).alias("all")), "run_i").withColumn("n", F.col("n") / F.col("all"))
    wide = cells.groupBy("pred_pep_i").agg(*(F.coalesce(F.sum(F.when(F.col("run_i") == r, F.col("n"))), F.lit(0)).alias(f"run_{r}") for r in run_is))
    return wide


def call_summary(calls: DataFrame, decoy_peps: DataFrame) -> DataFrame:
    """One row: calls, null calls, decoy calls, right calls, distinct called peptides."""
    marked = calls.join(decoy_peps.select(F.col("pep_i").alias("pred_pep_i"), F.lit(True).alias("decoy")).distinct(), "pred_pep_i", "left")
    return marked.agg(
        F.count(F.lit(1)).alias("n_calls"),
        F.count_if(F.col("pred_pep_i") == 0).alias("n_nul"),
        F.count_if(F.coalesce("decoy", F.lit(False))).alias("n_decoy"),
        F.count_if(F.col("true_pep_i") == F.col("pred_pep_i")).alias("n_correct"),
        F.count_distinct("pred_pep_i").alias("n_peps"),
    )


def score_histogram(calls: DataFrame, decoy_peps: DataFrame, bins: int = 19) -> DataFrame:
    """(kind, bin, share): scores in ``bins`` equal bins of 0 to 1, of right, wrong and decoy calls, each adding up to 1."""
    marked = calls.join(decoy_peps.select(F.col("pep_i").alias("pred_pep_i"), F.lit(True).alias("decoy")).distinct(), "pred_pep_i", "left")
    kind = F.when(F.coalesce("decoy", F.lit(False)), "decoy").when(F.col("true_pep_i") == F.col("pred_pep_i"), "right").otherwise("wrong")
    counts = marked.groupBy(kind.alias("kind"), F.least(F.lit(bins - 1), F.floor(F.col("score") * bins)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("kind", "bin", (F.col("n") / F.sum("n").over(W.partitionBy("kind"))).alias("share"))


def subsample_per_class(train: DataFrame, n: int, seed: int = 1, draw: Column | None = None) -> DataFrame:
    """At most ``n`` rows of each true peptide, by a seeded hash of the row's columns, or those of least ``draw``."""
    order = W.partitionBy("true_pep_i").orderBy(F.xxhash64(*train.columns, F.lit(seed)) if draw is None else draw, *train.columns)
    return train.withColumn("rank in class", F.row_number().over(order)).filter(F.col("rank in class") <= n).drop("rank in class")


def count_class_summary(calls: DataFrame, dyetracks: DataFrame) -> DataFrame:
    """(count_class, share): calls by the largest count of their dyetrack (dyt_i, dyetrack)."""
    held = calls.join(dyetracks.select("dyt_i", F.array_max("dyetrack").alias("count_class")), "dyt_i")
    counts = held.groupBy("count_class").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("count_class", (F.col("n") / F.sum("n").over(W.partitionBy())).alias("share"))


def subsample(df: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """``n`` rows drawn without replacement, by a seeded hash of the row; all if there are fewer."""
    order = F.xxhash64(*df.columns, F.lit(seed))
    return df.orderBy(order, *df.columns).limit(n)


def sample_calls(calls: DataFrame, share: float, seed: int = 1) -> DataFrame:
    """Calls drawn with replacement: each comes a Poisson number of times, ``share`` on average, by a seeded hash of the row."""
    u = (F.pmod(F.xxhash64(*calls.columns, F.lit(seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    # The number is how many of the distribution's first steps lie below u.
    below, chance = 0.0, math.exp(-share)
    times = F.lit(0)
    for k in range(1, 20 + int(4 * share)):
        below += chance
        times = times + F.when(u > below, 1).otherwise(0)
        chance *= share / k
    return calls.withColumn("times", times).withColumn("copy", F.explode(F.expr("CASE WHEN times > 0 THEN sequence(1, times) ELSE array() END"))).drop("times", "copy")
