"""Best peptides and best experiment designs: a chain of filters whose losses are accounted for, scores by rank, and runs ranked across a job."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.numbers import ratio
from dyelake.functions.storage import written
from dyelake.operators.sequences import numbered_by_range


@dataclass(frozen=True)
class Wanted:
    """What a survey is asked for: single proteins' or sites' peptides (``objective`` protein_id or ptms), of which proteins and sites, within which limits.

    metric (dist_avg, dist_min or coverage) ranks several peptides of a protein together; without it each peptide stands alone.
    """

    objective: str = "protein_id"
    pro_ids: list[str] = field(default_factory=list)
    poi_only: bool = False
    ptms: list[int] = field(default_factory=list)
    max_pep_len: int | None = None
    max_dyes: int | None = None
    max_ptms: int | None = None
    allow_p2: bool = True
    unique_flus_only: bool = True
    n_peps: int = 1
    metric: str | None = None


@dataclass(frozen=True)
class Domain:
    """A survey's rows within the limits, and what was asked for: (run_i, key) of proteins or sites."""

    rows: DataFrame
    requested: DataFrame
    key: str


def of_interest(pros: DataFrame) -> DataFrame:
    """(pro_i): proteins in the report; all of them if none is marked."""
    marked = pros.agg(F.bool_or(F.col("pro_report") > 0).alias("any"))
    return pros.crossJoin(F.broadcast(marked)).filter((F.col("pro_report") > 0) | ~F.coalesce("any", F.lit(False))).select("pro_i")


def domain(survey: DataFrame, pros: DataFrame, wanted: Wanted, sites: DataFrame | None = None) -> Domain:
    """The rows of ``survey`` (run_i, pro_i, pep_i, pep_len, p2, flu_count, n_dyes_max_any_ch, nn_dist) that ``wanted`` leaves, all runs at once.

    With objective ptms, or limits on sites, ``sites`` (pep_i, n_pep_ptms, ptm), a row a site, are joined: a peptide has a row for each of its sites, and peptides without any
    are left out. Requested are the sites there were before any limit (or those named), or the proteins that are left once proteins are chosen.
    """
    rows = survey
    if wanted.objective == "ptms" or wanted.max_ptms is not None or wanted.ptms:
        if sites is None:
            raise ValueError("limits on sites need the peptides' sites")
        rows = rows.join(sites.select("pep_i", "n_pep_ptms", "ptm"), "pep_i")
    if wanted.objective == "ptms":
        named = rows.sparkSession.createDataFrame([(p,) for p in wanted.ptms], "ptm int")
        requested = survey.select("run_i").distinct().crossJoin(F.broadcast(named)) if wanted.ptms else rows.select("run_i", "ptm").distinct()
    if wanted.pro_ids:
        rows = rows.join(pros.filter(F.col("pro_id").isin(wanted.pro_ids)).select("pro_i"), "pro_i", "left_semi")
    if wanted.poi_only:
        rows = rows.join(of_interest(pros), "pro_i", "left_semi")
    if wanted.objective != "ptms":
        requested = rows.select("run_i", "pro_i").distinct()
    limits = [
        None if wanted.max_pep_len is None else F.col("pep_len") <= wanted.max_pep_len,
        None if wanted.max_dyes is None else F.col("n_dyes_max_any_ch") <= wanted.max_dyes,
        None if wanted.max_ptms is None else F.col("n_pep_ptms") <= wanted.max_ptms,
        F.col("ptm").isin(wanted.ptms) if wanted.ptms else None,
        None if wanted.allow_p2 else F.col("p2") == 0,
        F.col("flu_count") == 1 if wanted.unique_flus_only else None,
    ]
    for c in limits:
        rows = rows if c is None else rows.filter(c)
    return Domain(rows, requested, "ptm" if wanted.objective == "ptms" else "pro_i")


def lost(asked: Domain) -> DataFrame:
    """(run_i, key): what was asked for of each run and has no row left."""
    return asked.requested.join(asked.rows.select("run_i", asked.key).distinct(), ["run_i", asked.key], "left_anti")


def _filter_pass(asked: Domain) -> DataFrame:
    """(run_i, filter_pass, n_lost) of every run that asked for anything: the share of what was asked for that has a row left, and how many have none."""
    found = asked.rows.join(asked.requested, ["run_i", asked.key], "left_semi").groupBy("run_i").agg(F.count_distinct(asked.key).alias("found"))
    all_of = asked.requested.groupBy("run_i").agg(F.count(F.lit(1)).alias("asked"))
    n = F.coalesce("found", F.lit(0))
    return all_of.join(found, "run_i", "left").select("run_i", ratio(n, "asked").alias("filter_pass"), (F.col("asked") - n).alias("n_lost"))


def run_coverage(rows: DataFrame, pros: DataFrame, lengths: DataFrame) -> DataFrame:
    """(run_i, nn_coverage): residues in rows of a fluorosequence of their own, of proteins of interest, over all residues of these proteins (pro_i, length)."""
    own = of_interest(pros)
    residues = lengths.join(own, "pro_i", "left_semi").agg(F.sum("length").alias("residues"))
    here = rows.join(own.withColumn("own", F.lit(True)), "pro_i", "left")
    covered = here.groupBy("run_i").agg(F.sum(F.when((F.col("flu_count") == 1) & F.col("own"), F.col("pep_len")).otherwise(0)).alias("covered"))
    return covered.crossJoin(F.broadcast(residues)).select("run_i", (F.col("covered") / F.col("residues")).alias("nn_coverage"))


def best_peptides(survey: DataFrame, pros: DataFrame, lengths: DataFrame, wanted: Wanted, sites: DataFrame | None = None) -> DataFrame:
    """The best peptides of each run: survey rows with nn_coverage and nn_unique of the run, and with a metric nn_rank, nn_dist_avg, nn_dist_min, filter_pass and n_lost.

    Rows go by distance, then fewer residues, fewer dyes, the lower number. Without a metric they are the first ``n_peps`` of a run. With one they are the first ``n_peps`` of
    each protein (all, for sites, of rank 1), and the mean and least distance are over a run's rows of one rank. Where something asked for was lost, the mean is multiplied by the
    lost share (one less filter_pass) and the least distance is 0.
    """
    asked = domain(survey, pros, wanted, sites)
    rows = asked.rows
    unique = rows.groupBy("run_i").agg(F.count_if(F.col("flu_count") == 1).alias("nn_unique"))
    facts = unique.join(run_coverage(rows, pros, lengths), "run_i")
    order = [F.desc("nn_dist"), "pep_len", "n_dyes_max_any_ch", "pep_i"] + (["ptm"] if "ptm" in rows.columns else [])
    if wanted.metric is None and wanted.objective != "ptms":
        # The first of each of 64 parts of a run, then the first of the run.
        parts = rows.withColumn("part", F.pmod(F.xxhash64("pep_i"), F.lit(64)))
        for by in (["run_i", "part"], ["run_i"]):
            parts = parts.withColumn("place", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("place") <= wanted.n_peps)
        return parts.drop("part", "place").join(facts, "run_i")
    if wanted.objective == "ptms":
        top = rows.withColumn("nn_rank", F.lit(1))
    else:
        top = rows.withColumn("nn_rank", F.row_number().over(W.partitionBy("run_i", "pro_i").orderBy(*order))).filter(F.col("nn_rank") <= wanted.n_peps)
    stats = top.groupBy("run_i", "nn_rank").agg(F.avg("nn_dist").alias("avg"), F.min("nn_dist").alias("min"))
    left = _filter_pass(asked)
    out = top.join(stats, ["run_i", "nn_rank"]).join(facts, "run_i").join(left, "run_i")
    whole = F.col("filter_pass") == 1
    out = out.withColumns({"nn_dist_avg": F.when(whole, F.col("avg")).otherwise(F.col("avg") * (1 - F.col("filter_pass"))), "nn_dist_min": F.when(whole, F.col("min")).otherwise(0.0)})
    return out.drop("avg", "min")


def best_schemes(survey: DataFrame, pros: DataFrame, lengths: DataFrame, wanted: Wanted, n_runs: int, sites: DataFrame | None = None, include: list | None = None, exclude: list | None = None) -> DataFrame:
    """best_peptides() of the ``n_runs`` best runs, with run_rank.

    Without a metric runs go by their peptides' greatest distance, then the coverage. With one they go by the best row's nn_dist_avg, nn_dist_min and nn_coverage, the one that metric names first. Equal runs go by
    number. ``include`` and ``exclude`` choose runs once all are ranked within themselves.
    """
    rows = best_peptides(survey, pros, lengths, wanted, sites)
    rows = rows if not include else rows.filter(F.col("run_i").isin(include))
    rows = written(rows if not exclude else rows.filter(~F.col("run_i").isin(exclude)))
    keys = ["nn_dist", "nn_coverage"]
    if wanted.metric is not None:
        keys = ["nn_dist_avg", "nn_dist_min", "nn_coverage"]
        keys.insert(0, keys.pop(keys.index(f"nn_{wanted.metric}")))
    best = rows.groupBy("run_i").agg(F.max(F.struct(*keys)).alias("best"))
    # A row a run: designs that a job compares.
    ranked = best.withColumn("run_rank", F.row_number().over(W.orderBy(F.desc("best"), "run_i"))).filter(F.col("run_rank") <= n_runs)
    return rows.join(ranked.select("run_i", "run_rank"), "run_i")


def schemes_by_coverage(survey: DataFrame, pros: DataFrame, lengths: DataFrame, wanted: Wanted, n_runs: int, sites: DataFrame | None = None) -> DataFrame:
    """(run_rank, run_i, nn_uniques, nn_coverage, nn_dist): the ``n_runs`` runs of most coverage, then distance of a unique peptide, then number of these."""
    rows = domain(survey, pros, wanted, sites).rows
    one = F.col("flu_count") == 1
    stats = rows.groupBy("run_i").agg(F.count_if(one).alias("nn_uniques"), F.max(F.when(one, F.col("nn_dist"))).alias("nn_dist")).join(run_coverage(rows, pros, lengths), "run_i")
    rank = F.row_number().over(W.orderBy(F.desc("nn_coverage"), F.desc_nulls_last("nn_dist"), F.desc("nn_uniques"), "run_i"))
    return stats.withColumn("run_rank", rank).filter(F.col("run_rank") <= n_runs).select("run_rank", "run_i", "nn_uniques", "nn_coverage", "nn_dist")


def label_sets_of(text: str) -> list[list[str]]:
    """The label sets that a text such as "A,B,C:2+S,T" names: all choices of two of A, B and C, in order, each with S and T behind."""
    from itertools import combinations

    parts = text.split(":")
    chosen = parts[1].split("+") if len(parts) == 2 else []
    if len(parts) > 2 or len(chosen) > 2:
        raise ValueError(f"more than one colon or plus: {text}")
    split = lambda x: [y.strip() for y in x.split(",")]
    labels, behind = split(parts[0]), split(chosen[1]) if len(chosen) == 2 else []
    n = int(chosen[0]) if chosen else len(labels)
    if chosen and not 0 < n < len(labels):
        raise ValueError(f"{n} of {len(labels)} labels: {text}")
    return [[*c, *behind] for c in combinations(labels, n)]


def sweep(spark: SparkSession, axes: dict[str, DataFrame | list[Any]], start: int = 0, stop: int | None = None) -> DataFrame:
    """(scheme_i, a column for each axis): the combinations of one value of each axis, numbered from 0 with the last axis changing fastest; those from ``start`` to ``stop`` only.

    A number stands for a combination as digits in mixed radix, so any slice of a sweep is made by itself, in parallel, without crossing tables. An axis is a list, or a table of one column whose
    values, sorted, are numbered and joined by their digit.
    """
    sized: list[tuple[str, Any, int]] = []
    for name, axis in axes.items():
        held = written(numbered_by_range(axis.toDF(name).distinct(), [name], f"digit of {name}")) if isinstance(axis, DataFrame) else list(axis)
        sized.append((name, held, held.count() if isinstance(held, DataFrame) else len(held)))
    total = 1
    for *_, n in sized:
        total *= n
    out, stride = spark.range(start, total if stop is None else min(stop, total)).withColumnRenamed("id", "scheme_i"), total
    for name, axis, n in sized:
        stride //= max(1, n)
        digit = F.expr(f"scheme_i div {max(1, stride)} % {max(1, n)}")
        if isinstance(axis, DataFrame):
            out = out.withColumn(f"digit of {name}", digit).join(axis, f"digit of {name}").drop(f"digit of {name}")
        else:
            value = lambda v: F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)
            out = out.withColumn(name, F.get(F.array(*(value(v) for v in axis)), digit.cast("int")))
    return out.select("scheme_i", *axes)
