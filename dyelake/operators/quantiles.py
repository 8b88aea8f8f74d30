"""Exact percentiles of many groups, of any size, at once.

Equal values are counted first. What is looked for is then the value at some ranks of each group. Values that may be it are dealt into bins
between splitters, which a sketch of the distinct values gives; the bins are weighed, and of each rank only the bin that holds it is opened again. The sketch bounds
the distinct values of a bin, so a bin has few of them after some rounds, and these are summed up in order. Only bins cross the
network after the first count, and no task holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.storage import written

#: Distinct values of a bin that are summed up in order; with more it is opened.
FEW = 4096
#: Bins that an opened one is dealt into, and the rank accuracy of their splitters.
BINS, ACCURACY = 64, 2000


def _open(values: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` (g, rank, low, high, distinct), each in a bin of its bin of ``values`` (g, v, n), with its rank there."""
    bins = targets.select("g", "low", "high").distinct()
    rows = values.join(bins, "g").filter((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
    grid = F.array(*(F.lit(i / BINS) for i in range(1, BINS)))
    splitters = rows.groupBy("g", "low", "high").agg(F.percentile_approx("v", grid, ACCURACY).alias("s"))
    dealt = rows.join(splitters, ["g", "low", "high"]).withColumn("bin", F.size(F.filter("s", lambda x: x < F.col("v"))))
    sums = dealt.groupBy("g", "low", "high", "bin").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("d"), F.min("v").alias("from"), F.max("v").alias("to"))
    # At most BINS rows of a bin.
    sums = sums.withColumn("before", F.sum("w").over(W.partitionBy("g", "low", "high").orderBy("bin")) - F.col("w"))
    found = targets.join(sums, ["g", "low", "high"]).filter((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("w")))
    return found.select("g", "rank", (F.col("at") - F.col("before")).alias("at"), F.col("from").alias("low"), F.col("to").alias("high"), F.col("d").alias("distinct"))


def at_ranks(values: DataFrame, targets: DataFrame) -> DataFrame:
    """(g, rank, v): the value of each rank, from 0, of a group; ``values`` (g, v, n) are distinct values and how often they occur."""
    ends = values.groupBy("g").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("distinct"))
    here = written(targets.join(ends, "g").select("g", "rank", F.col("rank").alias("at"), "low", "high", "distinct"))
    done: list[DataFrame] = []
    many = (F.col("distinct") > FEW) & (F.col("low") < F.col("high"))
    while True:
        done.append(here.filter(~many))
        here = here.filter(many)
        if here.isEmpty():
            break
        here = written(_open(values, here))
    found = None
    for part in done:
        bins = part.select("g", "low", "high").distinct()
        rows = values.join(bins, "g").filter((F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))
        rows = rows.withColumn("before", F.sum("n").over(W.partitionBy("g", "low", "high").orderBy("v")) - F.col("n"))
        own = part.join(rows, ["g", "low", "high"]).filter((F.col("at") >= F.col("before")) & (F.col("at") < F.col("before") + F.col("n"))).select("g", "rank", "v")
        found = own if found is None else found.unionByName(own)
    return found


def percentiles(df: DataFrame, groups: list[str], value: Column | str, at: list[float]) -> DataFrame:
    """(groups, q): the percentiles ``at`` (0 to 1) of each group's values as an array, between two values in proportion, as percentile() gives them.

    Null values are left out; a group of none has no row. NaN counts as the greatest value. Null is a group like others, and without ``groups`` all
    rows are one. Any number of groups, values and equal values may be there.
    """
    g = F.struct(*groups) if groups else F.struct(F.lit(0).alias("all"))
    of = F.col(value) if isinstance(value, str) else value
    values = written(df.select(g.alias("g"), of.cast("double").alias("v")).filter("v IS NOT NULL").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")))
    spots = values.groupBy("g").agg((F.sum("n") - 1).alias("last")).select("g", F.posexplode(F.array(*(F.col("last") * F.lit(float(p)) for p in at))).alias("i", "spot"))
    spots = written(spots.select("g", "i", "spot", F.floor("spot").alias("under"), F.ceil("spot").alias("over")))
    found = at_ranks(values, spots.select("g", F.explode(F.array("under", "over")).alias("rank")).distinct())
    low = found.select("g", F.col("rank").alias("under"), F.col("v").alias("a"))
    high = found.select("g", F.col("rank").alias("over"), F.col("v").alias("b"))
    between = F.when((F.col("under") == F.col("over")) | (F.col("a") == F.col("b")), F.col("a")).otherwise((F.col("over") - F.col("spot")) * F.col("a") + (F.col("spot") - F.col("under")) * F.col("b"))
    each = spots.join(low, ["g", "under"]).join(high, ["g", "over"]).groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", between.alias("q")))).alias("x"))
    return each.select(*(F.col(f"g.`{c}`").alias(c) for c in groups), F.col("x.q").alias("q"))


def named_percentiles(df: DataFrame, groups: list[str], value: Column | str, at: dict[str, float]) -> DataFrame:
    """(groups, and a column for each named percentile); see percentiles()."""
    found = percentiles(df, groups, value, list(at.values()))
    return found.select(*groups, *(F.col("q")[i].alias(c) for i, c in enumerate(at)))
