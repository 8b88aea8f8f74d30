"""Joins of points in the plane, by grids: rectangles, neighbours within a radius, and the nearest other point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written

#: Points of a cell at most, where the search for the nearest other point begins, and the least cell, as a part of all points' extent.
CELL_POINTS, LEAST_PART = 16, 1e-9


def _cells(df: DataFrame, size: float) -> DataFrame:
    return df.withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)})


def _around(df: DataFrame) -> DataFrame:
    """Each row once for its grid cell and each of the eight around it."""
    near = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    return df.withColumn("step", near).withColumns({"cx": F.col("cx") + F.col("step.i"), "cy": F.col("cy") + F.col("step.j")}).drop("step")


def outside_rects(peaks: DataFrame, rects: DataFrame) -> DataFrame:
    """Peaks (field_i, aln_x, aln_y and others) in no rectangle (field_i, l, r, b, t; half-open) of their field.

    A rectangle goes to the level of a grid whose cells, of sides of a power of two, are just as large as it, where it covers four at most; a place
    probes its one cell of each level that occurs. Places are looked up once, whatever number of peaks they have. Rectangles with a null or without extent hold nothing; peaks with a null place are in none.
    """
    sized = rects.select("field_i", *(F.col(c).cast("double").alias(c) for c in ("l", "r", "b", "t"))).filter("r > l AND t > b").distinct()
    level = F.ceil(F.log2(F.greatest(F.col("r") - F.col("l"), F.col("t") - F.col("b")))).cast("int")
    sized = sized.withColumn("level", level)
    # Sides of doubles have some two thousand powers of two at most.
    levels = [r["level"] for r in sized.select("level").distinct().collect()]
    if not levels:
        return peaks
    side = F.pow(F.lit(2.0), F.col("level"))
    steps = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / side), F.floor(F.col(high) / side)))
    held = sized.withColumn("cx", steps("l", "r")).withColumn("cy", steps("b", "t"))
    places = peaks.select("field_i", F.col("aln_x").alias("x"), F.col("aln_y").alias("y")).distinct()
    probes = places.withColumn("level", F.explode(F.array(*map(F.lit, levels)))).withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)})
    a, b = probes.alias("a"), held.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("field_i", "level", "cx", "cy")]
    inside = [F.col("a.x") >= F.col("b.l"), F.col("a.x") < F.col("b.r"), F.col("a.y") >= F.col("b.b"), F.col("a.y") < F.col("b.t")]
    hit = a.join(b, [*same, *inside], "left_semi").select(F.col("field_i").alias("hit_field"), F.col("x").alias("hit_x"), F.col("y").alias("hit_y")).distinct()
    return peaks.join(hit, (F.col("field_i") == F.col("hit_field")) & (F.col("aln_x") == F.col("hit_x")) & (F.col("aln_y") == F.col("hit_y")), "left_anti")


def new_locs(locs: DataFrame, radius: float = 1.5) -> DataFrame:
    """Locations (field_i, cycle_i, x, y) of later cycles with none of cycle 0 within ``radius``, by a grid of that size."""
    first = _around(_cells(locs.filter("cycle_i = 0").select("field_i", "x", "y").distinct(), radius)).withColumnsRenamed({"field_i": "f", "x": "x0", "y": "y0", "cx": "gx", "cy": "gy"})
    close = (F.col("field_i") == F.col("f")) & (F.col("cx") == F.col("gx")) & (F.col("cy") == F.col("gy")) & (F.pow(F.col("x") - F.col("x0"), 2) + F.pow(F.col("y") - F.col("y0"), 2) <= radius * radius)
    return _cells(locs.filter("cycle_i > 0"), radius).join(first, close, "left_anti").select("field_i", "cycle_i", "x", "y")


def _first_size(places: DataFrame) -> tuple[float, float]:
    """(side, extent): cells of which none holds more than CELL_POINTS of ``places``, and the greatest extent of a field."""
    found = places.groupBy("field_i").agg(F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("extent"), F.count(F.lit(1)).alias("n"))
    extent, most = found.agg(F.max("extent"), F.max("n")).first()
    if not extent:
        return 1.0, 0.0
    side = extent / max(1, most) ** 0.5
    while side > LEAST_PART * extent and _cells(places, side).groupBy("field_i", "cx", "cy").count().agg(F.max("count")).first()[0] > CELL_POINTS:
        side /= 4
    return side, extent


def nearest_other(places: DataFrame) -> DataFrame:
    """(field_i, x, y, closest): for each distinct place of ``places`` (field_i, x, y) the distance to the nearest other one of its field, null without one.

    A place looks at its cell and the eight around it. If the nearest found is no farther than a cell's side, nothing nearer can lie
    beyond; else it goes on with cells twice as large. The search begins with cells of few places. Places that go on are farther than half a cell from all others, so a cell
    has few of them however many places it holds, and pairs grow with the places.
    """
    points = written(places.select("field_i", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL").distinct())
    side, extent = _first_size(points)
    left, done = points, None
    while True:
        probes = _around(_cells(left, side)).alias("a")
        held = _cells(points, side).alias("b")
        d2 = F.pow(F.col("a.x") - F.col("b.x"), 2) + F.pow(F.col("a.y") - F.col("b.y"), 2)
        met = probes.join(held, [*(F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("field_i", "cx", "cy")), d2 > 0])
        best = met.groupBy("a.field_i", "a.x", "a.y").agg(F.sqrt(F.min(d2)).alias("closest"))
        found = written(left.select("field_i", "x", "y").join(best, ["field_i", "x", "y"], "left"))
        settled = (F.col("closest") <= side) if side <= extent else F.lit(True)
        own = found.filter(settled)
        done = own if done is None else done.unionByName(own)
        left = found.filter(~F.coalesce(settled, F.lit(False))).select("field_i", "x", "y")
        if side > extent or left.isEmpty():
            return done
        side *= 2


def crowding(peaks: DataFrame, keep: float = 8.0) -> DataFrame:
    """(peak_i, closest, crowded): the distance of each peak (peak_i, field_i, aln_x, aln_y) to the nearest one at another place of its field, and whether
    that is less than ``keep``. A peak without another, or without a place, has a null distance and isn't crowded."""
    own = peaks.select("peak_i", "field_i", F.col("aln_x").cast("double").alias("x"), F.col("aln_y").cast("double").alias("y"))
    near = nearest_other(own)
    return own.join(near, ["field_i", "x", "y"], "left").select("peak_i", "closest", F.coalesce(F.col("closest") < keep, F.lit(False)).alias("crowded"))
