"""Radiometry tables: one row per peak, channel and cycle (field_i, signal, noise, aspect_ratio)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.numbers import ratio
from dyelake.operators.quantiles import named_percentiles


def _peak():
    """A peak's cycles in order."""
    return W.partitionBy("peak_i", "channel_i").orderBy("cycle_i")


def to_long(dense: DataFrame) -> DataFrame:
    """(peak_i, channel_i, cycle_i, signal, noise) of arrays ``signal`` and ``noise`` by channel and cycle of each peak."""
    by_channel = dense.select("peak_i", F.posexplode(F.arrays_zip("signal", "noise")).alias("channel_i", "x"))
    by_cycle = by_channel.select("peak_i", "channel_i", F.posexplode(F.arrays_zip(F.col("x.signal").alias("signal"), F.col("x.noise").alias("noise"))).alias("cycle_i", "y"))
    return by_cycle.select("peak_i", "channel_i", "cycle_i", "y.signal", "y.noise")


def filter_rows(df: DataFrame, fields: list | None = None, reject_fields: list | None = None, roi: tuple | None = None, max_k: float | None = None, min_score: float | None = None) -> DataFrame:
    """Rows of chosen fields, in a half-open region (y0, y1, x0, x1) of raw_y and raw_x, of k and score limits; None leaves a limit out."""
    conds = [
        None if fields is None else F.col("field_i").isin(fields),
        None if reject_fields is None else ~F.col("field_i").isin(reject_fields),
        None if roi is None else (F.col("raw_y") >= roi[0]) & (F.col("raw_y") < roi[1]) & (F.col("raw_x") >= roi[2]) & (F.col("raw_x") < roi[3]),
        None if max_k is None else F.col("k") <= max_k,
        None if min_score is None else F.col("score") >= min_score,
    ]
    for c in conds:
        df = df if c is None else df.filter(c)
    return df


def filter_peaks(
    radmat: DataFrame, dark: float | None = None, on_through: int | None = None, off_at: int | None = None, monotonic: float | None = None, cycle_0: tuple = (None, None), any_cycle_max: float | None = None, aspect_ratio: tuple = (None, None),
    per_cycle: dict[int, tuple] | None = None, channel: int | None = None,
) -> DataFrame:
    """The rows of whole peaks whose signals satisfy every given limit.

    on_through: above ``dark`` in cycles 0 to that one, inclusive; off_at: not above it from that cycle on; monotonic: no rise from a cycle to the
    next of more than that part of the peak's mean; cycle_0 and any_cycle_max bound signals, aspect_ratio every cycle's ratio, per_cycle (cycle: (least, most)) the signals of single cycles.
    With ``channel`` the limits are for that channel's rows, and all rows of the peaks that it keeps stay.
    """
    rise = F.col("signal") - F.lag("signal").over(_peak())
    rows = (radmat if channel is None else radmat.filter(F.col("channel_i") == channel)).withColumn("rise", rise)
    on = F.col("signal") > F.lit(dark if dark is not None else 0.0)
    tests: list[Column] = []
    if on_through is not None:
        tests += [F.bool_and(on | (F.col("cycle_i") > on_through))]
    if off_at is not None:
        tests += [F.bool_and(~on | (F.col("cycle_i") < off_at))]
    if monotonic is not None:
        tests += [F.coalesce(F.max("rise"), F.lit(0.0)) <= monotonic * F.avg("signal")]
    for cycle, (least, most) in [(0, cycle_0), *(per_cycle or {}).items()]:
        tests += [F.bool_and((F.col("signal") >= least) | (F.col("cycle_i") != cycle))] if least is not None else []
        tests += [F.bool_and((F.col("signal") <= most) | (F.col("cycle_i") != cycle))] if most is not None else []
    if any_cycle_max is not None:
        tests += [F.max("signal") <= any_cycle_max]
    for bound, cond in ((aspect_ratio[0], lambda b: F.col("aspect_ratio") >= b), (aspect_ratio[1], lambda b: F.col("aspect_ratio") <= b)):
        if bound is not None:
            tests += [F.bool_and(cond(bound))]
    ok = F.lit(True)
    for t in tests:
        ok = ok & t
    key = ["peak_i", "channel_i"] if channel is None else ["peak_i"]
    return radmat.join(rows.groupBy(*key).agg(ok.alias("ok")).filter("ok").select(*key), key, "left_semi")


def balance(radmat: DataFrame, factors: DataFrame) -> DataFrame:
    """Signals times their cycle's factor (cycle_i, factor); cycles are few."""
    return radmat.join(F.broadcast(factors), "cycle_i").withColumn("signal", F.col("signal") * F.col("factor")).drop("factor")


def cycle_balance(radmat: DataFrame, mean: float, std: float) -> DataFrame:
    """(cycle_i, factor): the mean of all cycles' medians over the cycle's, of signals within one std of the mean."""
    medians = named_percentiles(radmat.filter((F.col("signal") > mean - std) & (F.col("signal") < mean + std)), ["cycle_i"], "signal", {"median": 0.5})
    return medians.select("cycle_i", (F.avg("median").over(W.partitionBy()) / F.col("median")).alias("factor"))


def cycle_balance_of_ones(sigcalls: DataFrame, value: str = "signal") -> DataFrame:
    """(cycle_i, factor): the mean of all cycles' means over the cycle's, of the rows of sigcalls() whose called count is 1; cycles are few."""
    means = sigcalls.filter("count = 1").groupBy("cycle_i").agg(F.avg(value).alias("mean"))
    return means.select("cycle_i", (F.avg("mean").over(W.partitionBy()) / F.col("mean")).alias("factor"))


def one_sided_std(radmat: DataFrame, sigmas: float) -> DataFrame:
    """One row, dark: sigmas times the root mean square of the last cycle's signals of 0 or less (mirrored, their mean is 0)."""
    last = radmat.agg(F.max("cycle_i").alias("last"))
    low = radmat.join(F.broadcast(last), F.col("cycle_i") == F.col("last")).filter("signal <= 0")
    return low.agg((sigmas * F.sqrt(F.avg(F.col("signal") * F.col("signal")))).alias("dark"))


def mean_non_dark_asr(radmat: DataFrame, dark: float) -> DataFrame:
    """(peak_i, channel_i, asr): mean aspect ratio of the cycles with a signal of at least ``dark``, null if none."""
    return radmat.groupBy("peak_i", "channel_i").agg(F.avg(F.when(F.col("signal") >= dark, F.col("aspect_ratio"))).alias("asr"))


def n_peaks(peaks: DataFrame) -> DataFrame:
    """(field_i, n_peaks): the greatest field_peak_i plus one."""
    return peaks.groupBy("field_i").agg((F.max("field_peak_i") + 1).alias("n_peaks"))


def lifespan(radmat: DataFrame) -> DataFrame:
    """(peak_i, channel_i, lifespan): the length L of the step that fits the signals best in angle: the greatest sum of the first L over sqrt(L), the first if equal."""
    run = F.sum("signal").over(_peak()) / F.sqrt(F.col("cycle_i") + 1)
    scored = radmat.select("peak_i", "channel_i", (F.col("cycle_i") + 1).alias("length"), run.alias("fit"))
    return scored.groupBy("peak_i", "channel_i").agg(F.max(F.struct("fit", (-F.col("length")).alias("minus"))).alias("b")).select("peak_i", "channel_i", (-F.col("b.minus")).alias("lifespan"))


def monotonic_metric(radmat: DataFrame, spans: DataFrame) -> DataFrame:
    """(peak_i, channel_i, metric): the greatest rise within the lifespan over the mean there; null where there is no second cycle."""
    live = radmat.join(spans, ["peak_i", "channel_i"]).filter("cycle_i < lifespan").withColumn("rise", F.col("signal") - F.lag("signal").over(_peak()))
    return live.groupBy("peak_i", "channel_i").agg((F.max("rise") / F.avg("signal")).alias("metric"))


def signal_delta(radmat: DataFrame) -> DataFrame:
    """(field_i, cycle_i, signal, delta, percent): mean signal by field and cycle, its change and that as a part of the new value."""
    means = radmat.groupBy("field_i", "cycle_i").agg(F.avg("signal").alias("signal"))
    delta = F.col("signal") - F.lag("signal").over(W.partitionBy("field_i").orderBy("cycle_i"))
    return means.withColumn("delta", delta).withColumn("percent", 100 * F.col("delta") / F.col("signal"))


def field_thresholds(radmat: DataFrame, value: Column | str = "signal", start: int | None = None, n: int = 1) -> DataFrame:
    """(field_i, threshold): the median of each field's values over ``n`` cycles from ``start``, the table's last cycle if that isn't given."""
    if start is None:
        start = radmat.agg(F.coalesce(F.max("cycle_i"), F.lit(0))).first()[0]
    return named_percentiles(radmat.filter((F.col("cycle_i") >= start) & (F.col("cycle_i") < start + n)), ["field_i"], value, {"threshold": 0.5})


def peak_lifetime(radmat: DataFrame, threshold: float | DataFrame, value: Column | str = "signal") -> DataFrame:
    """(field_i, peak_i, channel_i, lifetime): the first cycle whose ``value`` (the signal, or ratio("signal", "noise")) isn't above the threshold, the number of cycles if there is none.

    The threshold is one number or a table (field_i, threshold); peaks of a field without one are left out. A null value isn't above.
    """
    of = F.col(value) if isinstance(value, str) else value
    rows = radmat.withColumn("threshold", F.lit(threshold)) if isinstance(threshold, (int, float)) else radmat.join(threshold, "field_i")
    off = F.min(F.when(~F.coalesce(of > F.col("threshold"), F.lit(False)), F.col("cycle_i")))
    return rows.groupBy("field_i", "peak_i", "channel_i").agg(F.coalesce(off, F.max("cycle_i") + 1).alias("lifetime"))


def survivors(lifetimes: DataFrame) -> DataFrame:
    """(field_i, cycle_i, n): peaks of each field whose lifetime is at least the cycle, for all cycles from 0 to the longest lifetime of all.

    Lifetimes are counted by value and summed from the last cycle down, so each peak counts once, not once a cycle.
    """
    counts = lifetimes.groupBy("field_i", F.col("lifetime").alias("cycle_i")).agg(F.count(F.lit(1)).alias("ends"))
    last = lifetimes.agg(F.max("lifetime").alias("last"))
    cycles = counts.select("field_i").distinct().crossJoin(F.broadcast(last)).select("field_i", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("cycle_i"))
    down = W.partitionBy("field_i").orderBy(F.desc("cycle_i"))
    return cycles.join(counts, ["field_i", "cycle_i"], "left").select("field_i", "cycle_i", F.sum(F.coalesce("ends", F.lit(0))).over(down).alias("n"))


def cumulative(rows: DataFrame, column: str) -> DataFrame:
    """(column, n): rows of at most each value; the values are few."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(column, F.sum("n").over(W.orderBy(column)).alias("n"))


def field_stats(radmat: DataFrame) -> DataFrame:
    """(field_i, snr, signal, median): mean signal to noise, mean and median signal."""
    means = radmat.groupBy("field_i").agg(F.avg(ratio("signal", "noise")).alias("snr"), F.avg("signal").alias("signal"))
    return means.join(named_percentiles(radmat, ["field_i"], "signal", {"median": 0.5}), "field_i", "left").select("field_i", "snr", "signal", "median")


def cycle_stats(radmat: DataFrame) -> DataFrame:
    """(channel_i, cycle_i, mean, median) of signals."""
    means = radmat.groupBy("channel_i", "cycle_i").agg(F.avg("signal").alias("mean"))
    return means.join(named_percentiles(radmat, ["channel_i", "cycle_i"], "signal", {"median": 0.5}), ["channel_i", "cycle_i"], "left").select("channel_i", "cycle_i", "mean", "median")


def require_cycles(radmat: DataFrame, n_cycles: int) -> DataFrame:
    """``radmat``, whose use raises an error if it has a cycle of ``n_cycles`` or later."""
    beyond = F.raise_error(F.concat(F.lit(f"more than {n_cycles} cycles: "), F.col("cycle_i").cast("string"))).cast("int")
    return radmat.withColumn("cycle_i", F.when(F.col("cycle_i") >= n_cycles, beyond).otherwise(F.col("cycle_i")))


def signal_by_field_cycle(radmat: DataFrame, n_cycles: int) -> DataFrame:
    """(field_i, channel_i, cycle_0, cycle_1, ...): mean signal of each of ``n_cycles`` cycles; more are an error."""
    rows = require_cycles(radmat, n_cycles)
    return rows.groupBy("field_i", "channel_i").agg(*(F.avg(F.when(F.col("cycle_i") == c, F.col("signal"))).alias(f"cycle_{c}") for c in range(n_cycles)))


def field_alignment(fields: DataFrame, qualities: DataFrame) -> DataFrame:
    """(field_i, max_shift, quality): each field's farthest alignment of a cycle, and its mean quality, null if there is none."""
    shift = fields.groupBy("field_i").agg(F.max(F.sqrt(F.col("aln_x") * F.col("aln_x") + F.col("aln_y") * F.col("aln_y"))).alias("max_shift"))
    return shift.join(qualities.groupBy("field_i").agg(F.avg("quality").alias("quality")), "field_i", "left")


def signal_stats(radmat: DataFrame, start: int, n: int, channel: int | None = None, fields: list | None = None) -> DataFrame:
    """One row of mean, median and sample deviation of signals and of signal to noise over ``n`` cycles, of one channel and some fields if given."""
    rows = filter_rows(radmat if channel is None else radmat.filter(F.col("channel_i") == channel), fields)
    rows = rows.filter((F.col("cycle_i") >= start) & (F.col("cycle_i") < start + n)).withColumn("snr", ratio("signal", "noise"))
    out = rows.agg(*(f(c).alias(f"{name}_{c}") for c in ("signal", "snr") for name, f in (("mean", F.avg), ("std", F.stddev_samp))))
    for c in ("signal", "snr"):
        # One row each; no values have no median.
        median = named_percentiles(rows, [], c, {f"median_{c}": 0.5}).agg(F.first(f"median_{c}").alias(f"median_{c}"))
        out = out.crossJoin(F.broadcast(median))
    return out.select(*(f"{name}_{c}" for c in ("signal", "snr") for name in ("mean", "median", "std")))


def good_fields(qualities: DataFrame) -> DataFrame:
    """(field_i, quality): fields whose mean quality is above the median of all fields' means."""
    means = qualities.groupBy("field_i").agg(F.avg("quality").alias("quality"))
    return means.join(F.broadcast(named_percentiles(means, [], "quality", {"median": 0.5})), F.col("quality") > F.col("median")).select("field_i", "quality")


def percentile_bands(df: DataFrame, groups: list[str], value: str, at: dict[str, float]) -> DataFrame:
    """(groups, and a column for each named percentile of the group's values)."""
    return named_percentiles(df, groups, value, at)


def _box(df: DataFrame, group: str, value: str) -> DataFrame:
    q = named_percentiles(df, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return q.withColumns({"far_low": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), "far_high": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})


def boxplot(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, q1, median, q3, low, high): quartiles, and whiskers of 1.5 interquartile ranges clipped to what occurs."""
    ends = df.groupBy(group).agg(F.min(value).alias("least"), F.max(value).alias("most"))
    return _box(df, group, value).join(ends, group).select(group, "q1", "median", "q3", F.greatest("least", "far_low").alias("low"), F.least("most", "far_high").alias("high"))


def boxplot_outliers(df: DataFrame, group: str, value: str) -> DataFrame:
    """The rows of ``df`` farther than 1.5 interquartile ranges from their group's quartiles."""
    ends = _box(df, group, value).select(group, "far_low", "far_high")
    return df.join(ends, group).filter((F.col(value) > F.col("far_high")) | (F.col(value) < F.col("far_low"))).select(*df.columns)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n) of equal bins of low to high, the last with its upper end; empty bins are there, values outside aren't."""
    spot = F.least(F.lit(bins - 1), F.floor((F.col(column) - low) / (high - low) * bins))
    counts = df.filter((F.col(column) >= low) & (F.col(column) <= high)).groupBy(spot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").na.fill(0, ["n"])


def zero_out_nan_peaks(radmat: DataFrame) -> DataFrame:
    """Peaks with a NaN or null signal anywhere have signal and noise 0 throughout."""
    bad = radmat.groupBy("peak_i").agg(F.bool_or(F.isnan("signal") | F.col("signal").isNull()).alias("bad"))
    return radmat.join(bad, "peak_i").withColumns({c: F.when(F.col("bad"), 0.0).otherwise(F.col(c)) for c in ("signal", "noise")}).drop("bad")


def fields_peaks_radmat(fields: DataFrame, peaks: DataFrame, radmat: DataFrame) -> DataFrame:
    """Radmat rows with their field's alignment, number of peaks, and raw coordinates (peak less field alignment)."""
    wide = fields.join(n_peaks(peaks), "field_i", "left").withColumnsRenamed({"aln_x": "field_x", "aln_y": "field_y"})
    rows = radmat.join(peaks.select("peak_i", "field_peak_i", "aln_x", "aln_y"), "peak_i").join(wide, ["field_i", "channel_i", "cycle_i"])
    return rows.withColumns({"raw_x": F.col("aln_x") - F.col("field_x"), "raw_y": F.col("aln_y") - F.col("field_y")})


def radial_filter(peaks: DataFrame, dim: float, radius: float) -> DataFrame:
    """Peaks nearer the centre than ``radius`` half-dimensions."""
    half = dim / 2
    return peaks.filter(F.sqrt(F.pow(F.col("aln_x") - half, 2) + F.pow(F.col("aln_y") - half, 2)) / half < radius)


def peaks_fits(peaks: DataFrame, fits: DataFrame) -> DataFrame:
    """Peaks with their Gaussian fit by field and number in the field; peaks without one stay."""
    return peaks.join(fits, ["field_i", "field_peak_i"], "left")


def sigcalls(radmat: DataFrame, calls: DataFrame, tracks: DataFrame) -> DataFrame:
    """Radmat rows with their peak's call (dyetrack 0 where there is none) and the called track's count (dyt_i, cycle_i, count) in that cycle."""
    called = radmat.join(calls.select("peak_i", "dyt_i"), "peak_i", "left").na.fill(0, ["dyt_i"])
    return called.join(tracks, ["dyt_i", "cycle_i"], "left").na.fill(0, ["count"])


def fields_metadata(fields: DataFrame, metadata: DataFrame, qualities: DataFrame) -> DataFrame:
    """Field rows with stage place and exposure of their field and cycle, and all qualities of channel and cycle."""
    return fields.join(metadata, ["field_i", "cycle_i"], "left").join(qualities, ["field_i", "channel_i", "cycle_i"], "full")


def peaks_on_stage(peaks: DataFrame, metadata: DataFrame) -> DataFrame:
    """Peaks with their field's mean stage place, and their own place on the flow cell (stage plus alignment); peaks of fields without metadata are left out."""
    stage = metadata.groupBy("field_i").agg(F.avg("stage_x").alias("stage_x"), F.avg("stage_y").alias("stage_y"))
    return peaks.join(stage, "field_i").withColumns({"flowcell_x": F.col("stage_x") + F.col("aln_x"), "flowcell_y": F.col("stage_y") + F.col("aln_y")})


def raw_by_shift(peaks: DataFrame, fields: DataFrame, border: float) -> DataFrame:
    """Peaks by channel and cycle with raw_x and raw_y in the image as taken: alignment plus the cycle's shift (field_i, channel_i, cycle_i, shift_x, shift_y), less the border."""
    rows = peaks.join(fields.select("field_i", "channel_i", "cycle_i", "shift_x", "shift_y"), "field_i")
    return rows.withColumns({f"raw_{c}": F.col(f"aln_{c}") + F.col(f"shift_{c}") - border for c in ("x", "y")}).drop("shift_x", "shift_y")


def regional_stats(pixels: DataFrame, tile: int) -> DataFrame:
    """(field_i, ty, tx, median, std): median and population deviation of ``value`` by square tiles of (y, x)."""
    keys = [F.floor(F.col(c) / tile).cast("int").alias(f"t{c}") for c in ("y", "x")]
    return pixels.groupBy("field_i", *keys).agg(F.percentile("value", F.lit(0.5)).alias("median"), F.stddev_pop("value").alias("std"))


def field_channel_summary(radmat: DataFrame) -> DataFrame:
    """(field_i, channel_i, frames, peaks, first, early): cycles, peaks, mean signal of cycle 1 and of cycles 1 to 5."""
    mean = lambda cond: F.avg(F.when(cond, F.col("signal")))
    return radmat.groupBy("field_i", "channel_i").agg(
        F.count_distinct("cycle_i").alias("frames"), F.count_distinct("peak_i").alias("peaks"), mean(F.col("cycle_i") == 1).alias("first"), mean(F.col("cycle_i").between(1, 5)).alias("early")
    )


def bestseq_counts(bestseq: DataFrame) -> DataFrame:
    """(peak_i, channel_i, seq, n): each peak's fitted counts as digits, and how many peaks share them; nulls are left out, "ch2" is channel 1."""
    rows = bestseq.filter("counts IS NOT NULL").select("peak_i", (F.substring("channel", 3, 9).cast("int") - 1).alias("channel_i"), F.array_join(F.transform("counts", lambda x: x.cast("string")), "").alias("seq"))
    return rows.join(rows.groupBy("seq").agg(F.count(F.lit(1)).alias("n")), "seq").select("peak_i", "channel_i", "seq", "n")


def evenly_spaced(rows: DataFrame, order: list, n: int = 3) -> DataFrame:
    """``n`` rows at even distances of an ordering of few rows, its ends among them."""
    placed = rows.withColumns({"place": F.row_number().over(W.orderBy(*order)) - 1, "all": F.count(F.lit(1)).over(W.partitionBy())})
    spots = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * (F.col("all") - 1) / (n - 1)))
    return placed.filter(F.array_contains(spots, F.col("place").cast("long"))).drop("place", "all")


def flag_bad_alignment(fields: DataFrame, dim: float) -> DataFrame:
    """Fields aligned by more than a fifth of the image's size ``dim``."""
    return fields.filter(F.col("aln_x") * F.col("aln_x") + F.col("aln_y") * F.col("aln_y") > (0.2 * dim) ** 2)


def bestseq_radmat(bestseq: DataFrame, radmat: DataFrame, seq: str | None = None) -> DataFrame:
    """Each peak and channel's best sequence (peak_i, channel_i, seq) with its radmat rows; of one sequence only, if given."""
    own = bestseq if seq is None else bestseq.filter(F.col("seq") == seq)
    return own.join(radmat, ["peak_i", "channel_i"], "left")


def row_balance(sigcalls: DataFrame, balance: DataFrame | None = None, max_aspect_ratio: float = 1.5, row_bal: bool = True) -> DataFrame:
    """sigcalls() rows with k and aspect_ratio, of peaks whose lit cycles (count > 0) all have an aspect ratio below the limit, with
    ``balanced``: the signal over k, times the cycle's factor (cycle_i, factor) if any are given."""
    worst = F.max(F.when(F.col("count") > 0, F.col("aspect_ratio")).otherwise(0.0))
    fine = sigcalls.groupBy("peak_i", "channel_i").agg(worst.alias("worst")).filter(F.col("worst") < max_aspect_ratio)
    rows = sigcalls.join(fine, ["peak_i", "channel_i"], "left_semi").withColumn("balanced", ratio("signal", "k") if row_bal else F.col("signal"))
    if balance is None:
        return rows
    return rows.join(F.broadcast(balance), "cycle_i").withColumn("balanced", F.col("balanced") * F.col("factor")).drop("factor")


def cycle_balance_lifespan(spans: DataFrame, radmat: DataFrame) -> DataFrame:
    """(cycle_i, factor): the mean signal of the peaks that are still lit (cycle below their lifespan), over the median of these means; cycles are few."""
    means = radmat.join(spans, ["peak_i", "channel_i"]).filter("cycle_i < lifespan").groupBy("cycle_i").agg(F.avg("signal").alias("mean"))
    return means.crossJoin(F.broadcast(means.agg(F.percentile("mean", F.lit(0.5)).alias("median")))).select("cycle_i", (F.col("mean") / F.col("median")).alias("factor"))


def tile_anomalies(pixels: DataFrame, low: float = 0.25, high: float = 0.75, tile: int = 4) -> DataFrame:
    """(field_i, channel_i, cycle_i, ty, tx, mean): tiles of ``pixels`` (y, x, value) whose mean is above the median of all cycles' tiles of the field and channel
    plus the range between two of their percentiles."""
    keys = [F.floor(F.col(c) / tile).cast("int").alias(f"t{c}") for c in ("y", "x")]
    tiles = pixels.groupBy("field_i", "channel_i", "cycle_i", *keys).agg(F.avg("value").alias("mean"))
    at = named_percentiles(tiles, ["field_i", "channel_i"], "mean", {"p50": 0.5, "low": low, "high": high})
    return tiles.join(at, ["field_i", "channel_i"]).filter(F.col("mean") > F.col("p50") + F.col("high") - F.col("low")).select("field_i", "channel_i", "cycle_i", "ty", "tx", "mean")


def lognormal_gain(radmat: DataFrame, dark: float) -> DataFrame:
    """One row, beta and sigma of a dye's brightness: exp of the mean, and the deviation, of the logarithms of balanced signals.

    Peaks are those above ``dark`` in cycle 1 and below it in the last cycle that they have; their darker cells are left out, then the peaks of the upper half by deviation, and
    each peak's signals are divided by its mean over all peaks' mean.
    """
    on = F.bool_or((F.col("cycle_i") == 1) & (F.col("signal") > dark)) & (F.max_by("signal", "cycle_i") < dark)
    lit = F.when(F.col("signal") >= dark, F.col("signal"))
    peaks = radmat.groupBy("peak_i", "channel_i").agg(on.alias("on"), F.avg(lit).alias("mean"), F.stddev_pop(lit).alias("std")).filter("on AND mean IS NOT NULL")
    peaks = peaks.join(F.broadcast(named_percentiles(peaks, [], "std", {"half": 0.5})), F.col("std") < F.col("half"))
    peaks = peaks.crossJoin(F.broadcast(peaks.agg(F.avg("mean").alias("all")))).select("peak_i", "channel_i", (F.col("mean") / F.col("all")).alias("scale"))
    logs = radmat.filter(F.col("signal") >= dark).join(peaks, ["peak_i", "channel_i"]).select(F.log(F.col("signal") / F.col("scale")).alias("x"))
    return logs.agg(F.exp(F.avg("x")).alias("beta"), F.stddev_pop("x").alias("sigma"))


def peak_features(radmat: DataFrame, peaks: DataFrame, dim: int, neighbours: tuple[str, ...] = ()) -> DataFrame:
    """One row a peak and channel: lif_len, radius, and measures of its signals over lifespan (lif_), afterlife (afl_) and all cycles (sig_).

    Measures are med, men (mean), std (of the population), iqr, max, min and rng, null over no cycles. Aspect ratios have asr_med, asr_std and asr_max of the lifespan and
    asr_cy0; each of the ``neighbours`` columns its mean over the lifespan, nei_<column>. radius is the distance of (aln_x, aln_y) from the middle of ``dim``. A group holds
    one peak's cycles, so exact percentiles are small.
    """
    live = F.col("cycle_i") < F.col("lifespan")
    quartiles = lambda x: F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    aggs = [F.max("lifespan").alias("lif_len")]
    for pre, x in (("lif", F.when(live, F.col("signal"))), ("afl", F.when(~live, F.col("signal"))), ("sig", F.col("signal"))):
        q = quartiles(x)
        aggs += [q[1].alias(f"{pre}_med"), F.avg(x).alias(f"{pre}_men"), F.stddev_pop(x).alias(f"{pre}_std"), (q[2] - q[0]).alias(f"{pre}_iqr"), F.max(x).alias(f"{pre}_max"), F.min(x).alias(f"{pre}_min"), (F.max(x) - F.min(x)).alias(f"{pre}_rng")]
    ratios = F.when(live, F.col("aspect_ratio"))
    aggs += [F.percentile(ratios, F.lit(0.5)).alias("asr_med"), F.stddev_pop(ratios).alias("asr_std"), F.max(ratios).alias("asr_max"), F.max(F.when(F.col("cycle_i") == 0, F.col("aspect_ratio"))).alias("asr_cy0")]
    aggs += [F.avg(F.when(live, F.col(c))).alias(f"nei_{c}") for c in neighbours]
    made = radmat.join(lifespan(radmat), ["peak_i", "channel_i"]).groupBy("peak_i", "channel_i").agg(*aggs)
    middle = dim // 2
    return made.join(peaks.select("peak_i", F.hypot(F.col("aln_x") - middle, F.col("aln_y") - middle).alias("radius")), "peak_i")
