"""Queries over radiometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from dyelake.functions.numbers import ratio
from dyelake.operators import plane as P
from dyelake.operators import radmat as R
from dyelake.plans.adapters import fields_of, view
from dyelake.plans.registry import query


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("SELECT peak_i, cycle_i, signal FROM radmat WHERE peak_i IN (SELECT peak_i FROM (SELECT *, signal - lag(signal) OVER (PARTITION BY peak_i ORDER BY cycle_i) AS rise FROM radmat) GROUP BY peak_i HAVING bool_and(signal > 2000 OR cycle_i > 1) AND max(signal) <= 90000 AND coalesce(max(rise), 0) <= 1.5 * avg(signal))")
def filter_peaks(spark, sf_dir):
    """P-7: whole peaks, on through cycle 1, of bounded signals and rises."""
    return R.filter_peaks(view(spark, sf_dir, "radmat"), dark=2000, on_through=1, monotonic=1.5, any_cycle_max=90000).select("peak_i", "cycle_i", "signal")


@query("WITH m AS (SELECT cycle_i, quantile_cont(signal, 0.5) AS d FROM radmat WHERE signal > 20000 AND signal < 80000 GROUP BY 1), f AS (SELECT cycle_i, (SELECT avg(d) FROM m) / d AS factor FROM m) SELECT cycle_i, round(avg(signal * factor), 6) AS signal FROM radmat JOIN f USING (cycle_i) GROUP BY 1")
def balanced_signal(spark, sf_dir):
    """A-24, P-10: signals balanced by cycle."""
    rows = view(spark, sf_dir, "radmat")
    return _round(R.balance(rows, R.cycle_balance(rows, 50000, 30000)).groupBy("cycle_i").agg(F.avg("signal").alias("signal")), "signal")


@query("SELECT round(3 * sqrt(avg((signal - 50000) * (signal - 50000))), 6) AS dark FROM radmat WHERE cycle_i = (SELECT max(cycle_i) FROM radmat) AND signal - 50000 <= 0")
def dark_estimate(spark, sf_dir):
    """A-22: the dark level, of the last cycle's low side."""
    return _round(R.one_sided_std(view(spark, sf_dir, "radmat").withColumn("signal", F.col("signal") - 50000), 3), "dark")


@query("SELECT peak_i, channel_i, round(avg(aspect_ratio) FILTER (signal >= 30000), 6) AS asr FROM radmat GROUP BY ALL")
def mean_non_dark_asr(spark, sf_dir):
    """A-23: mean aspect ratio of lit cycles."""
    return _round(R.mean_non_dark_asr(view(spark, sf_dir, "radmat"), 30000), "asr")


@query("SELECT field_i, max(field_peak_i) + 1 AS n_peaks FROM peaks GROUP BY 1")
def n_peaks(spark, sf_dir):
    """A-21: peaks by field."""
    return R.n_peaks(view(spark, sf_dir, "peaks"))


_SPAN = "g AS (SELECT peak_i, channel_i, cycle_i + 1 AS l, sum(signal) OVER (PARTITION BY peak_i ORDER BY cycle_i) / sqrt(cycle_i + 1) AS fit FROM radmat), s AS (SELECT peak_i, channel_i, l AS lifespan FROM (SELECT *, row_number() OVER (PARTITION BY peak_i ORDER BY fit DESC, l) AS r FROM g) WHERE r = 1)"


@query(f"WITH {_SPAN} SELECT * FROM s")
def lifespan(spark, sf_dir):
    """W-9: each peak's number of lit cycles."""
    return R.lifespan(view(spark, sf_dir, "radmat"))


@query(f"WITH {_SPAN} SELECT peak_i, channel_i, round(max(rise) / avg(signal), 6) AS metric FROM (SELECT r.peak_i, r.channel_i, signal, signal - lag(signal) OVER (PARTITION BY r.peak_i ORDER BY cycle_i) AS rise FROM radmat r JOIN s ON r.peak_i = s.peak_i WHERE cycle_i < lifespan) GROUP BY ALL")
def monotonic_metric(spark, sf_dir):
    """W-10: the greatest rise within the lifespan."""
    rows = view(spark, sf_dir, "radmat")
    return _round(R.monotonic_metric(rows, R.lifespan(rows)), "metric")


@query("WITH m AS (SELECT field_i, cycle_i, avg(signal) AS s FROM radmat GROUP BY 1, 2), d AS (SELECT *, s - lag(s) OVER (PARTITION BY field_i ORDER BY cycle_i) AS d FROM m) SELECT field_i, cycle_i, round(s, 6) AS signal, round(d, 6) AS delta, round(100 * d / s, 6) AS percent FROM d")
def signal_delta(spark, sf_dir):
    """W-11: change of mean signal by field and cycle."""
    return _round(R.signal_delta(view(spark, sf_dir, "radmat")), "signal", "delta", "percent")


@query("SELECT peak_i, channel_i, coalesce(min(cycle_i) FILTER (signal <= 30000), max(cycle_i) + 1) AS lifetime FROM radmat GROUP BY ALL")
def peak_lifetime(spark, sf_dir):
    """W-12: the cycle at which each peak goes dark."""
    return R.peak_lifetime(view(spark, sf_dir, "radmat"), 30000).select("peak_i", "channel_i", "lifetime")


def _lifetimes(value, which):
    """SQL: peaks' lifetimes by the median of ``value`` of their field in a cycle, and what is left of them cycle by cycle."""
    return f"""t AS (SELECT field_i, quantile_cont({value}, 0.5) AS threshold FROM radmat WHERE cycle_i = {which} GROUP BY 1),
l AS (SELECT field_i, peak_i, channel_i, coalesce(min(cycle_i) FILTER (NOT {value} > threshold), max(cycle_i) + 1) AS lifetime FROM radmat JOIN t USING (field_i) GROUP BY ALL)"""


_LEFT = "SELECT field_i, CAST(c AS INT) AS cycle_i, count(*) FILTER (lifetime >= c) AS n FROM l, (SELECT unnest(range((SELECT max(lifetime) + 1 FROM l))) AS c) GROUP BY 1, 2"


@query(f"WITH {_lifetimes('signal', '(SELECT max(cycle_i) FROM radmat)')} SELECT * FROM l")
def peak_lifetime_by_field(spark, sf_dir):
    """W-12: the cycle at which each peak falls to its field's median of the last cycle."""
    rows = view(spark, sf_dir, "radmat")
    return R.peak_lifetime(rows, R.field_thresholds(rows))


@query(f"WITH {_lifetimes('signal', '(SELECT max(cycle_i) FROM radmat)')} {_LEFT}")
def survivors(spark, sf_dir):
    """W-12: peaks of each field that are still on in each cycle, by signal."""
    rows = view(spark, sf_dir, "radmat")
    return R.survivors(R.peak_lifetime(rows, R.field_thresholds(rows)))


@query(f"WITH {_lifetimes('(signal / noise)', '0')} {_LEFT}")
def survivors_by_snr(spark, sf_dir):
    """W-12: the same by signal over noise, above the field's median of the first cycle."""
    rows = view(spark, sf_dir, "radmat")
    return R.survivors(R.peak_lifetime(rows, R.field_thresholds(rows, ratio("signal", "noise"), 0), ratio("signal", "noise")))


#: Cycles of a peak at most in the tables that have a column a cycle; a table with more is an error. The given tables have 17 or fewer.
CYCLES = 20
_KNOWN = f"(SELECT * FROM radmat WHERE CASE WHEN cycle_i < {CYCLES} THEN TRUE ELSE error('more than {CYCLES} cycles') END)"


@query("SELECT channel_i, cycle_i, round(avg(signal), 6) AS mean, quantile_cont(signal, 0.5) AS median FROM radmat GROUP BY 1, 2")
def cycle_stats(spark, sf_dir):
    """A-28: mean and median signal by channel and cycle."""
    return _round(R.cycle_stats(view(spark, sf_dir, "radmat")), "mean")


@query(f"SELECT field_i, channel_i, {', '.join(f'round(avg(signal) FILTER (cycle_i = {c}), 6) AS cycle_{c}' for c in range(CYCLES))} FROM {_KNOWN} GROUP BY 1, 2")
def signal_by_field_cycle(spark, sf_dir):
    """A-28: mean signal by field, a column a cycle."""
    return _round(R.signal_by_field_cycle(view(spark, sf_dir, "radmat"), CYCLES), *(f"cycle_{c}" for c in range(CYCLES)))


@query("WITH q AS (SELECT field_i, avg(quality) AS quality FROM qualities GROUP BY 1) SELECT field_i, round(max(sqrt(aln_x * aln_x + aln_y * aln_y)), 6) AS max_shift, round(any_value(quality), 6) AS quality FROM fields LEFT JOIN q USING (field_i) GROUP BY 1")
def field_alignment(spark, sf_dir):
    """A-28: each field's farthest alignment and mean quality."""
    return _round(R.field_alignment(view(spark, sf_dir, "fields"), view(spark, sf_dir, "qualities")), "max_shift", "quality")


@query("WITH d AS (SELECT *, signal * pow(2, -cycle_i) AS decayed FROM radmat), q AS (SELECT field_i, quantile_cont(decayed, 0.25) AS q1, quantile_cont(decayed, 0.75) AS q3 FROM d GROUP BY 1) SELECT peak_i, cycle_i, decayed FROM d JOIN q USING (field_i) WHERE decayed > q3 + 1.5 * (q3 - q1) OR decayed < q1 - 1.5 * (q3 - q1)")
def boxplot_outliers(spark, sf_dir):
    """A-33: rows far from their field's quartiles, of signals that lose half of it each cycle."""
    rows = view(spark, sf_dir, "radmat").withColumn("decayed", F.col("signal") * F.pow(F.lit(2.0), -F.col("cycle_i")))
    return R.boxplot_outliers(rows, "field_i", "decayed").select("peak_i", "cycle_i", "decayed")


@query("SELECT field_i, cycle_i, round(quantile_cont(signal, 0.05), 6) AS p5, round(quantile_cont(signal, 0.35), 6) AS p35, round(quantile_cont(signal, 0.95), 6) AS p95 FROM radmat GROUP BY 1, 2")
def percentile_bands(spark, sf_dir):
    """A-35: percentiles of signals by field and cycle."""
    return _round(R.percentile_bands(view(spark, sf_dir, "radmat"), ["field_i", "cycle_i"], "signal", {"p5": 0.05, "p35": 0.35, "p95": 0.95}), "p5", "p35", "p95")


@query("SELECT p.peak_i, stage_x, round(stage_y, 6) AS stage_y, round(stage_x + aln_x, 6) AS flowcell_x, round(stage_y + aln_y, 6) AS flowcell_y FROM peaks p JOIN (SELECT field_i, avg(stage_x) AS stage_x, avg(stage_y) AS stage_y FROM metadata GROUP BY 1) m USING (field_i)")
def peaks_on_stage(spark, sf_dir):
    """J-14, P-11: peaks with their field's mean stage place and their own on the flow cell."""
    rows = R.peaks_on_stage(view(spark, sf_dir, "peaks"), view(spark, sf_dir, "metadata"))
    return _round(rows, "stage_y", "flowcell_x", "flowcell_y").select("peak_i", "stage_x", "stage_y", "flowcell_x", "flowcell_y")


@query("SELECT peak_i, channel_i, cycle_i, p.aln_x + f.aln_x - 12 AS raw_x, p.aln_y + f.aln_y - 12 AS raw_y FROM peaks p JOIN fields f ON f.field_i = p.field_i")
def raw_by_shift(spark, sf_dir):
    """P-11: raw coordinates from shifts and the border, by channel and cycle."""
    fields = view(spark, sf_dir, "fields").withColumnsRenamed({"aln_x": "shift_x", "aln_y": "shift_y"})
    return R.raw_by_shift(view(spark, sf_dir, "peaks"), fields, 12).select("peak_i", "channel_i", "cycle_i", "raw_x", "raw_y")


@query(f"WITH {_SPAN} SELECT lifespan, CAST(sum(count(*)) OVER (ORDER BY lifespan) AS BIGINT) AS n FROM s GROUP BY 1")
def cumulative_dark(spark, sf_dir):
    """W-13: peaks of at most each lifespan."""
    return R.cumulative(R.lifespan(view(spark, sf_dir, "radmat")), "lifespan")


@query("SELECT field_i, round(avg(signal / noise), 6) AS snr, round(avg(signal), 6) AS signal, quantile_cont(signal, 0.5) AS median FROM radmat GROUP BY 1")
def field_stats(spark, sf_dir):
    """A-28: signal to noise and signal by field."""
    return _round(R.field_stats(view(spark, sf_dir, "radmat")), "snr", "signal")


@query("SELECT round(avg(signal), 6) AS mean_signal, quantile_cont(signal, 0.5) AS median_signal, round(stddev_samp(signal), 6) AS std_signal, round(avg(signal / noise), 6) AS mean_snr, round(quantile_cont(signal / noise, 0.5), 6) AS median_snr, round(stddev_samp(signal / noise), 6) AS std_snr FROM radmat WHERE cycle_i >= 1 AND cycle_i < 4")
def signal_stats(spark, sf_dir):
    """A-30: mean, median and deviation over some cycles."""
    return _round(R.signal_stats(view(spark, sf_dir, "radmat"), 1, 3), "mean_signal", "std_signal", "mean_snr", "median_snr", "std_snr")


@query("WITH m AS (SELECT field_i, avg(quality) AS quality FROM qualities GROUP BY 1) SELECT field_i, round(quality, 6) AS quality FROM m WHERE quality > (SELECT quantile_cont(quality, 0.5) FROM m)")
def good_fields(spark, sf_dir):
    """A-29: fields above the median quality."""
    return _round(R.good_fields(view(spark, sf_dir, "qualities")), "quality")


@query("WITH q AS (SELECT cycle_i, quantile_cont(signal, 0.25) AS q1, quantile_cont(signal, 0.5) AS median, quantile_cont(signal, 0.75) AS q3, min(signal) AS a, max(signal) AS b FROM radmat GROUP BY 1) SELECT cycle_i, q1, median, q3, greatest(a, q1 - 1.5 * (q3 - q1)) AS low, least(b, q3 + 1.5 * (q3 - q1)) AS high FROM q")
def boxplot(spark, sf_dir):
    """A-33, A-35: quartiles and whiskers by cycle."""
    return R.boxplot(view(spark, sf_dir, "radmat"), "cycle_i", "signal")


@query("SELECT CAST(i AS INT) AS bin, count(signal) AS n FROM range(0, 40) t(i) LEFT JOIN (SELECT signal, least(39, floor(signal / 100000 * 40)) AS b FROM radmat WHERE signal <= 100000) ON b = i GROUP BY 1")
def histogram(spark, sf_dir):
    """A-34: a histogram of signals."""
    return R.histogram(view(spark, sf_dir, "radmat"), "signal", 0.0, 100000.0, 40)


@query("SELECT peak_i, cycle_i, CASE WHEN b THEN 0 ELSE signal END AS signal, CASE WHEN b THEN 0 ELSE noise END AS noise FROM (SELECT *, bool_or(signal < 1500) OVER (PARTITION BY peak_i) AS b FROM radmat)")
def zero_out_nan_peaks(spark, sf_dir):
    """P-14: peaks with a missing signal zeroed."""
    rows = view(spark, sf_dir, "radmat").withColumn("signal", F.when(F.col("signal") >= 1500, F.col("signal")).otherwise(F.lit(float("nan"))))
    return R.zero_out_nan_peaks(rows).select("peak_i", "cycle_i", "signal", "noise")


@query("SELECT r.peak_i, r.cycle_i, n AS n_peaks, p.aln_x - f.aln_x AS raw_x, p.aln_y - f.aln_y AS raw_y FROM radmat r JOIN peaks p ON p.peak_i = r.peak_i JOIN (SELECT DISTINCT field_i, channel_i, cycle_i, CAST(field_i * 3 - 20 AS DOUBLE) AS aln_y, CAST((cycle_i + 1) * 4 - field_i AS DOUBLE) AS aln_x FROM radmat) f ON f.field_i = r.field_i AND f.channel_i = r.channel_i AND f.cycle_i = r.cycle_i JOIN (SELECT field_i, max(field_peak_i) + 1 AS n FROM peaks GROUP BY 1) k ON k.field_i = r.field_i WHERE p.aln_x - f.aln_x >= 100 AND p.aln_x - f.aln_x < 400 AND p.aln_y - f.aln_y >= 100 AND p.aln_y - f.aln_y < 400")
def raw_coordinates(spark, sf_dir):
    """J-11, P-6, P-11: radmat with field and peak, raw coordinates, in a region."""
    radmat = view(spark, sf_dir, "radmat")
    rows = R.fields_peaks_radmat(fields_of(radmat), view(spark, sf_dir, "peaks"), radmat)
    return R.filter_rows(rows, roi=(100, 400, 100, 400)).select("peak_i", "cycle_i", "n_peaks", "raw_x", "raw_y")


@query("SELECT peak_i FROM peaks WHERE sqrt(pow(aln_x - 256, 2) + pow(aln_y - 256, 2)) / 256 < 0.7")
def radial_filter(spark, sf_dir):
    """P-13: peaks near the centre."""
    return R.radial_filter(view(spark, sf_dir, "peaks"), 512, 0.7).select("peak_i")


@query("SELECT peak_i FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM rects r WHERE r.field_i = p.field_i AND aln_x >= l AND aln_x < r AND aln_y >= b AND aln_y < t)")
def peaks_outside_rects(spark, sf_dir):
    """J-21: peaks in no masked rectangle."""
    return P.outside_rects(view(spark, sf_dir, "peaks"), view(spark, sf_dir, "rects")).select("peak_i")


@query("SELECT cycle_i, count(*) AS n FROM locs a WHERE cycle_i > 0 AND NOT EXISTS (SELECT 1 FROM locs b WHERE b.field_i = a.field_i AND b.cycle_i = 0 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2.25) GROUP BY 1")
def new_peaks_per_cycle(spark, sf_dir):
    """J-20, A-42: locations that no peak of cycle 0 is near, by cycle."""
    return P.new_locs(view(spark, sf_dir, "locs")).groupBy("cycle_i").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT field_i, cycle_i, x, y FROM locs a WHERE cycle_i > 0 AND NOT EXISTS (SELECT 1 FROM locs b WHERE b.field_i = a.field_i AND b.cycle_i = 0 AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2.25)")
def new_locs(spark, sf_dir):
    """J-20: locations that no peak of cycle 0 is near."""
    return P.new_locs(view(spark, sf_dir, "locs"))


@query("SELECT a.peak_i, round(sqrt(min(d) FILTER (d > 0)), 6) AS closest, coalesce(min(d) FILTER (d > 0) < 64, FALSE) AS crowded FROM (SELECT a.peak_i, (a.aln_x - b.aln_x) ** 2 + (a.aln_y - b.aln_y) ** 2 AS d FROM peaks a LEFT JOIN peaks b ON b.field_i = a.field_i) a GROUP BY 1")
def crowding(spark, sf_dir):
    """J-22: each peak's distance to the nearest other, and whether that is less than 8."""
    return _round(P.crowding(view(spark, sf_dir, "peaks")), "closest")


_FRAMES = ", ".join(f"'FRAME {c}'" for c in range(CYCLES))
_PHOTO = f"""WITH d AS (SELECT p.field_i, p.peak_i, p.c, coalesce(r.signal > 30000, FALSE) AS lit FROM (SELECT field_i, peak_i, unnest(range({CYCLES})) AS c FROM (SELECT DISTINCT field_i, peak_i FROM radmat)) p
LEFT JOIN radmat r ON r.field_i = p.field_i AND r.peak_i = p.peak_i AND r.cycle_i = p.c),
f AS (SELECT peak_i, concat('(', string_agg(CASE WHEN lit THEN 'True' ELSE 'False' END, ', ' ORDER BY c), ')') AS CATEGORY FROM d GROUP BY peak_i)
SELECT 'ch1' AS CHANNEL, p.peak_i AS H, p.peak_i AS W, CATEGORY, p.* EXCLUDE (peak_i) RENAME (field_i AS FIELD)
FROM (PIVOT (SELECT field_i, peak_i, concat('FRAME ', cycle_i) AS frame, signal FROM {_KNOWN}) ON frame IN ({_FRAMES}) USING max(signal) GROUP BY field_i, peak_i) p JOIN f ON f.peak_i = p.peak_i"""


@query(_PHOTO)
def photometry_table(spark, sf_dir):
    """S-9: the table that an external fitter reads, with a frame for each of CYCLES cycles."""
    from dyelake.sources.fields import photometry_table as table_of

    return table_of(view(spark, sf_dir, "radmat"), 30000, CYCLES)


@query("SELECT peak_i, channel_i, CAST(row_number() OVER (PARTITION BY peak_i ORDER BY cycle_i) - 1 AS INT) AS cycle_i, signal, noise FROM radmat")
def radmat_to_long(spark, sf_dir):
    """S-7: dense arrays to a row a measurement."""
    rows = view(spark, sf_dir, "radmat").groupBy("peak_i").agg(F.sort_array(F.collect_list(F.struct("cycle_i", "signal", "noise"))).alias("s"))
    return R.to_long(rows.select("peak_i", F.array("s.signal").alias("signal"), F.array("s.noise").alias("noise")))


@query("SELECT field_i, field_peak_i, peak_i, o_totalprice AS amp FROM peaks LEFT JOIN (SELECT o_orderkey % 20 AS field_i, floor(o_orderkey / 20) AS field_peak_i, o_totalprice FROM orders WHERE o_orderstatus = 'F') f USING (field_i, field_peak_i)")
def peaks_fits(spark, sf_dir):
    """J-12: peaks with their fits."""
    from dyelake.plans.adapters import over

    fits = over(spark, sf_dir, "SELECT CAST(o_orderkey % 20 AS INT) AS field_i, CAST(floor(o_orderkey / 20) AS INT) AS field_peak_i, o_totalprice AS amp FROM orders WHERE o_orderstatus = 'F'")
    return R.peaks_fits(view(spark, sf_dir, "peaks"), fits).select("field_i", "field_peak_i", "peak_i", "amp")


_TRACKS = "SELECT CAST(s_suppkey % 50 AS INT) AS dyt_i, CAST(s_nationkey % 5 AS INT) AS cycle_i, CAST(max(s_suppkey % 4) AS INT) AS count FROM supplier GROUP BY 1, 2"


@query(f"WITH c AS (SELECT peak_i, min(dyt_i) AS d FROM calls_k GROUP BY 1), r AS (SELECT peak_i, cycle_i, coalesce(d, 0) AS dyt_i FROM radmat LEFT JOIN c USING (peak_i)) SELECT r.peak_i, r.cycle_i, r.dyt_i, coalesce(t.count, 0) AS count FROM r LEFT JOIN ({_TRACKS}) t ON t.dyt_i = r.dyt_i AND t.cycle_i = r.cycle_i")
def sigcalls(spark, sf_dir):
    """J-13: radmat rows with their call's dye count in the cycle."""
    from dyelake.plans.adapters import over

    calls = view(spark, sf_dir, "calls_k").groupBy("peak_i").agg(F.min("dyt_i").alias("dyt_i"))
    return R.sigcalls(view(spark, sf_dir, "radmat"), calls, over(spark, sf_dir, _TRACKS)).select("peak_i", "cycle_i", "dyt_i", "count")


@query("SELECT field_i, channel_i, cycle_i, aln_x, stage_x, exposure_time, quality FROM fields LEFT JOIN metadata USING (field_i, cycle_i) FULL JOIN qualities USING (field_i, channel_i, cycle_i)")
def fields_metadata(spark, sf_dir):
    """J-14: fields with stage place and quality."""
    return R.fields_metadata(view(spark, sf_dir, "fields"), view(spark, sf_dir, "metadata"), view(spark, sf_dir, "qualities")).select("field_i", "channel_i", "cycle_i", "aln_x", "stage_x", "exposure_time", "quality")


@query("SELECT field_i, CAST(floor(aln_y / 64) AS INT) AS ty, CAST(floor(aln_x / 64) AS INT) AS tx, quantile_cont(field_peak_i, 0.5) AS median, round(stddev_pop(field_peak_i), 6) AS std FROM peaks GROUP BY 1, 2, 3")
def regional_stats(spark, sf_dir):
    """A-27: median and deviation by region."""
    pixels = view(spark, sf_dir, "peaks").select("field_i", F.col("aln_y").alias("y"), F.col("aln_x").alias("x"), F.col("field_peak_i").alias("value"))
    return _round(R.regional_stats(pixels, 64), "std")


@query("SELECT field_i, channel_i, count(DISTINCT cycle_i) AS frames, count(DISTINCT peak_i) AS peaks, round(avg(signal) FILTER (cycle_i = 1), 6) AS first, round(avg(signal) FILTER (cycle_i BETWEEN 1 AND 5), 6) AS early FROM radmat GROUP BY 1, 2")
def field_channel_summary(spark, sf_dir):
    """A-31: frames, peaks and early signal by field and channel."""
    return _round(R.field_channel_summary(view(spark, sf_dir, "radmat")), "first", "early")


@query("WITH s AS (SELECT peak_i, string_agg(CAST(floor(signal / 40000) AS INT), '' ORDER BY cycle_i) AS seq FROM radmat GROUP BY 1) SELECT peak_i, 1 AS channel_i, seq, count(*) OVER (PARTITION BY seq) AS n FROM s")
def bestseq_counts(spark, sf_dir):
    """A-36: peaks by their fitted counts."""
    rows = view(spark, sf_dir, "radmat").groupBy("peak_i").agg(F.sort_array(F.collect_list(F.struct("cycle_i", F.floor(F.col("signal") / 40000).cast("int").alias("c")))).alias("s"))
    return R.bestseq_counts(rows.select("peak_i", F.lit("ch2").alias("channel"), F.col("s.c").alias("counts")))


@query("WITH m AS (SELECT field_i, sum(quality) AS quality FROM qualities GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY quality, field_i) - 1 AS p, count(*) OVER () AS n FROM m) SELECT field_i, CAST(quality AS BIGINT) AS quality FROM r WHERE p IN (0, floor((n - 1) / 2), n - 1)")
def worst_median_best(spark, sf_dir):
    """T-8: the fields of worst, median and best quality."""
    means = view(spark, sf_dir, "qualities").groupBy("field_i").agg(F.sum("quality").cast("long").alias("quality"))
    return R.evenly_spaced(means, ["quality", "field_i"])


@query("SELECT field_i, channel_i, cycle_i, aln_x, aln_y FROM fields WHERE aln_x * aln_x + aln_y * aln_y > 400")
def flag_bad_alignment(spark, sf_dir):
    """P-12: fields aligned by more than a fifth of the image."""
    return R.flag_bad_alignment(view(spark, sf_dir, "fields"), 100).select("field_i", "channel_i", "cycle_i", "aln_x", "aln_y")


_SEQ = "b AS (SELECT peak_i, 0 AS channel_i, string_agg(CAST(floor(signal / 40000) AS INT), '' ORDER BY cycle_i) AS seq FROM radmat GROUP BY 1)"


@query(f"WITH {_SEQ} SELECT b.peak_i, seq, cycle_i, signal FROM b LEFT JOIN radmat USING (peak_i, channel_i) WHERE seq = '01'")
def bestseq_radmat(spark, sf_dir):
    """J-15: radmat rows of the peaks of one fitted sequence."""
    rows = view(spark, sf_dir, "radmat")
    seq = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cycle_i", F.floor(F.col("signal") / 40000).cast("int").alias("c")))), lambda x: x["c"].cast("string")), "")
    best = rows.groupBy("peak_i", "channel_i").agg(seq.alias("seq"))
    return R.bestseq_radmat(best, rows, "01").select("peak_i", "seq", "cycle_i", "signal")


@query(f"""WITH c AS (SELECT peak_i, min(dyt_i) AS d, min(k) AS k FROM calls_k GROUP BY 1), s AS (SELECT r.*, coalesce(d, 0) AS dyt_i, coalesce(k, 1) AS k FROM radmat r LEFT JOIN c USING (peak_i)),
j AS (SELECT s.*, coalesce(t.count, 0) AS count FROM s LEFT JOIN ({_TRACKS}) t ON t.dyt_i = s.dyt_i AND t.cycle_i = s.cycle_i),
w AS (SELECT *, max(CASE WHEN count > 0 THEN aspect_ratio ELSE 0 END) OVER (PARTITION BY peak_i) AS worst FROM j)
SELECT peak_i, cycle_i, round(signal / k * (1 + cycle_i / CAST(10 AS DOUBLE)), 6) AS balanced FROM w WHERE worst < 1.4""")
def row_balance(spark, sf_dir):
    """F-16: signals over their row's scale, times the cycle's factor, of peaks of round lit cycles."""
    from dyelake.plans.adapters import over

    calls = view(spark, sf_dir, "calls_k").groupBy("peak_i").agg(F.min("dyt_i").alias("dyt_i"), F.min("k").alias("k"))
    rows = R.sigcalls(view(spark, sf_dir, "radmat"), calls, over(spark, sf_dir, _TRACKS)).join(calls.select("peak_i", "k"), "peak_i", "left").na.fill(1.0, ["k"])
    factors = view(spark, sf_dir, "radmat").select("cycle_i", (1 + F.col("cycle_i") / 10.0).alias("factor")).distinct()
    return _round(R.row_balance(rows, factors, 1.4), "balanced").select("peak_i", "cycle_i", "balanced")


@query(f"WITH {_SPAN}, m AS (SELECT cycle_i, avg(signal) AS m FROM radmat r JOIN s ON s.peak_i = r.peak_i WHERE cycle_i < lifespan GROUP BY 1) SELECT cycle_i, round(m / (SELECT quantile_cont(m, 0.5) FROM m), 6) AS factor FROM m")
def cycle_balance_lifespan(spark, sf_dir):
    """A-25: each cycle's balance over the peaks that are lit in it."""
    rows = view(spark, sf_dir, "radmat")
    return _round(R.cycle_balance_lifespan(R.lifespan(rows), rows), "factor")


@query("""WITH t AS (SELECT field_i, CAST(peak_i % 3 AS INT) AS cycle_i, CAST(floor(aln_y / 64) AS INT) AS ty, CAST(floor(aln_x / 64) AS INT) AS tx, avg(field_peak_i) AS mean FROM peaks GROUP BY ALL),
p AS (SELECT field_i, quantile_cont(mean, 0.5) + quantile_cont(mean, 0.75) - quantile_cont(mean, 0.25) AS most FROM t GROUP BY 1)
SELECT t.field_i, 0 AS channel_i, cycle_i, ty, tx, round(mean, 6) AS mean FROM t JOIN p USING (field_i) WHERE mean > most""")
def tile_anomalies(spark, sf_dir):
    """A-26: tiles much brighter than the others of their field."""
    pixels = view(spark, sf_dir, "peaks").select("field_i", F.lit(0).alias("channel_i"), (F.col("peak_i") % 3).alias("cycle_i"), F.col("aln_y").alias("y"), F.col("aln_x").alias("x"), F.col("field_peak_i").alias("value"))
    return _round(R.tile_anomalies(pixels, tile=64), "mean")


@query("""WITH g AS (SELECT peak_i, avg(signal) FILTER (signal >= 20000) AS mean, stddev_pop(signal) FILTER (signal >= 20000) AS std FROM radmat GROUP BY 1
HAVING bool_or(cycle_i = 1 AND signal > 20000) AND arg_max(signal, cycle_i) < 20000 AND mean IS NOT NULL),
h AS (SELECT * FROM g WHERE std < (SELECT quantile_cont(std, 0.5) FROM g)), x AS (SELECT ln(signal / (mean / (SELECT avg(mean) FROM h))) AS x FROM radmat JOIN h USING (peak_i) WHERE signal >= 20000)
SELECT round(exp(avg(x)), 4) AS beta, round(stddev_pop(x), 6) AS sigma FROM x""")
def lognormal_gain(spark, sf_dir):
    """A-41: brightness of one dye and its spread, of balanced rows."""
    return R.lognormal_gain(view(spark, sf_dir, "radmat"), 20000).select(F.round("beta", 4).alias("beta"), F.round("sigma", 6).alias("sigma"))


@query(f"""WITH c AS (SELECT peak_i, min(dyt_i) AS d FROM calls_k GROUP BY 1), r AS (SELECT cycle_i, signal, coalesce(d, 0) AS dyt_i FROM radmat LEFT JOIN c USING (peak_i)),
m AS (SELECT r.cycle_i, avg(signal) AS m FROM r JOIN ({_TRACKS}) t ON t.dyt_i = r.dyt_i AND t.cycle_i = r.cycle_i WHERE t.count = 1 GROUP BY 1) SELECT cycle_i, round((SELECT avg(m) FROM m) / m, 9) AS factor FROM m""")
def cycle_balance_of_ones(spark, sf_dir):
    """A-24: each cycle's balance over rows whose call has one dye left."""
    from dyelake.plans.adapters import over

    calls = view(spark, sf_dir, "calls_k").groupBy("peak_i").agg(F.min("dyt_i").alias("dyt_i"))
    rows = R.sigcalls(view(spark, sf_dir, "radmat"), calls, over(spark, sf_dir, _TRACKS))
    return R.cycle_balance_of_ones(rows).withColumn("factor", F.round("factor", 9))


@query("""SELECT peak_i, cycle_i, signal FROM radmat WHERE peak_i IN (SELECT peak_i FROM radmat WHERE channel_i = 0 GROUP BY 1
HAVING bool_and(signal <= 90000 OR cycle_i < 3) AND bool_and(signal >= 1500 OR cycle_i <> 0) AND bool_and(aspect_ratio <= 1.47) AND bool_and(cycle_i <> 1 OR signal BETWEEN 2000 AND 80000))""")
def filter_peaks_by_cycle(spark, sf_dir):
    """P-7: whole peaks, dark from cycle 3, of bounded aspect ratios and signals in single cycles of a channel."""
    rows = R.filter_peaks(view(spark, sf_dir, "radmat"), dark=90000, off_at=3, cycle_0=(1500, None), aspect_ratio=(None, 1.47), per_cycle={1: (2000, 80000)}, channel=0)
    return rows.select("peak_i", "cycle_i", "signal")


def _measures(pre, cond):
    of = f" FILTER ({cond})"
    return f"""quantile_cont(signal, 0.5){of} AS {pre}_med, round(avg(signal){of}, 6) AS {pre}_men, round(stddev_pop(signal){of}, 6) AS {pre}_std,
        quantile_cont(signal, 0.75){of} - quantile_cont(signal, 0.25){of} AS {pre}_iqr, max(signal){of} AS {pre}_max, min(signal){of} AS {pre}_min, max(signal){of} - min(signal){of} AS {pre}_rng"""


@query(f"""WITH {_SPAN}, m AS (SELECT r.*, lifespan FROM radmat r JOIN s ON s.peak_i = r.peak_i AND s.channel_i = r.channel_i),
f AS (SELECT peak_i, channel_i, max(lifespan) AS lif_len, {_measures('lif', 'cycle_i < lifespan')}, {_measures('afl', 'cycle_i >= lifespan')}, {_measures('sig', 'TRUE')},
round(quantile_cont(aspect_ratio, 0.5) FILTER (cycle_i < lifespan), 6) AS asr_med, round(stddev_pop(aspect_ratio) FILTER (cycle_i < lifespan), 6) AS asr_std, max(aspect_ratio) FILTER (cycle_i < lifespan) AS asr_max,
max(aspect_ratio) FILTER (cycle_i = 0) AS asr_cy0, round(avg(noise) FILTER (cycle_i < lifespan), 6) AS nei_noise FROM m GROUP BY 1, 2)
SELECT f.*, round(sqrt(pow(aln_x - 256, 2) + pow(aln_y - 256, 2)), 6) AS radius FROM f JOIN peaks ON peaks.peak_i = f.peak_i""")
def peak_features(spark, sf_dir):
    """A-32: each peak's measures over its lifespan, after it and over all cycles."""
    out = R.peak_features(view(spark, sf_dir, "radmat"), view(spark, sf_dir, "peaks"), 512, ("noise",))
    return _round(out, "lif_men", "lif_std", "afl_men", "afl_std", "sig_men", "sig_std", "asr_med", "asr_std", "nei_noise", "radius")


@query()
def decay_half_life(spark, sf_dir):
    """M-8: each field's half-life of a signal that loses half of it every other cycle."""
    from dyelake.operators.fits import decay_half_life as half_life

    rows = view(spark, sf_dir, "radmat").withColumn("signal", F.col("signal") * F.pow(F.lit(2.0), -F.col("cycle_i") / 2))
    return half_life(rows).select("field_i", "channel_i", F.col("half_lives")[0].alias("half_life"))
