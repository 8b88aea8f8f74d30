"""Relational views over proteins, peptides, residues, fluorosequences and calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written

#: Rows of a list that one task gives it to; parts of rows without any list.
PARCEL_ROWS, SPREAD = 16384, 64
#: Characters of a partition: of all its rows' lists, and of its different ones.
PARTITION_TEXT, PARTITION_LISTS = 32_000_000, 256_000

def pros_where(pros: DataFrame, which: str) -> DataFrame:
    """Proteins by flag: in_report, with_ptms, decoys or no_decoys."""
    return pros.filter({"in_report": "pro_report > 0", "with_ptms": "pro_ptm_locs != ''", "decoys": "pro_is_decoy", "no_decoys": "NOT pro_is_decoy"}[which])


def set_by_id(pros: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``pros`` with ``column`` taken from ``values`` (pro_id, value) where it has the protein; an unknown id is an error."""
    known = pros.select("pro_id").distinct().withColumn("known", F.lit(True))
    checked = values.join(known, "pro_id", "left").select("pro_id", F.when(F.col("known"), F.col("value")).otherwise(F.raise_error(F.lit("unknown protein")).cast(values.schema["value"].dataType)).alias("value"), F.lit(True).alias("given"))
    # Unknown ids have no partner among the proteins: a full join keeps them, so that they are noticed.
    joined = pros.join(checked, "pro_id", "full")
    return joined.withColumn(column, F.when(F.col("given"), F.col("value")).otherwise(F.col(column))).select(*pros.columns)


def pros_peps(pros: DataFrame, peps: DataFrame) -> DataFrame:
    """Proteins with their peptides; a protein without any has one row of nulls."""
    return pros.join(peps, "pro_i", "left")


def peps_of(pros: DataFrame, peps: DataFrame, which: str) -> DataFrame:
    """Peptides of the proteins of a flag."""
    return pros_where(pros, which).select("pro_i").join(peps, "pro_i").select("pro_i", "pep_i", "pep_start", "pep_stop")


def pepseqs_of(peps: DataFrame, strings: DataFrame) -> DataFrame:
    """``peps`` (pep_i, ...) with a row for each residue of ``strings`` (pep_i, tokens): aa, pep_offset_in_pro.

    Peptides meet their tokens before these become rows. Spark takes the size of exploded rows for that of the rows before, and would send
    all residues through the driver as a small table; a merge join sends no side whole.
    """
    return peps.join(strings.hint("merge"), "pep_i").select(*peps.columns, F.posexplode("tokens").alias("pep_offset_in_pro", "aa"))


def pep_strings(pep_seqs: DataFrame, key: str = "pep_i", order: str = "pep_offset_in_pro") -> DataFrame:
    """(key, seqstr, seqlen): residues (key, aa, offset) joined in order."""
    joined = pep_seqs.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, "aa"))).alias("s"))
    return joined.select(key, F.array_join(F.col("s.aa"), "").alias("seqstr"), F.size("s").alias("seqlen"))


def bounds(pep_seqs: DataFrame) -> DataFrame:
    """(pep_i, pep_start, pep_stop): least offset, and the greatest plus one."""
    return pep_seqs.groupBy("pep_i").agg(F.min("pep_offset_in_pro").alias("pep_start"), (F.max("pep_offset_in_pro") + 1).alias("pep_stop"))


def calls_pros(calls: DataFrame, pros: DataFrame, peps: DataFrame, which: str = "true") -> DataFrame:
    """Each call with the protein and peptide that it truly is, or was called as; all calls stay."""
    wide = peps.join(pros, "pro_i").select(F.col("pep_i").alias(f"{which}_pep_i"), "pro_i", "pro_id", "pro_is_decoy", "pep_start", "pep_stop")
    return calls.join(wide, f"{which}_pep_i", "left")


def called_peps(calls: DataFrame, strings: DataFrame, which: str = "pred") -> DataFrame:
    """Distinct true or called peptides with their sequences."""
    return calls.select(F.col(f"{which}_pep_i").alias("pep_i")).distinct().join(strings, "pep_i")


def locs_of(text: Column) -> Column:
    """";"-joined numbers as an array."""
    return F.transform(F.filter(F.split(text, ";"), lambda x: x != ""), lambda x: x.cast("int"))


def peps_ptms(pros: DataFrame, peps: DataFrame, decoys: bool = False, in_report: bool = False, ptm_peps_only: bool = True, to_rows: bool = False) -> DataFrame:
    """Peptides with the modification sites of their protein that lie in them: 1-based p with pep_start < p <= pep_stop.

    The sites travel with the protein as an array, so nothing is joined by range. to_rows gives one row a site.
    """
    some = pros if decoys else pros_where(pros, "no_decoys")
    some = pros_where(some, "in_report") if in_report else some
    rows = peps.join(some.select("pro_i", "pro_id", "pro_ptm_locs"), "pro_i")
    inside = F.filter(locs_of(F.col("pro_ptm_locs")), lambda p: (p - 1 >= F.col("pep_start")) & (p - 1 < F.col("pep_stop")))
    rows = rows.withColumn("sites", inside).withColumn("n_pep_ptms", F.size("sites"))
    rows = rows.filter("n_pep_ptms > 0") if ptm_peps_only or to_rows else rows
    if to_rows:
        return rows.select("pro_i", "pro_id", "pep_i", "pep_start", "pep_stop", "n_pep_ptms", F.explode("sites").alias("ptm"))
    return rows.select("pro_i", "pro_id", "pep_i", "pep_start", "pep_stop", "n_pep_ptms", F.array_join(F.transform("sites", lambda x: x.cast("string")), ";").alias("pep_ptms"))


def active_sites(tokens: Column, sites: Column, start: Column) -> Column:
    """Those 1-based sites of the protein at which the peptide's residue is marked "["."""
    return F.filter(sites, lambda p: F.contains(F.coalesce(F.get(tokens, p - 1 - start), F.lit("")), F.lit("[")))


def label_table(labels: DataFrame, dyes: DataFrame) -> DataFrame:
    """(aa, label_name, dye_name, ch_i, p_bright): labels with their dye's channel and the chance that all steps work.

    ``labels`` (aa, label_name, dye_name, p_failure_to_bind, p_failure_to_attach), ``dyes`` (place, dye_name, channel_name, p_failure, beta, sigma, p_bleach), short tables.
    Channels are numbered in the order in which the dyes first name them; two values of beta, sigma or p_bleach in one channel are an error. Equal rows are one.
    """
    from pyspark.sql import Window as W

    same = [F.count_distinct(c) == 1 for c in ("beta", "sigma", "p_bleach")]
    channels = dyes.groupBy("channel_name").agg(F.min("place").alias("first"), (same[0] & same[1] & same[2]).alias("one")).withColumn("ch_i", F.row_number().over(W.orderBy("first")) - 1)
    fine = F.when(F.col("one"), F.col("ch_i")).otherwise(F.raise_error(F.concat(F.lit("a channel has one beta, sigma and bleaching: "), F.col("channel_name"))).cast("int"))
    p = (1 - F.col("p_failure_to_bind")) * (1 - F.col("p_failure_to_attach")) * (1 - F.col("p_failure"))
    return labels.join(dyes, "dye_name").join(channels, "channel_name").select("aa", "label_name", "dye_name", fine.alias("ch_i"), p.alias("p_bright")).distinct()


def label_pcbs(pep_seqs: DataFrame, labels: DataFrame) -> DataFrame:
    """(pep_i, pep_offset_in_pro, aa, ch_i, p_bright) of each residue; unlabelled ones have nulls. Labels are one row a residue letter."""
    return pep_seqs.join(labels.select("aa", "ch_i", "p_bright"), "aa", "left").select("pep_i", "pep_offset_in_pro", "aa", "ch_i", "p_bright")


def set_dictionary(rows: DataFrame, key: str, member: str) -> tuple[DataFrame, DataFrame]:
    """(key, set_id, n) and (set_id, member): the sets of members that keys have, each set once, however many keys share it.

    A set's id is a digest of its number of members and of two sums over 60 bits of their md5, so it needs no row that
    holds a set, and equal sets have equal ids anywhere. Members are rows of their own.
    """
    own = rows.select(key, member).filter(F.col(member).isNotNull()).distinct()
    part = lambda at: F.conv(F.substring(F.md5(F.col(member).cast("string").cast("binary")), at, 15), 16, 10).cast("decimal(38,0)")
    sums = own.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(part(1)).alias("a"), F.sum(part(16)).alias("b"))
    keys = sums.select(key, F.md5(F.concat_ws(":", "n", F.col("a").cast("string"), F.col("b").cast("string")).cast("binary")).alias("set_id"), "n")
    # One key stands for all that have the set.
    of = keys.groupBy("set_id").agg(F.min(key).alias(key))
    return keys, own.join(of, key).select("set_id", member)


def with_lists(rows: DataFrame, lists: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``lists`` (key, long text), one row a key; rows without a list stay.

    Rows of one list lie together in parcels of about PARCEL_ROWS, and few lists meet in one partition. So no task has all rows of a common list, a list is
    sent once a parcel, and a file that keeps each different value once (Parquet's dictionary, of 1 MB at most) holds each list once, however many rows have it.
    """
    rows, lists = written(rows), written(lists)
    text = next(c for c in lists.columns if c != key)
    parts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows")).withColumn("parts", F.ceil(F.col("rows") / PARCEL_ROWS))
    size = F.length(text).cast("long")
    sums = lists.join(parts, key).agg(F.sum("parts"), F.sum(size * F.col("rows")), F.sum(size * F.col("parts"))).first()
    n = max(1, min(sums[0], max(sums[1] // PARTITION_TEXT, sums[2] // PARTITION_LISTS))) if sums[0] else 1
    parts = parts.drop("rows")
    copies = lists.join(parts, key).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    dealt = rows.join(parts, key, "left").withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.coalesce("parts", F.lit(SPREAD)))).drop("parts")
    return dealt.repartition(n, key, "part").join(copies, [key, "part"], "left").drop("part")


def flu_sets(report: DataFrame, flus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """set_dictionary() of the proteins that share a fluorosequence: (flustr, set_id, n) and (set_id, pro_id)."""
    return set_dictionary(report.join(flus, "pep_i"), "flustr", "pro_id")


def falses_flus(falses: DataFrame, report: DataFrame, flus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """False calls with the peptide's and the false peptide's protein and fluorosequence, and the set of proteins that share the peptide's, as its id, its number and its sorted members; and the sets (set_id, pro_id).

    ``report`` (pep_i, pro_id), ``flus`` (pep_i, flustr). A set is listed once and joined last, so that no other join carries the lists. A fluorosequence without a named protein has nulls for its set.
    """
    wide = report.join(flus, "pep_i")
    sharing, members = flu_sets(report, flus)
    one = wide.join(sharing.select("flustr", F.col("set_id").alias("flu_set"), F.col("n").alias("n_flu_pros")), "flustr", "left").select("pep_i", "pro_id", "flustr", "flu_set", "n_flu_pros")
    other = wide.select(F.col("pep_i").alias("false_pep_i"), F.col("pro_id").alias("false_pro_id"), F.col("flustr").alias("false_flustr"))
    lists = members.groupBy(F.col("set_id").alias("flu_set")).agg(F.array_join(F.sort_array(F.collect_list("pro_id")), ",").alias("flu_pros"))
    return with_lists(falses.join(one, "pep_i").join(other, "false_pep_i", "left"), lists, "flu_set"), members


def prep_summary(pros: DataFrame, peps: DataFrame, strings: DataFrame, in_report_only: bool = False) -> DataFrame:
    """One row of counts: proteins and decoys among them, peptides, different sequences, peptides of real proteins and of decoys; the null protein and peptide don't count.

    ``strings`` (pep_i, seqstr) are the peptides' sequences. With ``in_report_only`` all is about proteins in the report.
    """
    some = (pros_where(pros, "in_report") if in_report_only else pros).filter("pro_i > 0")
    n_pros = some.agg(F.count(F.lit(1)).alias("n_pros"), F.count_if("pro_is_decoy").alias("n_decoy_pros"))
    own = peps.filter("pep_i > 0").join(some.select("pro_i", "pro_is_decoy"), "pro_i")
    n_peps = own.agg(F.count(F.lit(1)).alias("n_peps"), F.count_if(~F.col("pro_is_decoy")).alias("n_real_peps"), F.count_if("pro_is_decoy").alias("n_decoy_peps"))
    unique = strings.join(own.select("pep_i"), "pep_i", "left_semi").agg(F.count_distinct("seqstr").alias("n_unique"))
    return n_pros.crossJoin(n_peps).crossJoin(unique)


def domain_loss(requested: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """(lost): the requested values that no row has any more, a row each."""
    gone = requested.select(key).distinct().join(kept.select(key).distinct(), key, "left_anti")
    return gone.select(F.col(key).alias("lost"))
