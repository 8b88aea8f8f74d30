"""Protein and peptide sequences as arrays of residue tokens: parsing, cleaving, decoys, modified forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.storage import written

# Where each protease cuts. A rule is (cuts, residues before the cut from far to near, residues after it from
# near to far); an empty string takes any residue. The last rule that fits a place decides there.
PROTEASES: dict[str, list[tuple[bool, list[str], list[str]]]] = {
    "trypsin": [
        (True, ["KR"], []),
        (False, ["KR"], ["P"]),
        (True, ["W", "K"], ["P"]),
        (True, ["M", "R"], ["P"]),
        (False, ["CD", "K"], ["D"]),
        (False, ["C", "K"], ["HY"]),
        (False, ["C", "R"], ["K"]),
        (False, ["R", "R"], ["HR"]),
    ],
    "lysc": [(True, ["K"], [])],
    "lysn": [(True, [], ["K"])],
    "argc": [(True, ["R"], [])],
    "aspn": [(True, [], ["D"])],
    "gluc_ph4": [(True, ["E"], []), (False, ["E"], ["PE"])],
    "gluc_ph8": [(True, ["DE"], []), (False, ["DE"], ["PE"])],
    "cnbr": [(True, ["M"], [])],
    "idosobenzoic": [(True, ["W"], [])],
    "ntcb": [(True, [], ["C"])],
    "endopro": [(True, ["AP"], [])],
    "lysarg": [(True, [], ["K"]), (True, [], ["R"])],
}


def aa_tokens(seq: Column, nesting: int = 3) -> Column:
    """Residue tokens of a sequence: letters in upper case, a bracketed modification bound to the residue before it.

    White space and comments in round brackets (nested up to ``nesting`` deep) are dropped. A character that is
    no residue, or a bracket without its partner, is an error.
    """
    text = F.upper(F.regexp_replace(seq, r"\s", ""))
    for _ in range(nesting):
        text = F.regexp_replace(text, r"\([^()]*\)", "")
    tokens = F.regexp_extract_all(text, F.lit(r"[A-Z0-9.](?:\[[^\[\]]*\])?"), 0)
    bad = F.raise_error(F.concat(F.lit("not a sequence: "), seq)).cast("array<string>")
    return F.when(F.array_join(tokens, "") == text, tokens).otherwise(bad)


def aa_join(tokens: Column, every: int = 0) -> Column:
    """Tokens as a string, with a space after each ``every`` of them."""
    if not every:
        return F.array_join(tokens, "")
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / every)), lambda i: F.array_join(F.slice(tokens, (i * every + 1).cast("int"), every), ""))
    return F.when(F.size(tokens) > 0, F.array_join(parts, " ")).otherwise("")


def cut_pattern(proteases: list[str]) -> str:
    """A pattern that matches, without width, at each cut of any of the proteases in a string of residue letters."""

    def place(before: list[str], after: list[str]) -> str:
        left, right = ("".join(f"[{r}]" if r else "." for r in side) for side in (before, after))
        return (f"(?<={left})" if left else "") + (f"(?={right})" if right else "")

    out = []
    for p in proteases:
        rules = PROTEASES[p]
        for i, (keep, before, after) in enumerate(rules):
            if keep:
                # A later rule that fits here and doesn't cut wins, unless a still later one cuts: that has its own alternative.
                out.append(place(before, after) + "".join(f"(?!{place(b, a)})" for k, b, a in rules[i + 1 :] if not k))
    return "(?!^)(?!$)(?:" + "|".join(out) + ")"


#: Peptides whose lengths are summed up together: sums of sums then keep the work near the number of peptides.
_RUN = 128


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once a row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_starts(sizes: Column) -> Column:
    """An array of where each of some pieces begins, by an array of their sizes, within the row: sums in runs of _RUN pieces, and sums of the runs before."""
    zero = F.array(F.lit(0))
    add = lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x))

    def made(own: Column) -> Column:
        runs = F.when(F.size(own) > 0, F.transform(F.sequence(F.lit(0), ((F.size(own) - 1) / _RUN).cast("int")), lambda i: F.aggregate(F.slice(own, i * _RUN + 1, F.lit(_RUN)), zero, add))).otherwise(F.array().cast("array<array<int>>"))
        # The last of each run's sums is the run's size; the rest are its pieces' starts.
        each = lambda all_runs: F.flatten(F.zip_with(all_runs, F.aggregate(all_runs, zero, lambda sums, r: add(sums, F.element_at(r, -1))), lambda r, start: F.when(r.isNull(), F.array().cast("array<int>")).otherwise(F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda x: x + start))))
        return _let(runs, each)

    return _let(sizes, made)


def peptides_of(sequence: Column, proteases: list[str]) -> Column:
    """An array of (pep_start, pep_stop, seqstr): the peptides between cuts of any of the proteases, with their places. Without proteases the sequence is one peptide."""
    parts = F.filter(F.split(sequence, cut_pattern(proteases)), lambda x: x != "") if proteases else F.filter(F.array(sequence), lambda x: x != "")
    placed = lambda own: F.zip_with(own, running_starts(F.transform(own, F.length)), lambda s, a: F.struct(a.alias("pep_start"), (a + F.length(s)).alias("pep_stop"), s.alias("seqstr")))
    return _let(parts, placed)


def cleave(pros: DataFrame, key: str, sequence: str, proteases: list[str]) -> DataFrame:
    """(key, pep_start, pep_stop, seqstr) of each peptide between cuts of ``pros`` (key, sequence).

    Any protease's cut counts; without proteases the whole sequence is one peptide. Sequences are plain residue letters, as
    they are before modified forms are made; null and empty ones have no peptides. A protein is split in one scan, whatever its length, and peptides get
    their places within the row, so nothing is shuffled and keys may repeat.
    """
    return pros.select(key, F.inline(peptides_of(F.col(sequence), proteases)))


def cleave_each(pros: DataFrame, key: str, sequence: str, schemes: dict[str, list[str]]) -> DataFrame:
    """(key, scheme, pep_start, pep_stop, seqstr): cleave() by each of several named sets of proteases, in one pass over ``pros``."""
    every = F.array(*(F.struct(F.lit(name).alias("scheme"), peptides_of(F.col(sequence), own).alias("peps")) for name, own in schemes.items()))
    return pros.select(key, F.inline(every)).select(key, "scheme", F.inline("peps"))


def reversed_ptm_locs(locs: Column, length: Column) -> Column:
    """1-based places in ";"-joined text, as they are in the reversed sequence."""
    each = F.transform(F.filter(F.split(locs, ";"), lambda x: x != ""), lambda x: length - x.cast("int") + 1)
    return F.array_join(F.transform(F.array_sort(each), lambda x: x.cast("string")), ";")


def with_decoys(pros: DataFrame, mode: str = "reverse", seed: int = 1) -> DataFrame:
    """``pros`` (pro_i, pro_id, tokens, pro_ptm_locs) and a decoy of each, numbered after all real ones; protein 0 has none.

    Reversed decoys carry their modification sites along; a shuffle can't, so sites and shuffle together are an error.
    """
    real = pros.filter("pro_i > 0")
    n = real.agg(F.coalesce(F.max("pro_i"), F.lit(0)).alias("n"))
    if mode == "reverse":
        tokens, locs, prefix = F.reverse("tokens"), reversed_ptm_locs(F.col("pro_ptm_locs"), F.size("tokens")), "rev-"
    else:
        order = F.array_sort(F.transform("tokens", lambda t, i: F.struct(F.xxhash64("pro_i", i, F.lit(seed)), t.alias("t"))))
        tokens, prefix = F.transform(order, lambda x: x["t"]), "shu-"
        locs = F.when(F.col("pro_ptm_locs") == "", "").otherwise(F.raise_error(F.lit("a shuffled decoy can't have modification sites")))
    made = real.crossJoin(F.broadcast(n)).select((F.col("pro_i") + F.col("n")).alias("pro_i"), F.concat(F.lit(prefix), "pro_id").alias("pro_id"), tokens.alias("tokens"), locs.alias("pro_ptm_locs"), F.lit(True).alias("pro_is_decoy"))
    return pros.withColumn("pro_is_decoy", F.lit(False)).select(*made.columns).unionByName(made)


def ptm_variants(peps: DataFrame, limit: int) -> DataFrame:
    """(pep_i, variant, tokens) of every way to modify a peptide (pep_i, tokens, sites: 0-based places array).

    Each set of sites, but the empty one, gives a variant whose residues at those sites are marked "[p]"; variants go by number of
    sites, then by their places. Peptides of more sites than ``limit`` have none, which is settled before anything is made.
    """
    if not 0 < limit <= 20:
        raise ValueError("a peptide of n sites has 2**n variants: the limit is 1 to 20")
    fine = peps.filter((F.size("sites") > 0) & (F.size("sites") <= limit))
    mask = fine.withColumn("mask", F.explode(F.expr("sequence(1, shiftleft(1, size(sites)) - 1)")))
    chosen = mask.withColumn("chosen", F.filter("sites", lambda s, i: F.col("mask").bitwiseAND(F.pow(F.lit(2), i).cast("int")) != 0))
    marked = F.transform("tokens", lambda t, i: F.when(F.array_contains("chosen", i), F.concat(t, F.lit("[p]"))).otherwise(t))
    order = W.partitionBy("pep_i").orderBy(F.size("chosen"), "chosen")
    return chosen.select("pep_i", F.row_number().over(order).alias("variant"), marked.alias("tokens"))


def flustr(tokens: Column, labels: dict[str, int], n_edmans: int, n_channels: int) -> Column:
    """A fluorosequence: for each of n_edmans places the channel of its residue or ".", then the dyes by channel in the rest."""
    channel = lambda t: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for k, v in labels.items() for x in (k, str(v)))), t), F.lit("."))
    coded = F.transform(tokens, channel)
    head = F.rpad(F.array_join(F.slice(coded, 1, n_edmans), ""), n_edmans, " ")
    rest = F.slice(coded, n_edmans + 1, F.greatest(F.lit(0), F.size(tokens) - n_edmans))
    tail = F.array(*(_count(rest, str(ch)) for ch in range(n_channels)))
    return F.concat(head, F.lit(" ;"), F.array_join(tail, ","))


def _count(codes: Column, code: str) -> Column:
    return F.size(F.filter(codes, lambda c: c == code)).cast("string")


def flu_counts(tokens: Column, labels: dict[str, int], n_edmans: int, n_channels: int) -> dict[str, Column]:
    """Dye counts of a peptide: n_head_ch_k within the first n_edmans residues and n_tail_ch_k after them for each channel, both over all channels, n_dyes_all_ch
    and the most of any channel, n_dyes_max_any_ch."""
    head, tail = F.slice(tokens, 1, n_edmans), F.slice(tokens, n_edmans + 1, F.greatest(F.lit(0), F.size(tokens) - n_edmans))
    of = lambda some, ch: F.size(F.filter(some, lambda t: t.isin([k for k, v in labels.items() if v == ch])))
    out = {f"n_{name}_ch_{ch}": of(some, ch) for name, some in (("head", head), ("tail", tail)) for ch in range(n_channels)}
    total = lambda some: F.size(F.filter(some, lambda t: t.isin(list(labels))))
    both = [of(tokens, ch) for ch in range(n_channels)]
    return out | {"n_head_all_ch": total(head), "n_tail_all_ch": total(tail), "n_dyes_all_ch": total(tokens), "n_dyes_max_any_ch": F.greatest(*both) if len(both) > 1 else both[0]}


def with_ptm_peps(peps: DataFrame, limit: int) -> DataFrame:
    """``peps`` (pep_i, pro_i, pep_start, pep_stop, tokens, sites) and all ways to modify them, as peptides (without sites) numbered on from the greatest.

    Modified peptides keep the protein and the place of the plain one, and are numbered by it, then by number of sites and places; is_ptm tells them apart.
    """
    made = global_index(ptm_variants(peps, limit), "pep_i", ["variant"], "place").withColumnRenamed("tokens", "marked")
    last = peps.agg(F.max("pep_i").alias("last"))
    new = made.join(peps.select("pep_i", "pro_i", "pep_start", "pep_stop"), "pep_i").crossJoin(F.broadcast(last))
    new = new.select((F.col("last") + 1 + F.col("place")).cast("int").alias("pep_i"), "pro_i", "pep_start", "pep_stop", F.col("marked").alias("tokens"), F.lit(True).alias("is_ptm"))
    return peps.select("pep_i", "pro_i", "pep_start", "pep_stop", "tokens", F.lit(False).alias("is_ptm")).unionByName(new)


def global_index(df: DataFrame, group: str, order: list, name: str, bins: int = 256) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... over all rows by ``group``, then ``order`` (which tells a group's rows apart).

    Rows are counted by group, and groups by bins of a hash-free range of the group's values, so that only
    totals are ever ranked together.
    """
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n")).withColumn("bin", F.floor(F.col(group) / bins))
    totals = counts.groupBy("bin").agg(F.sum("n").alias("all"))
    upto = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    totals = totals.select("bin", upto(W.orderBy("bin"), "all").alias("before"))
    start = counts.select(group, "bin", upto(W.partitionBy("bin").orderBy(group), "n").alias("inside")).join(totals, "bin").select(group, (F.col("before") + F.col("inside")).alias("start"))
    own = F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1
    return df.withColumn("own place", own).join(start, group).withColumn(name, F.col("start") + F.col("own place")).drop("own place", "start")


def numbered_by_range(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with ``name``: 0, 1, ... in ``order``, which tells rows apart. Rows are sorted in ranges, and only the ranges' totals are ranked together."""
    own = written(df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    totals = own.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("range").orderBy(*order)) - 1
    return own.withColumn("place", place).join(totals.select("range", before.alias("before")), "range").withColumn(name, F.col("before") + F.col("place")).drop("range", "place", "before")


def limit_peptides(peps: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """Peptide 0, and ``n`` others drawn by a seeded hash of their number."""
    drawn = peps.filter("pep_i != 0").select("pep_i").distinct().orderBy(F.xxhash64("pep_i", F.lit(seed)), "pep_i").limit(n)
    return peps.filter("pep_i = 0").unionByName(peps.join(drawn, "pep_i", "left_semi"))


def drop_duplicate_proteins(specs: DataFrame) -> DataFrame:
    """``specs`` (name, sequence, ...) with the first name of each sequence, then the first sequence of each name."""
    for key, order in (("sequence", "name"), ("name", "sequence")):
        columns = specs.columns
        held = [c for c in columns if c != key]
        # A grouped minimum has partial sums, so one sequence may have any number of names.
        specs = specs.groupBy(key).agg(F.min(F.struct(F.col(order), *(c for c in held if c != order))).alias("first")).select(key, "first.*").select(*columns)
    return specs


def duplicates(specs: DataFrame, key: str) -> DataFrame:
    """(key, n) of values that several rows have: empty if ``key`` is unique."""
    return specs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def normalize_abundance(specs: DataFrame) -> DataFrame:
    """``specs`` with abundance divided by the smallest positive one; all 1 if all are missing.

    Some missing, NaN or negative beside others is an error.
    """
    some = specs.agg(F.min(F.when(F.col("abundance") > 0, F.col("abundance"))).alias("least"), F.count("abundance").alias("known"), F.count(F.lit(1)).alias("rows"), F.count_if(F.isnan("abundance") | (F.col("abundance") < 0)).alias("bad"))
    fault = (F.col("bad") > 0) | ((F.col("known") > 0) & (F.col("known") < F.col("rows")))
    value = F.when(fault, F.raise_error(F.lit("an abundance is missing or negative")).cast("double")).when(F.col("known") == 0, 1.0).otherwise(F.col("abundance") / F.col("least"))
    return specs.crossJoin(F.broadcast(some)).withColumn("abundance", value).select(*specs.columns)


def run_name(*parts: Column) -> Column:
    """Parts in lower case, with runs of other characters than letters, digits and _ as one _."""
    return F.regexp_replace(F.lower(F.concat_ws("_", *parts)), "[^0-9a-z_]+", "_")
