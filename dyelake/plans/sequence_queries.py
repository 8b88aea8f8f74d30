"""Queries over sequences, proteins, peptides and labels."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from dyelake.operators import calls as C
from dyelake.operators import relations as J
from dyelake.operators import sequences as S
from dyelake.plans.adapters import over, view
from dyelake.plans.calls_queries import _FALSE
from dyelake.plans.registry import query

#: Labels as both engines read them: residue, label, dye, two failure rates; dyes with their channel.
LABELS = "SELECT * FROM (VALUES ('D', 'DE', 'dye1', 0.1D, 0.05D), ('E', 'DE', 'dye1', 0.1D, 0.05D), ('C', 'C', 'dye2', 0.2D, 0D), ('K', 'K', 'dye3', 0D, 0.1D)) t(aa, label_name, dye_name, p_failure_to_bind, p_failure_to_attach)"
DYES = "SELECT * FROM (VALUES (0, 'dye1', 'ch_z', 0.05D, 7000D, 0.2D, 0.01D), (1, 'dye2', 'ch_b', 0.1D, 6000D, 0.2D, 0.02D), (2, 'dye3', 'ch_z', 0.02D, 7000D, 0.2D, 0.01D)) t(place, dye_name, channel_name, p_failure, beta, sigma, p_bleach)"
CHANNELS = {"D": 0, "E": 0, "K": 0, "C": 1}
_D = lambda sql: re.sub(r"(\d)D\b", r"\1::DOUBLE", sql)

RESIDUES = "SELECT pep_i, substr(seq, CAST(i AS INT), 1) AS aa, CAST(i - 1 AS INT) AS pep_offset_in_pro FROM (SELECT pep_i, seq, unnest(range(1, length(seq) + 1)) AS i FROM pep_strings)"


def _residues(spark, sf_dir):
    """(pep_i, aa, pep_offset_in_pro): a row a residue."""
    strings = view(spark, sf_dir, "pep_strings")
    return strings.select("pep_i", F.posexplode(S.aa_tokens(F.col("seq")))).select("pep_i", F.col("col").alias("aa"), F.col("pos").alias("pep_offset_in_pro"))


@query(r"SELECT doc_id, length(sequence) AS n_residues, substr(sequence, length(sequence), 1) AS last_aa, md5(rtrim(regexp_replace(sequence, '(.{10})', '\1 ', 'g'))) AS spaced_md5 FROM specs WHERE length(sequence) > 0")
def tokens_and_join(spark, sf_dir):
    """F-1, F-2: residue tokens of every text's letters, and joined with a space after each ten."""
    specs = view(spark, sf_dir, "specs").withColumn("t", S.aa_tokens(F.col("sequence"))).filter(F.size("t") > 0)
    return specs.select("doc_id", F.size("t").cast("long").alias("n_residues"), F.element_at("t", -1).alias("last_aa"), F.md5(S.aa_join(F.col("t"), 10).cast("binary")).alias("spaced_md5"))


_AT = "substr(sequence, i{k}, 1)"
_P2, _P1, _N = "CASE WHEN i > 1 THEN substr(sequence, i - 1, 1) ELSE '' END", "substr(sequence, i, 1)", "substr(sequence, i + 1, 1)"
_TRYPSIN = f"""CASE WHEN {_P2} = 'R' AND {_P1} = 'R' AND {_N} IN ('H', 'R') THEN FALSE WHEN {_P2} = 'C' AND {_P1} = 'R' AND {_N} = 'K' THEN FALSE
WHEN {_P2} = 'C' AND {_P1} = 'K' AND {_N} IN ('H', 'Y') THEN FALSE WHEN {_P2} IN ('C', 'D') AND {_P1} = 'K' AND {_N} = 'D' THEN FALSE WHEN {_P2} = 'M' AND {_P1} = 'R' AND {_N} = 'P' THEN TRUE
WHEN {_P2} = 'W' AND {_P1} = 'K' AND {_N} = 'P' THEN TRUE WHEN {_P1} IN ('K', 'R') AND {_N} = 'P' THEN FALSE ELSE {_P1} IN ('K', 'R') END"""


def _cleave_sql(cond: str) -> str:
    return f"""WITH c AS (SELECT doc_id, sequence, i FROM (SELECT doc_id, sequence, unnest(range(1, length(sequence))) AS i FROM specs WHERE length(sequence) > 0) WHERE {cond}
UNION ALL SELECT doc_id, sequence, 0 FROM specs WHERE length(sequence) > 0),
p AS (SELECT doc_id, sequence, i AS pep_start, lead(i, 1, length(sequence)) OVER (PARTITION BY doc_id ORDER BY i) AS pep_stop FROM c)
SELECT doc_id, CAST(pep_start AS INT) AS pep_start, CAST(pep_stop AS INT) AS pep_stop, substr(sequence, pep_start + 1, pep_stop - pep_start) AS seqstr FROM p"""


def _cleaved(spark, sf_dir, proteases):
    return S.cleave(view(spark, sf_dir, "specs"), "doc_id", "sequence", proteases)


@query(_cleave_sql(_TRYPSIN))
def cleave_trypsin(spark, sf_dir):
    """F-3: every text's letters cleaved by trypsin, of eight rules."""
    return _cleaved(spark, sf_dir, ["trypsin"])


@query(_cleave_sql(f"{_P1} = 'K' OR {_P1} IN ('A', 'P') OR {_N} = 'D' OR ({_P1} = 'E' AND {_N} NOT IN ('P', 'E'))"))
def cleave_four_proteases(spark, sf_dir):
    """F-3: cleaved wherever one of four proteases cuts."""
    return _cleaved(spark, sf_dir, ["lysc", "endopro", "aspn", "gluc_ph4"])


def _rule(before: list[str], after: list[str]) -> str:
    """SQL: whether a rule's residues stand around the place after letter i."""
    at = [(r, f"substr(sequence, i - {len(before) - 1 - k}, 1)", f"i > {len(before) - 1 - k}") for k, r in enumerate(before)] + [(r, f"substr(sequence, i + {k + 1}, 1)", "TRUE") for k, r in enumerate(after)]
    return " AND ".join(f"{inside} AND contains('{r}', {x}) AND {x} <> ''" for r, x, inside in at if r)


def _cuts(protease: str) -> str:
    """SQL: whether a protease cuts after letter i; the last rule that fits decides."""
    return "CASE " + " ".join(f"WHEN {_rule(b, c)} THEN {keep}" for keep, b, c in reversed(S.PROTEASES[protease])) + " ELSE FALSE END"


@query(f"""WITH s AS (SELECT doc_id, sequence FROM specs WHERE length(sequence) > 0), i AS (SELECT doc_id, sequence, unnest(range(1, length(sequence))) AS i FROM s),
c AS ({" UNION ALL ".join(f"SELECT '{p}' AS scheme, doc_id, sequence, i FROM i WHERE {_cuts(p)}" for p in S.PROTEASES)} UNION ALL SELECT unnest({list(S.PROTEASES)}), doc_id, sequence, 0 FROM s),
p AS (SELECT scheme, doc_id, sequence, i AS pep_start, lead(i, 1, length(sequence)) OVER (PARTITION BY scheme, doc_id ORDER BY i) AS pep_stop FROM c)
SELECT scheme, doc_id, CAST(pep_start AS INT) AS pep_start, CAST(pep_stop AS INT) AS pep_stop, md5(substr(sequence, pep_start + 1, pep_stop - pep_start)) AS seq_md5 FROM p""")
def cleave_every_protease(spark, sf_dir):
    """F-3: every text's letters cleaved by each of the twelve proteases, in one pass."""
    out = S.cleave_each(view(spark, sf_dir, "specs"), "doc_id", "sequence", {p: [p] for p in S.PROTEASES})
    return out.select("scheme", "doc_id", "pep_start", "pep_stop", F.md5(F.col("seqstr").cast("binary")).alias("seq_md5"))


@query("""WITH n AS (SELECT max(pro_i) AS n FROM pros), s AS (SELECT pro_i, pro_id, pro_ptm_locs, concat('AC', upper(replace(replace(pro_id, '#', ''), 'lier', 'LIERKDE')), 'WRYTLLMNPQ') AS seq FROM pros)
SELECT pro_i, pro_id, seq, pro_ptm_locs, FALSE AS pro_is_decoy FROM s UNION ALL
SELECT CAST(pro_i + n AS INT), concat('rev-', pro_id), reverse(seq), array_to_string(list_sort(list_transform(list_filter(string_split(pro_ptm_locs, ';'), lambda x: x <> ''), lambda x: length(seq) - CAST(x AS INT) + 1)), ';'), TRUE FROM s, n WHERE pro_i > 0""")
def with_decoys(spark, sf_dir):
    """F-4, F-5, U-2: proteins and their reversed decoys, with the sites' places turned round."""
    seq = F.concat(F.lit("AC"), F.upper(F.replace(F.replace("pro_id", F.lit("#"), F.lit("")), F.lit("lier"), F.lit("LIERKDE"))), F.lit("WRYTLLMNPQ"))
    pros = view(spark, sf_dir, "pros").select("pro_i", "pro_id", "pro_ptm_locs", S.aa_tokens(seq).alias("tokens"))
    return S.with_decoys(pros).select("pro_i", "pro_id", F.array_join("tokens", "").alias("seq"), "pro_ptm_locs", "pro_is_decoy")


@query("""WITH p AS (SELECT pep_i, seq, list_filter([0, 2, 4, 5], lambda s: s < least(length(seq), 1 + pep_i % 8)) AS sites FROM pep_strings WHERE length(seq) > 0),
v AS (SELECT pep_i, seq, m, list_filter(sites, lambda s, k: (m >> CAST(k - 1 AS INT)) & 1 = 1) AS chosen FROM (SELECT *, unnest(range(1, 1 << len(sites))) AS m FROM p WHERE len(sites) BETWEEN 1 AND 3))
SELECT pep_i, CAST(row_number() OVER (PARTITION BY pep_i ORDER BY len(chosen), chosen) AS INT) AS variant,
array_to_string(list_transform(range(0, length(seq)), lambda i: concat(substr(seq, CAST(i + 1 AS INT), 1), CASE WHEN list_contains(chosen, i) THEN '[p]' ELSE '' END)), '') AS seqstr FROM v""")
def ptm_variants(spark, sf_dir):
    """F-6: all ways to modify each peptide, none where it has more than three sites."""
    strings = view(spark, sf_dir, "pep_strings").withColumn("tokens", S.aa_tokens(F.col("seq"))).filter(F.size("tokens") > 0)
    sites = F.filter(F.array(*map(F.lit, (0, 2, 4, 5))), lambda s: s < F.least(F.size("tokens"), 1 + F.col("pep_i") % 8))
    return S.ptm_variants(strings.select("pep_i", "tokens", sites.alias("sites")), 3).select("pep_i", "variant", F.array_join("tokens", "").alias("seqstr"))


_FLU = """fr AS (SELECT pep_i, i, CASE WHEN aa IN ('D', 'E', 'K') THEN '0' WHEN aa = 'C' THEN '1' ELSE '.' END AS c FROM (SELECT pep_i, pep_offset_in_pro AS i, aa FROM (""" + RESIDUES + """))),
f AS (SELECT pep_i, concat(rpad(coalesce(string_agg(c, '' ORDER BY i) FILTER (i < 5), ''), 5, ' '), ' ;', count(*) FILTER (c = '0' AND i >= 5), ',', count(*) FILTER (c = '1' AND i >= 5)) AS flustr,
count(*) FILTER (c <> '.') AS n_dyes_all_ch, greatest(count(*) FILTER (c = '0'), count(*) FILTER (c = '1')) AS n_dyes_max_any_ch FROM fr GROUP BY pep_i)"""


@query(f"WITH {_FLU} SELECT *, count(*) OVER (PARTITION BY flustr) AS flu_count FROM f")
def flu_info(spark, sf_dir):
    """A-13, F-8: fluorosequence, dye counts, and the number of peptides that share it."""
    return _flus(spark, sf_dir)


def _flus(spark, sf_dir):
    strings = view(spark, sf_dir, "pep_strings").withColumn("t", S.aa_tokens(F.col("seq"))).filter(F.size("t") > 0)
    number = lambda *aas: F.size(F.filter("t", lambda x: x.isin(*aas))).cast("long")
    a, b = number("D", "E", "K"), number("C")
    flus = strings.select("pep_i", S.flustr(F.col("t"), CHANNELS, 5, 2).alias("flustr"), (a + b).alias("n_dyes_all_ch"), F.greatest(a, b).alias("n_dyes_max_any_ch"))
    # Common fluorosequences are counted with partial sums and joined back; a window would gather each in one task.
    return flus.join(flus.groupBy("flustr").agg(F.count(F.lit(1)).alias("flu_count")), "flustr")


@query(f"""WITH fr AS (SELECT pep_i, pep_offset_in_pro AS i, CASE WHEN aa IN ('D', 'E', 'K') THEN 0 WHEN aa = 'C' THEN 1 END AS c FROM ({RESIDUES}))
SELECT pep_i, {", ".join(f"CAST(count(*) FILTER (c = {c} AND i {op} 5) AS INT) AS n_{name}_ch_{c}" for name, op in (("head", "<"), ("tail", ">=")) for c in (0, 1))},
CAST(count(c) FILTER (i < 5) AS INT) AS n_head_all_ch, CAST(count(c) FILTER (i >= 5) AS INT) AS n_tail_all_ch, CAST(count(c) AS INT) AS n_dyes_all_ch, CAST(greatest(count(*) FILTER (c = 0), count(*) FILTER (c = 1)) AS INT) AS n_dyes_max_any_ch FROM fr GROUP BY pep_i""")
def flu_counts(spark, sf_dir):
    """A-13: dye counts of head and tail by channel."""
    strings = view(spark, sf_dir, "pep_strings").withColumn("t", S.aa_tokens(F.col("seq"))).filter(F.size("t") > 0)
    return strings.select("pep_i", *(c.alias(n) for n, c in S.flu_counts(F.col("t"), CHANNELS, 5, 2).items()))


_PLAIN = "SELECT pep_i, pro_i, pep_start, pep_stop, seq, list_filter([0, 2, 4, 5], lambda s: s < least(length(seq), 1 + pep_i % 8)) AS sites FROM pep_strings JOIN peps USING (pep_i) WHERE length(seq) > 0"


@query(f"""WITH p AS ({_PLAIN}), v AS (SELECT *, list_filter(sites, lambda s, k: (m >> CAST(k - 1 AS INT)) & 1 = 1) AS chosen FROM (SELECT *, unnest(range(1, 1 << len(sites))) AS m FROM p WHERE len(sites) BETWEEN 1 AND 3))
SELECT pep_i, pro_i, pep_start, pep_stop, seq AS seqstr, FALSE AS is_ptm FROM p UNION ALL
SELECT CAST((SELECT max(pep_i) FROM p) + row_number() OVER (ORDER BY pep_i, len(chosen), chosen) AS INT), pro_i, pep_start, pep_stop,
array_to_string(list_transform(range(0, length(seq)), lambda i: concat(substr(seq, CAST(i + 1 AS INT), 1), CASE WHEN list_contains(chosen, i) THEN '[p]' ELSE '' END)), ''), TRUE FROM v""")
def with_ptm_peps(spark, sf_dir):
    """U-2: peptides and all their modified forms, numbered on."""
    strings = view(spark, sf_dir, "pep_strings").withColumn("tokens", S.aa_tokens(F.col("seq"))).filter(F.size("tokens") > 0)
    sites = F.filter(F.array(*map(F.lit, (0, 2, 4, 5))), lambda s: s < F.least(F.size("tokens"), 1 + F.col("pep_i") % 8))
    rows = strings.select("pep_i", "tokens", sites.alias("sites")).join(view(spark, sf_dir, "peps"), "pep_i")
    return S.with_ptm_peps(rows, 3).select("pep_i", "pro_i", "pep_start", "pep_stop", F.array_join("tokens", "").alias("seqstr"), "is_ptm")


@query("""WITH s AS (SELECT pep_i, pep_start, list_transform(range(0, length(seq)), lambda i: concat(substr(seq, CAST(i + 1 AS INT), 1), CASE WHEN (i + pep_i) % 3 = 0 THEN '[p]' ELSE '' END)) AS t,
list_transform(range(0, length(seq)), lambda i: CAST(i + pep_start + 1 AS INT)) AS sites FROM pep_strings JOIN peps USING (pep_i) WHERE length(seq) > 0)
SELECT pep_i, array_to_string(list_filter(sites, lambda p: contains(t[p - pep_start], '[')), ';') AS active FROM s""")
def active_sites(spark, sf_dir):
    """F-7: the places of the protein at which a peptide's residue is marked as modified."""
    rows = view(spark, sf_dir, "pep_strings").withColumn("t", S.aa_tokens(F.col("seq"))).filter(F.size("t") > 0).join(view(spark, sf_dir, "peps"), "pep_i")
    marked = F.transform("t", lambda x, i: F.when((i + F.col("pep_i")) % 3 == 0, F.concat(x, F.lit("[p]"))).otherwise(x))
    rows = rows.withColumn("marked", marked).withColumn("sites", F.sequence(F.col("pep_start") + 1, F.col("pep_start") + F.size("t")))
    return rows.select("pep_i", F.array_join(F.transform(J.active_sites(F.col("marked"), F.col("sites"), F.col("pep_start")), lambda x: x.cast("string")), ";").alias("active"))


_SUMMARY = """SELECT {kind} AS kind, (SELECT count(*) FROM p) AS n_pros, (SELECT count(*) FILTER (pro_is_decoy) FROM p) AS n_decoy_pros, count(*) AS n_peps, count(*) FILTER (NOT pro_is_decoy) AS n_real_peps,
count(*) FILTER (pro_is_decoy) AS n_decoy_peps, (SELECT count(DISTINCT seq) FROM pep_strings WHERE pep_i IN (SELECT pep_i FROM o)) AS n_unique FROM o"""


@query(f"""SELECT * FROM (WITH p AS (SELECT * FROM pros WHERE pro_i > 0), o AS (SELECT * FROM peps JOIN p USING (pro_i) WHERE pep_i > 0) {_SUMMARY.format(kind="'all'")})
UNION ALL SELECT * FROM (WITH p AS (SELECT * FROM pros WHERE pro_i > 0 AND pro_report > 0), o AS (SELECT * FROM peps JOIN p USING (pro_i) WHERE pep_i > 0) {_SUMMARY.format(kind="'reported'")})""")
def prep_summary(spark, sf_dir):
    """A-18: proteins, decoys, peptides and different sequences, of all and of reported proteins."""
    strings = view(spark, sf_dir, "pep_strings").select("pep_i", F.col("seq").alias("seqstr"))
    of = lambda reported, kind: J.prep_summary(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), strings, reported).withColumn("kind", F.lit(kind))
    return of(False, "all").unionByName(of(True, "reported"))


@query("SELECT pep_i, substr(seq, 2, 1) = 'P' AS p2, length(seq) AS seqlen FROM pep_strings")
def p2_and_length(spark, sf_dir):
    """F-9: whether the second residue is proline, and the length."""
    t = S.aa_tokens(F.col("seq"))
    return view(spark, sf_dir, "pep_strings").select("pep_i", F.coalesce(F.get(t, F.lit(1)) == "P", F.lit(False)).alias("p2"), F.size(t).cast("long").alias("seqlen"))


@query("SELECT pep_i, seq AS seqstr, CAST(length(seq) AS INT) AS seqlen FROM pep_strings WHERE length(seq) > 0")
def pep_strings(spark, sf_dir):
    """A-12: residues joined back to sequences."""
    return J.pep_strings(_residues(spark, sf_dir))


@query("SELECT pep_i, 0 AS pep_start, CAST(length(seq) AS INT) AS pep_stop FROM pep_strings WHERE length(seq) > 0")
def peptide_bounds(spark, sf_dir):
    """W-2: least and greatest offset of each peptide."""
    return J.bounds(_residues(spark, sf_dir))


@query("SELECT pro_i, pep_i, row_number() OVER (ORDER BY pro_i, pep_start, pep_i) - 1 AS new_i FROM peps")
def global_index(spark, sf_dir):
    """W-1: dense peptide numbers over all proteins."""
    return S.global_index(view(spark, sf_dir, "peps"), "pro_i", ["pep_start", "pep_i"], "new_i").select("pro_i", "pep_i", "new_i")


@query("SELECT min(doc_id) AS doc_id, md5(sequence) AS h FROM specs GROUP BY sequence")
def drop_duplicate_proteins(spark, sf_dir):
    """U-5: one protein of each sequence and name, the first by name's number."""
    specs = view(spark, sf_dir, "specs").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("name"), "sequence", "doc_id")
    return S.drop_duplicate_proteins(specs).select("doc_id", F.md5(F.col("sequence").cast("binary")).alias("h"))


@query("SELECT md5(sequence) AS h, count(*) AS n FROM specs GROUP BY sequence HAVING count(*) > 1")
def duplicate_sequences(spark, sf_dir):
    """U-5: sequences of several proteins."""
    return S.duplicates(view(spark, sf_dir, "specs"), "sequence").select(F.md5(F.col("sequence").cast("binary")).alias("h"), "n")


@query("SELECT pro_id, abundance / (SELECT min(abundance) FROM pros WHERE abundance > 0) AS abundance FROM pros")
def normalize_abundance(spark, sf_dir):
    """F-10: abundances relative to the smallest."""
    return S.normalize_abundance(view(spark, sf_dir, "pros").select("pro_id", "abundance"))


@query("SELECT p_partkey, regexp_replace(lower(concat(p_brand, '_', p_name, '_', p_type)), '[^0-9a-z_]+', '_', 'g') AS name FROM part")
def run_names(spark, sf_dir):
    """F-15: names of runs, safe in paths."""
    return over(spark, sf_dir, "SELECT * FROM part").select("p_partkey", S.run_name(F.col("p_brand"), F.col("p_name"), F.col("p_type")).alias("name"))


@query("SELECT concat(p_partkey, ':', p_name) AS line, CAST(p_partkey AS VARCHAR) AS name, upper(replace(p_name, ' ', '')) AS sequence FROM part")
def inline_sequences(spark, sf_dir):
    """S-3: name:SEQUENCE lines."""
    from dyelake.sources.proteins import parse_inline

    lines = over(spark, sf_dir, "SELECT concat(CAST(p_partkey AS STRING), ':', p_name) AS line FROM part")
    return parse_inline(lines).select("line", "name", F.array_join(S.aa_tokens(F.col("sequence")), "").alias("sequence"))


@query("SELECT pro_i, pro_id, pro_report, pro_ptm_locs FROM pros WHERE pro_ptm_locs <> '' AND NOT pro_is_decoy AND pro_report > 0")
def pros_flags(spark, sf_dir):
    """P-4: proteins in the report, with sites, that are no decoys."""
    rows = view(spark, sf_dir, "pros")
    for flag in ("in_report", "with_ptms", "no_decoys"):
        rows = J.pros_where(rows, flag)
    return rows.select("pro_i", "pro_id", "pro_report", "pro_ptm_locs")


@query("SELECT pro_i, pro_id, CASE WHEN pro_i % 5 = 1 THEN 7 ELSE pro_report END AS pro_report FROM pros")
def set_pros_of_interest(spark, sf_dir):
    """P-5: the report flag overwritten by id."""
    pros = view(spark, sf_dir, "pros").select("pro_i", "pro_id", "pro_report")
    return J.set_by_id(pros, pros.filter("pro_i % 5 = 1").select("pro_id", F.lit(7).alias("value")), "pro_report")


@query("SELECT pro_i, pro_id, p_retailprice AS price FROM pros LEFT JOIN part ON p_partkey + 1 = pro_i")
def pros_with_abundance(spark, sf_dir):
    """J-1: proteins with a value by key, kept where there is none."""
    prices = over(spark, sf_dir, "SELECT CAST(p_partkey + 1 AS INT) AS pro_i, p_retailprice AS price FROM part")
    return view(spark, sf_dir, "pros").select("pro_i", "pro_id").join(prices, "pro_i", "left")


@query("SELECT pro_i, pro_id, pep_i, pep_start, pep_stop FROM pros LEFT JOIN peps USING (pro_i)")
def pros_peps(spark, sf_dir):
    """J-2: proteins with their peptides."""
    return J.pros_peps(view(spark, sf_dir, "pros").select("pro_i", "pro_id"), view(spark, sf_dir, "peps"))


@query("SELECT pro_i, pep_i, pep_start, pep_stop FROM pros JOIN peps USING (pro_i) WHERE NOT pro_is_decoy")
def peps_no_decoys(spark, sf_dir):
    """J-3: peptides of real proteins."""
    return J.peps_of(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), "no_decoys")


@query(f"SELECT pro_i, pep_i, aa, pep_offset_in_pro FROM ({RESIDUES}) r JOIN peps USING (pep_i) JOIN pros USING (pro_i) WHERE NOT pro_is_decoy")
def pepseqs_no_decoys(spark, sf_dir):
    """J-4: residues of real proteins' peptides."""
    own = J.peps_of(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), "no_decoys")
    return J.pepseqs_of(own, view(spark, sf_dir, "pep_strings").select("pep_i", S.aa_tokens(F.col("seq")).alias("tokens"))).select("pro_i", "pep_i", "aa", "pep_offset_in_pro")


@query(f"WITH {_FLU}, g AS (SELECT *, count(*) OVER (PARTITION BY flustr) AS flu_count FROM f) SELECT pep_i, pro_id, seq AS seqstr, flustr, flu_count, substr(seq, 2, 1) = 'P' AS p2 FROM peps JOIN pros USING (pro_i) JOIN pep_strings USING (pep_i) JOIN g USING (pep_i)")
def peps_wide(spark, sf_dir):
    """J-5, J-8: the wide peptide table: protein, sequence, fluorosequence, proline flag."""
    strings = J.pep_strings(_residues(spark, sf_dir)).select("pep_i", "seqstr")
    wide = view(spark, sf_dir, "peps").join(view(spark, sf_dir, "pros"), "pro_i").join(strings, "pep_i").join(_flus(spark, sf_dir), "pep_i")
    return wide.select("pep_i", "pro_id", "seqstr", "flustr", "flu_count", (F.substring("seqstr", 2, 1) == "P").alias("p2"))


@query("SELECT run_i, true_pep_i, pred_pep_i, score, pro_i, pro_id, pep_start, pep_stop FROM calls LEFT JOIN peps ON pep_i = true_pep_i LEFT JOIN pros USING (pro_i)")
def calls_with_true_protein(spark, sf_dir):
    """J-6: every call with the protein and place of what it truly is."""
    rows = J.calls_pros(view(spark, sf_dir, "calls"), view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), "true")
    return rows.select("run_i", "true_pep_i", "pred_pep_i", "score", "pro_i", "pro_id", "pep_start", "pep_stop")


@query("SELECT pro_id, count(*) AS n, round(avg(score), 9) AS score FROM calls LEFT JOIN peps ON pep_i = pred_pep_i LEFT JOIN pros USING (pro_i) GROUP BY pro_id")
def calls_by_called_protein(spark, sf_dir):
    """J-6: calls with the called protein."""
    rows = J.calls_pros(view(spark, sf_dir, "calls"), view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), "pred")
    return rows.groupBy("pro_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 9).alias("score"))


@query("SELECT DISTINCT pep_i, seq FROM calls JOIN pep_strings ON pep_i = pred_pep_i")
def called_peps(spark, sf_dir):
    """J-7: distinct called peptides with their sequences."""
    return J.called_peps(view(spark, sf_dir, "calls"), view(spark, sf_dir, "pep_strings"))


_SITES = "list_filter(list_transform(list_filter(string_split(pro_ptm_locs, ';'), lambda x: x <> ''), lambda x: CAST(x AS INT)), lambda p: p - 1 >= pep_start AND p - 1 < pep_stop)"


@query(f"SELECT pro_i, pro_id, pep_i, pep_start, pep_stop, CAST(len(s) AS INT) AS n_pep_ptms, array_to_string(s, ';') AS pep_ptms FROM (SELECT *, {_SITES} AS s FROM peps JOIN pros USING (pro_i) WHERE NOT pro_is_decoy) WHERE len(s) > 0")
def peps_ptms(spark, sf_dir):
    """J-19, F-7: peptides with the sites that lie in them."""
    return J.peps_ptms(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"))


@query(f"SELECT pro_i, pep_i, unnest({_SITES}) AS ptm FROM peps JOIN pros USING (pro_i) WHERE pro_report > 0 AND NOT pro_is_decoy")
def peps_ptms_to_rows(spark, sf_dir):
    """J-19: a row a site, of reported proteins."""
    return J.peps_ptms(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), in_report=True, to_rows=True).select("pro_i", "pep_i", "ptm")


_LABEL = f"""l AS (SELECT aa, label_name, a.dye_name, CASE channel_name WHEN 'ch_z' THEN 0 ELSE 1 END AS ch_i, (1 - p_failure_to_bind) * (1 - p_failure_to_attach) * (1 - p_failure) AS p_bright FROM ({_D(LABELS)}) a JOIN ({_D(DYES)}) b ON a.dye_name = b.dye_name)"""


@query(f"WITH {_LABEL} SELECT pep_i, pep_offset_in_pro, aa, CAST(ch_i AS INT) AS ch_i, round(p_bright, 9) AS p_bright FROM ({RESIDUES}) r LEFT JOIN l USING (aa)")
def label_pcbs(spark, sf_dir):
    """J-9, J-10: residues with the channel and brightness chance of their label."""
    labels = J.label_table(spark.sql(LABELS), spark.sql(DYES))
    return J.label_pcbs(_residues(spark, sf_dir), labels).withColumn("p_bright", F.round("p_bright", 9))


_SHARED = f"""{_FLU.replace('f AS', 'fl AS')}, w AS (SELECT pep_i, pro_id, flustr FROM peps JOIN pros USING (pro_i) JOIN fl USING (pep_i)),
h AS (SELECT flustr, count(*) AS n, sum(CAST(concat('0x', substr(md5(pro_id), 1, 15)) AS BIGINT)) AS a, sum(CAST(concat('0x', substr(md5(pro_id), 16, 15)) AS BIGINT)) AS b FROM (SELECT DISTINCT flustr, pro_id FROM w) GROUP BY 1),
s AS (SELECT flustr, md5(concat_ws(':', n, a, b)) AS flu_set, n AS n_flu_pros FROM h)"""


def _report_flus(spark, sf_dir):
    """(pep_i, pro_id), (pep_i, flustr)."""
    return view(spark, sf_dir, "peps").join(view(spark, sf_dir, "pros"), "pro_i").select("pep_i", "pro_id"), _flus(spark, sf_dir).select("pep_i", "flustr")


@query(f"""WITH {_FALSE}, {_SHARED}, l AS (SELECT flustr, string_agg(DISTINCT pro_id, ',' ORDER BY pro_id) AS flu_pros FROM w GROUP BY 1)
SELECT f.pep_i, false_type, false_i, f.false_pep_i, false_weight, w.pro_id, w.flustr, flu_set, n_flu_pros, flu_pros, v.pro_id AS false_pro_id, v.flustr AS false_flustr
FROM f JOIN w ON w.pep_i = f.pep_i JOIN s USING (flustr) JOIN l USING (flustr) LEFT JOIN w v ON v.pep_i = f.false_pep_i""")
def falses_flus(spark, sf_dir):
    """J-17: false calls with both peptides' proteins and fluorosequences, and the proteins that share the fluorosequence."""
    return J.falses_flus(C.false_calls(C.conf_mat(view(spark, sf_dir, "calls")), 3), *_report_flus(spark, sf_dir))[0]


@query(f"WITH {_SHARED} SELECT DISTINCT flu_set AS set_id, pro_id FROM s JOIN w USING (flustr)")
def flu_set_members(spark, sf_dir):
    """J-17: the proteins of each set that shares a fluorosequence."""
    return J.flu_sets(*_report_flus(spark, sf_dir))[1]


@query(f"""WITH {_FALSE}, p AS (SELECT pep_i, array_to_string({_SITES}, ';') AS pep_ptms FROM peps JOIN pros USING (pro_i))
SELECT f.*, pep_ptms, length(seq) AS seqlen, substr(seq, 2, 1) = 'P' AS p2 FROM f JOIN p USING (pep_i) JOIN pep_strings USING (pep_i)""")
def falses_ptm_info(spark, sf_dir):
    """J-18: false calls with the peptide's sites, length and proline flag."""
    ptms = J.peps_ptms(view(spark, sf_dir, "pros"), view(spark, sf_dir, "peps"), decoys=True, ptm_peps_only=False).select("pep_i", "pep_ptms")
    strings = view(spark, sf_dir, "pep_strings").select("pep_i", F.length("seq").cast("long").alias("seqlen"), (F.substring("seq", 2, 1) == "P").alias("p2"))
    return C.false_calls(C.conf_mat(view(spark, sf_dir, "calls")), 3).join(ptms, "pep_i").join(strings, "pep_i")
