"""Sequences against plain walks over residues."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from dyelake.operators import sequences as S
from dyelake.sources import proteins


def fits(rule, seq, at):
    _, before, after = rule
    near = [seq[at - len(before) + i] if at - len(before) + i >= 0 else None for i in range(len(before))]
    far = [seq[at + i] if at + i < len(seq) else None for i in range(len(after))]
    return all(x is not None and (not own or x in own) for x, own in zip(near + far, before + after, strict=True))


def plain_cleave(seq, names):
    """Peptides between cuts: at each place the last rule that fits decides."""
    cuts = [0]
    for at in range(1, len(seq)):
        for name in names:
            said = [rule[0] for rule in S.PROTEASES[name] if fits(rule, seq, at)]
            if said and said[-1]:
                cuts.append(at)
                break
    return [seq[a:b] for a, b in itertools.pairwise([*cuts, len(seq)])]


@pytest.mark.parametrize("names", [*([n] for n in S.PROTEASES), ["trypsin", "cnbr"], ["gluc_ph8", "ntcb", "argc"], []])
def test_cleave(spark, names):
    rng = random.Random(len(names))
    seqs = ["".join(rng.choice("ACDEGHKMPRWY") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    out = S.cleave(spark.createDataFrame(list(enumerate(seqs)), "k int, s string"), "k", "s", names).orderBy("k", "pep_start").collect()
    for k, seq in enumerate(seqs):
        own = [r for r in out if r["k"] == k]
        assert [r["seqstr"] for r in own] == plain_cleave(seq, names)
        assert all(seq[r["pep_start"] : r["pep_stop"]] == r["seqstr"] for r in own)


def test_decoys(spark):
    pros = [(0, "nul", ["."], ""), (5, "lone", list("MKW"), ""), (8, "sites", list("PQRSTVY"), "2;3;7")]
    out = {r["pro_id"]: r for r in S.with_decoys(spark.createDataFrame(pros, "pro_i int, pro_id string, tokens array<string>, pro_ptm_locs string")).collect()}
    assert len(out) == 5
    for i, name, tokens, sites in pros[1:]:
        decoy = out[f"rev-{name}"]
        assert (decoy["pro_i"], decoy["tokens"], decoy["pro_is_decoy"]) == (i + 8, tokens[::-1], True)
        # A site marks the same residue as before.
        moved = [int(x) for x in decoy["pro_ptm_locs"].split(";") if x]
        assert sorted(decoy["tokens"][m - 1] for m in moved) == sorted(tokens[int(x) - 1] for x in sites.split(";") if x) and moved == sorted(moved)


def test_shuffled_decoys(spark):
    pros = spark.createDataFrame([(3, "x", list("ACDEFGHIKL"), "")], "pro_i int, pro_id string, tokens array<string>, pro_ptm_locs string")
    (one,) = S.with_decoys(pros, "shuffle").filter("pro_is_decoy").collect()
    assert one["pro_id"] == "shu-x" and sorted(one["tokens"]) == list("ACDEFGHIKL") and one["tokens"] != list("ACDEFGHIKL")
    assert one == S.with_decoys(pros.repartition(3), "shuffle").filter("pro_is_decoy").first()
    with pytest.raises(Exception, match="can't have"):
        S.with_decoys(pros.withColumn("pro_ptm_locs", F.lit("1")), "shuffle").collect()


def test_ptm_variants(spark):
    peps = [(1, list("GHIKL"), [1, 2, 4]), (2, list("MNP"), [0]), (3, list("QRSTVW"), [0, 1, 2, 3]), (4, list("Y"), [])]
    out = S.ptm_variants(spark.createDataFrame(peps, "pep_i int, tokens array<string>, sites array<int>"), 3).orderBy("pep_i", "variant").collect()
    want = []
    for i, tokens, sites in peps:
        chosen = [c for n in range(1, len(sites) + 1) for c in itertools.combinations(sites, n)] if len(sites) <= 3 else []
        want += [(i, v + 1, "".join(t + "[p]" * (k in c) for k, t in enumerate(tokens))) for v, c in enumerate(chosen)]
    assert [(r["pep_i"], r["variant"], "".join(r["tokens"])) for r in out] == want


def test_tokens(spark):
    df = spark.createDataFrame([("mk (left (out) here) w[x]\ty",)], "s string")
    assert df.select(S.aa_tokens(F.col("s"))).first()[0] == ["M", "K", "W[X]", "Y"]
    for bad in ("M-K", "M[K", "[x]M"):
        with pytest.raises(Exception, match="not a sequence"):
            spark.createDataFrame([(bad,)], "s string").select(S.aa_tokens(F.col("s"))).collect()


def test_numbers_by_range(spark):
    rows = [(random.Random(i).randrange(10**6), i) for i in range(500)]
    out = S.numbered_by_range(spark.createDataFrame(rows, "a int, b int").repartition(7), ["a", "b"], "n").collect()
    assert [(r["a"], r["b"]) for r in sorted(out, key=lambda r: r["n"])] == sorted(rows) and sorted(r["n"] for r in out) == list(range(500))


def test_limit_peptides(spark):
    peps = spark.range(40).select(F.col("id").cast("int").alias("pep_i"))
    out = {r["pep_i"] for r in S.limit_peptides(peps, 7).collect()}
    assert len(out) == 8 and 0 in out and out == {r["pep_i"] for r in S.limit_peptides(peps.repartition(5), 7).collect()}


def test_fasta_and_csv(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">tr|Q77|protein of some sort\nMKW\nYY\n\n>plain words here\nGG\n")
    assert sorted(tuple(r) for r in proteins.read_fasta(spark, str(tmp_path / "a.fasta")).collect()) == [("Q77", "MKWYY"), ("plain", "GG")]
    (tmp_path / "a.csv").write_text("Abundance, Seq ,Name\n7, MKW, low\n 30,GGY,high \n")
    assert [(r["name"], r["sequence"], r["ptm_locs"], r["report"]) for r in proteins.read_protein_csv(spark, str(tmp_path / "a.csv")).collect()] == [("high", "GGY", "", 0), ("low", "MKW", "", 0)]
    (tmp_path / "b.csv").write_text("Name,Seq\ntwice,MKW\ntwice,GGY\n")
    with pytest.raises(ValueError, match="repeated name"):
        proteins.read_protein_csv(spark, str(tmp_path / "b.csv"))
