"""Near-duplicate groups around a template: classes that their centre doesn't take in."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.near_dedup import loose_pairs, near_duplicates


def variants(seed, n):
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for d in range(1, n):
        own = list(base if rng.random() < 0.6 else rows[rng.randrange(len(rows))][1].split())
        for _ in range(rng.randrange(8)):
            i, kind = rng.randrange(len(own)), rng.random()
            if kind < 0.4:
                own[i] = f"x{rng.randrange(8)}"
            elif kind < 0.7:
                own[i] = f"x{rng.randrange(10**6)}"
            elif kind < 0.85:
                del own[i]
            else:
                own.insert(i, f"y{rng.randrange(5)}")
        rows.append((d, " ".join(own)))
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_no_link_is_lost(spark, seed):
    rows = variants(seed, 220)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == brute.near_duplicates(rows, 3, 85)


def test_many_loose_classes_of_one_template_make_few_pairs(spark):
    # Each class replaces 8 of 64 elements of the template by its own: no two are linked, and pairs of all are 2e8.
    n, words = 20_000, 64
    import numpy as np

    rng = np.random.default_rng(3)
    sets = [(0, np.arange(words, dtype=np.uint64))]
    for i in range(1, n):
        own = np.arange(words, dtype=np.uint64)
        own[rng.choice(words, 8, replace=False)] = rng.integers(10**6, 2**62, 8)
        sets.append((i, np.sort(own)))
    held = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets], "doc_id long, shingles binary")
    around = spark.range(1, n).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"), F.lit(words).cast("long").alias("n"), F.lit(16).cast("long").alias("apart"), F.lit(True).alias("loose"), F.col("id").alias("of_b"))
    assert loose_pairs(around, held, 85).count() < 20 * n
    # Two that share all they have of their own are found.
    twin = dict(sets)
    twin[7] = np.sort(np.concatenate((sets[5][1][:-1], np.array([2**62], np.uint64))))
    some = [5, 7, 9]
    held = spark.createDataFrame([(0, bytearray(twin[0].tobytes()))] + [(i, bytearray(twin[i].tobytes())) for i in some], "doc_id long, shingles binary")
    apart = {i: len(np.setxor1d(twin[0], twin[i])) for i in some}
    around = spark.createDataFrame([(0, i, words, apart[i], True, i) for i in some], "a long, b long, n long, apart long, loose boolean, of_b long")
    assert [tuple(r) for r in loose_pairs(around, held, 85).collect()] == [(5, 7)]


def letters(n, seed=7, places=14, options=4):
    """Letters from one form: at each place one of a few words."""
    rng = random.Random(seed)
    rows = []
    for d in range(n):
        own = []
        for p in range(places):
            own += [f"form{p}a", f"form{p}b", f"form{p}c", f"fill{p}x{rng.randrange(options)}", f"form{p}d", f"form{p}e", f"form{p}f"]
        rows.append((d, " ".join(own)))
    return rows


def test_no_link_of_form_letters_is_lost(spark, monkeypatch):
    from dyelake.llm import near_dedup

    used = []
    plain = near_dedup.long_bands
    monkeypatch.setattr(near_dedup, "long_bands", lambda sets, percent: (used.append(sets.count()), plain(sets, percent))[1])
    rows = letters(600)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85).collect()}
    want = brute.near_duplicates(rows, 3, 85)
    assert got == want and used[0] > 500 and 1 < len({c for _, c in want.values()}) < 600


def test_form_letters_make_fewer_pairs_than_bands(spark, monkeypatch):
    """As many pairs a class as there are long bands at most, or fewer by these; all pairs are three times as many here."""
    from dyelake.llm import near_dedup

    made = []
    plain = near_dedup.loose_pairs
    monkeypatch.setattr(near_dedup, "loose_pairs", lambda *args: (lambda out: (made.append(out.count()), out)[1])(written(plain(*args))))
    near_duplicates(spark.createDataFrame(letters(1200), "doc_id long, text string").repartition(4), 3, 85).count()
    assert 0 < made[0] < near_dedup.band_shape(85)[1] * 1200
