"""Every stage on odd rows, and run() against a plain form of all five."""

from collections import Counter

import brute
import corpus_pipeline as P
import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_decontaminate import words

from dyelake.llm import sql, stages
from dyelake.sources.tables import table

SCHEMA = "doc_id long, text string, lang string, source string, k string, size int, term string, `key of the mix` int, a int, b int"


def odd_rows():
    long = " ".join(f"wort{i * 7919 % 3001}" for i in range(20_000))
    near = " ".join(f"nah{i}" for i in range(200))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (5, long, "de", "b"), (6, long + " ende", "de", None), (8, near, "en", "a"), (8, near, "en", "a"), (None, near + " mehr", "en", None), (None, None, None, None), (9, "éé", "fr", "c")]
    return [(*r, "clash", 1, "t", 2, 3, 4) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, " ".join(f"wort{i * 7919 % 3001}" for i in range(50, 61))), (None, None)], "item_id long, text string")


def test_odd_rows_of_every_stage(odd, bench):
    known = stages.known_language(odd)
    assert known.columns == odd.columns
    assert sorted(map(str, (r["doc_id"] for r in known.collect()))) == sorted(map(str, [5, 6, 8, 8, None, 9]))
    single = stages.one_of_each_group(odd)
    assert single.columns == odd.columns
    assert sorted(map(str, (r["doc_id"] for r in single.collect()))) == sorted(map(str, [1, 2, 3, 5, 8, None, 9]))
    clean = stages.uncontaminated(odd, bench)
    assert clean.columns == odd.columns
    assert sorted(map(str, (r["doc_id"] for r in clean.collect()))) == sorted(map(str, [1, 2, 3, 8, 8, None, None, 9]))
    assert stages.uncontaminated(odd, bench.limit(0)).count() == odd.count()
    mixed = stages.to_target_weights(odd)
    assert mixed.columns == odd.columns
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert times[1] == times[2] == times[3] == 1


def test_empty_tables(odd, bench):
    none = odd.limit(0)
    for out in (stages.known_language(none), stages.one_of_each_group(none), stages.uncontaminated(none, bench), stages.to_target_weights(none)):
        assert out.columns == odd.columns and out.count() == 0


def test_without_languages_only_letters_count(odd):
    out = stages.known_language(odd.withColumn("lang", F.lit(None).cast("string")))
    assert sorted(map(str, (r["doc_id"] for r in out.collect()))) == sorted(map(str, [5, 6, 8, 8, None, 9]))


def test_rows_keep_their_texts_and_get_places(odd):
    copies = odd.unionByName(odd.filter("doc_id = 8")).withColumn("shard", F.lit("clash"))
    out = stages.sharded(copies, 3)
    assert out.columns == [*(c if c not in ("size", "shard") else f"{c} of the document" for c in copies.columns), "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in copies.collect())
    assert all(r["size"] == len((r["text"] or "").encode()) + 16 for r in rows) and len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert stages.sharded(odd.limit(0), 3).count() == 0


def test_map_columns(odd, bench):
    docs = odd.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("deep", F.array(F.col("m")))
    for out in (stages.known_language(docs), stages.one_of_each_group(docs), stages.uncontaminated(docs, bench), stages.to_target_weights(docs)):
        assert out.columns == docs.columns and out.count() > 0
    assert stages.one_of_each_group(docs).count() == stages.one_of_each_group(odd).count() and stages.sharded(docs, 2).count() == docs.count()


def test_run_against_a_plain_form(spark, tmp_path):
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    left = {d for d, r in docs.items() if any(c.isalpha() for c in r["text"] or "")}
    left = {d for d, (_, c) in brute.near_duplicates([(d, docs[d]["text"]) for d in left], 5, 80).items() if c == d}
    windows: dict = {}
    for r in table(spark, SF, "benchmark").collect():
        own = words(r["text"])
        for i in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(min(10, len(own)), set()).add(tuple(own[i : i + 10]))
    held = lambda own: any(tuple(own[i : i + n]) in some for n, some in windows.items() for i in range(len(own) - n + 1))
    left = sorted(d for d in left if not held(words(docs[d]["text"])))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(d, docs[d]["text"], docs[d]["source"]) for d in left])
    names = [c[0] for c in con.execute(sql.OP1).description]
    times = {}
    for r in con.execute(sql.OP1).fetchall():
        r = dict(zip(names, r, strict=True))
        times[r["doc_id"]] = int(r["taken"] / r["size"] + 0.5) if r["size"] else 1
    out = P.run(spark, SF).collect()
    assert Counter(r["doc_id"] for r in out) == Counter({d: n for d, n in times.items() if n})
    shards: dict = {}
    for r in out:
        assert r["size"] == len(docs[r["doc_id"]]["text"].encode()) + 16 and r["text"] == docs[r["doc_id"]]["text"]
        shards.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert all(sorted(s for s, _ in x) == list(range(len(x))) for x in shards.values()) and max(shards) < P.SHARDS
