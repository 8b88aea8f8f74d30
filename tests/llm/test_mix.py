"""Mixing: shards and blocks of the tree, odd rows."""

from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from dyelake.llm import mixing, sql
from dyelake.sources.tables import table


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def values(rows, columns):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in rows), key=repr)


def test_every_piece_as_sql_deals_it(docs):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    want = con.execute(sql.OP1)
    columns = [c[0] for c in want.description]
    assert values(mixing.digest(mixing.plan_mix(docs)).collect(), columns) == values([dict(zip(columns, r, strict=True)) for r in want.fetchall()], columns)


def test_shards_have_what_the_tree_drew(docs):
    quota = mixing.quotas(mixing.targets(mixing.sizes(docs)))
    drawn = {(r["shard"], r["s"]): r["n_blocks"] for r in mixing.splitting_tree(quota).collect()}
    rows = mixing.plan_mix(docs).collect()
    blocks, owner, words = defaultdict(set), {}, Counter()
    for r in rows:
        s = "=" + r["source"]
        assert sum(p["words"] for p in r["pieces"]) == r["taken"]
        for p in r["pieces"]:
            blocks[p["shard"], s].add(p["block"])
            words[s, p["block"]] += p["words"]
            # Blocks are disjoint: one shard has each.
            assert owner.setdefault((s, p["block"]), p["shard"]) == p["shard"]
    assert {k: len(v) for k, v in blocks.items()} == drawn
    assert {k for k, _ in blocks} == set(range(mixing.SHARDS))
    by = {("=" + r["source"]): r for r in quota.collect()}
    for (s, k), n in words.items():
        goal, count = round(by[s]["target"]), by[s]["blocks"]
        assert n == (k + 1) * goal // count - k * goal // count


def test_result_needs_the_tree_and_the_seed(docs):
    own = values(mixing.digest(mixing.plan_mix(docs)).collect(), ("doc_id", "taken", "pieces"))
    assert own == values(mixing.digest(mixing.plan_mix(docs)).collect(), ("doc_id", "taken", "pieces"))
    one = values(mixing.digest(mixing.plan_mix(docs, shards=1)).collect(), ("doc_id", "taken", "pieces"))
    assert own != one
    other = values(mixing.plan_mix(docs, seed=5).collect(), ("doc_id", "taken"))
    assert [r[:2] for r in own] != other


def test_shards_follow_the_bytes(docs):
    assert [mixing.shards_for(n) for n in (0, 10**9, 10**11, 10**14)] == [16, 16, 32, 1024]
    assert mixing.mixed(docs, shards=64).groupBy("doc_id").count().exceptAll(mixing.mixed(docs).groupBy("doc_id").count()).count() >= 0


def test_copies_of_a_row_are_local_in_a_random_order(docs):
    rows = mixing.mixed(docs).coalesce(1).select("doc_id").collect()
    ids = [r["doc_id"] for r in rows]
    assert ids != sorted(ids)


def test_output_comes_shard_by_shard_of_the_tree(docs):
    """Fails where the tree is one shard: rows then have no shard but the first."""
    drawn = {r["doc_id"]: {p["shard"] for p in r["pieces"]} for r in mixing.plan_mix(docs, 16).select("doc_id", "pieces").collect()}
    rows = mixing.mixed(docs, 16).select("doc_id").collect()
    at = 0
    for r in rows:  # partitions come in order
        own = drawn[r["doc_id"]]
        assert not own or max(own) >= at, r
        at = max(at, min(own, default=0))
    assert at >= 10


def test_odd_rows(spark):
    long = "word " * 40_000
    rows = [(None, "a b c", None, 1), (None, "a b c", None, 1), (None, "d e", "x", 1), (1, None, "x", 1), (2, "", "x", 1), (3, long, "x", 1), (4, "one", "y", 1), (4, "one", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = mixing.plan_mix(docs.withColumn("k", F.lit(1)).withColumn("s", F.lit("clash")).withColumn("key", F.lit(2))).collect()
    assert len(out) == len(rows)
    assert all(r["taken"] == 0 and r["pieces"] == [] for r in out if r["size"] == 0)
    by = defaultdict(int)
    for r in out:
        assert r["taken"] <= 2 * r["size"]
        by[r["source"]] += r["taken"]
    aims = {r["source"]: r["target"] for r in out}
    assert all(abs(by[s] - aims[s]) <= 1 for s in aims)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    times = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert times[1, None] == times[2, ""] == 1
