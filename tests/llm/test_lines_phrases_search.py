"""Line dedup, phrase mining and ranked search against plain forms, on drawn and on odd tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from dyelake.llm import hash_filter, phrases, ranked_search
from dyelake.llm.hash_filter import HashFilter
from dyelake.llm.line_dedup import LineRuns, drop_repeated_lines

SCHEMA = "doc_id long, text string, lang string, k1 int, gone string, phrase string, term string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(d, t, x, 1, "g", "p", "t") for d, t, x in rows], SCHEMA).repartition(parts)


def lines(rows, least_chars=20, least_docs=3):
    """(doc_id, n_lines, n_dropped, text) of each row."""
    key = lambda x: brute.fold(x.strip(" \t\n\x0b\x0c\r"))
    holds = defaultdict(set)
    for d, t, _ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= least_chars:
                holds[key(x)].add(d)
    last = {k: max((d for d in s if d is not None), default=None) for k, s in holds.items() if len(s) >= least_docs}
    out = []
    for d, t, _ in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if key(x) not in last or last[key(x)] == d]
        out.append((d, len(own), len(own) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def odd_rows():
    shared = "This line is one that many share"
    long = "\n".join(f"line {i * 7919 % 997} of a long text, long enough" for i in range(5000))
    return [
        (1, f"  {shared.upper()}\r\nown\n\n{shared}\t", "en"), (2, shared, None), (3, f"{shared}\nshort", "en"), (None, f"{shared}\nx", "en"), (None, None, None), (4, None, "en"), (5, "", "en"),
        (6, long, "en"), (7, long, "de"), (8, long + "\n", "de"), (9, "ééééééééééééééééééé", "fr"), (10, "ééééééééééééééééééé\nÉéééééééééééééééééééé", "fr"), (3, f"{shared}\nshort", "en"), (3, "other", "en"),
    ]


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (5, 2), (7, 3)])
def test_line_dedup(spark, batches, fan_in):
    rng = random.Random(batches)
    rows = [(rng.randrange(300), "\n".join(f"a drawn line of number {int(rng.paretovariate(0.4)) % 400}" for _ in range(rng.randrange(9))), "en") for _ in range(300)] + odd_rows()
    out = drop_repeated_lines(frame(spark, rows), batches=batches, buckets=4, fan_in=fan_in)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == lines(rows)


def test_line_dedup_of_an_empty_table(spark):
    assert drop_repeated_lines(frame(spark, odd_rows()).limit(0), buckets=2).count() == 0


def test_runs_are_levelled_and_hold_each_key_once(spark):
    runs = LineRuns(spark, buckets=2, fan_in=2)
    for b in range(7):
        runs.add(spark.createDataFrame([(k, k, 10 * b + d) for k in range(b, b + 5) for d in (1, 2)], "k1 long, k2 long, doc_id long"))
    assert [len(x) for x in runs.levels] == [1, 1, 1]
    keys = Counter(r["k1"] for run in runs.runs() for r in run.table().collect())
    assert keys == {k: 1 for k in range(11)}
    got = {r["k1"]: (r["n_docs"], r["last_doc"]) for r in runs.frequent(1).collect()}
    assert got == {k: (2 * len(b), 10 * max(b) + 2) for k in range(11) if (b := [b for b in range(7) if b <= k < b + 5])}


def test_merging_runs_does_not_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = LineRuns(spark, buckets=4, fan_in=8)
        for b in range(2):
            runs.add(spark.range(1000).selectExpr(f"id + {500 * b} AS k1", "id AS k2", f"id * 2 + {b} AS doc_id"))
        a, b = (r.table() for r in runs.runs())
        plan = a.join(b.hint("merge"), ["k1", "k2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def collocations(rows, least, top):
    n, f = Counter(), defaultdict(Counter)
    for _, t, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", brute.fold(t or "")):
            own = [w for w in re.split("[\x20\x09]+", piece) if w]
            n[lang] += len(own)
            for k in (1, 2, 3):
                f[lang].update(tuple(own[i : i + k]) for i in range(len(own) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if a >= least}
        found = []
        for p, a in often.items():
            if len(p) < 2 or any(2 * b >= a and (q[:2] == p or q[1:] == p) for q, b in often.items() if len(q) == 3 and len(p) == 2):
                continue
            score, _, l, r = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


@pytest.mark.parametrize("sample_every,least", [(1, 3), (3, 4), (1_000_000_007, 3)])
def test_collocations(spark, sample_every, least):
    """Whatever the sample proposes, nothing at all included, the phrases are the same."""
    rng = random.Random(least)
    words = ["the", "The", "of", "a", "in", "new", "york", "city", "x y", "éa", "Éa", "#"]
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", ":"]) for _ in range(rng.randrange(60)))
    rows = [(i, text(), rng.choice(["en", "en", "de", None, "und"])) for i in range(150)] + odd_rows()[:6]
    out = phrases.collocations(frame(spark, rows), least=least, top=25, sample_every=sample_every)
    assert sorted(tuple(r) for r in out.collect()) == collocations(rows, least, 25)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(frame(spark, odd_rows()).limit(0)).count() == 0
    assert phrases.collocations(frame(spark, [(1, None, "en"), (2, " . ", None)])).count() == 0


def test_a_pass_counts_what_the_one_before_left_out(spark):
    """Passes are disjoint, and the first one doesn't count all."""
    rows = [(i, "alpha beta gamma delta epsilon", "en") for i in range(30)]
    docs = frame(spark, rows).select("doc_id", "text", "lang")
    none = [HashFilter.empty()]
    first = phrases.counts(docs, 3, phrases._Border(none, none, True)).collect()
    assert sorted(r["phrase"] for r in first) == ["", "alpha", "beta", "delta", "epsilon", "gamma"]
    told = spark.createDataFrame([("en", w) for w in ("alpha", "beta", "gamma")], "lang string, phrase string")
    words = [*none, HashFilter.of(phrases._hashed(told))]
    second = phrases.counts(docs, 3, phrases._Border(words, [*none, HashFilter.empty()], False)).collect()
    assert sorted(r["phrase"] for r in second) == ["alpha beta", "beta gamma"]


def ranked(rows, items, top):
    term = re.compile(ranked_search.TERM)
    docs = [(d, Counter(w)) for d, t, _ in rows if (w := term.findall(brute.fold(t or "")))]
    n_all, words_all = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    wanted = defaultdict(Counter)
    for i, t in set(items):
        wanted[i].update(term.findall(brute.fold(t or "")))
    out = []
    for item, terms in wanted.items():
        scored = []
        for d, c in docs:
            m = 75 + 25 * sum(c.values()) * n_all // words_all
            s = sum(times * math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, times in terms.items() if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("top,most_terms", [(5, 20_000), (20, 25)])
def test_ranked_search(spark, monkeypatch, top, most_terms):
    monkeypatch.setattr(ranked_search, "MOST_TERMS", most_terms)
    monkeypatch.setattr(ranked_search, "_CELLS", 500)
    rng = random.Random(top)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 300}"
    rows = [(rng.randrange(1000), " ".join(word() for _ in range(rng.randrange(40))) + rng.choice(["", " É_é-W3", "!"]), "en") for _ in range(400)]
    rows += [(i, "w7 w8 w9 copied", "en") for i in range(2000, 2060)] + odd_rows()
    items = [(i, " ".join(word() for _ in range(rng.randrange(100)))) for i in range(12)] + [(12, "copied W7"), (13, None), (14, ""), (15, "nowhere"), (None, "w1 w2 w2"), (12, "copied W7"), (12, "w9")]
    bench = spark.createDataFrame([(i, t, 0, "d") for i, t in items], "item_id long, text string, rank int, doc_id string")
    out = ranked_search.ranked_search(frame(spark, rows, 5), bench, top)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == ranked(rows, items, top)


def test_ranked_search_of_nothing(spark):
    docs = frame(spark, odd_rows())
    bench = spark.createDataFrame([(1, "line")], "item_id long, text string")
    assert ranked_search.ranked_search(docs.limit(0), bench).count() == 0
    assert ranked_search.ranked_search(docs, bench.limit(0)).count() == 0


def test_groups_of_masks_below_the_bound_are_not_evaluated(monkeypatch):
    """A block's documents that lack the rare term can't reach the best, so they are never scored."""
    import numpy as np
    import pyarrow as pa

    docs = 1000
    row = {"ids": pa.array(range(docs)), "sizes": pa.array([10] * docs, pa.int64()), "terms": pa.array(["common", "rare"]), "n_docs": pa.array([docs, 30], pa.int32())}
    row |= {"doc": pa.array([*range(docs), *range(30)], pa.int32()), "tf": pa.array([1] * docs + [3] * 30, pa.int32())}
    wanted = ranked_search._Wanted({"common": 0, "rare": 1}, np.array([10, 5000]), [(np.array([0, 1]), np.array([1, 1]))], np.ones(1, np.int64))
    seen = []
    plain = ranked_search._Best.add
    monkeypatch.setattr(ranked_search._Best, "add", lambda self, scores, ids, at: (seen.extend(at.tolist()), plain(self, scores, ids, at))[1])
    best = [ranked_search._Best(20, 1)]
    ranked_search._search_block(row, (docs, 10 * docs), wanted, best)
    assert sorted(seen) == list(range(30)) and [d for _, d in best[0].rows] == list(range(20))


def test_digest_of_lines(spark):
    import duckdb

    from dyelake.llm import queries, sql

    rows = odd_rows()[5:12]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    want = sorted(con.execute(sql.OP11).fetchall())
    assert queries.QUERIES["op11_line_dedup"] and want == sorted((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in lines(rows))


@pytest.mark.parametrize("n", [3, 5000, 400_000])
def test_a_filter_comes_to_the_driver_in_parts(spark, monkeypatch, n):
    """Its words are those of a plain form, and no row of each word is gathered."""
    monkeypatch.setattr(hash_filter, "_BLOCK", 1 << 12)
    monkeypatch.setattr(type(spark.range(0)), "toPandas", lambda self: pytest.fail("a row a word in the driver"))
    hashes = spark.range(n).select(F.xxhash64("id").alias("h"))
    made = HashFilter.of(hashes)
    h = np.array([r["h"] for r in hashes.collect()], np.int64).view(np.uint64)
    bits = np.zeros(n, np.uint64)
    for k in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((h >> np.uint64(k)) & np.uint64(63))
    want = np.zeros(len(made.words), np.uint64)
    np.bitwise_or.at(want, ((h >> np.uint64(24)) % np.uint64(len(want))).astype(np.int64), bits)
    assert (made.words == want).all() and made.has(h).all()
