"""Word hashes, token counts with a real vocabulary, quality by rules and by labels, language filters."""

import base64
import os
import random
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from dyelake.llm import language_id, quality_model, quality_rules, token_counts
from dyelake.llm.text import fingerprints
from dyelake.sources.tables import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_fingerprints_tell_regular_patterns_apart():
    turns = np.array([bin(i).count("1") % 2 for i in range(1024)], np.uint8)
    data = np.concatenate((97 + turns, 98 - turns, 97 + turns))
    a, b, c = fingerprints(data, np.array([0, 1024, 2048]), np.array([1024, 2048, 3072]))
    assert a != b and a == c
    rng = random.Random(2)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 700))) for _ in range(4000)]
    ends = np.cumsum([len(w) for w in words])
    own = fingerprints(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)
    assert len(set(words)) == len(set(own.tolist())) and len({(w, h) for w, h in zip(words, own.tolist(), strict=True)}) == len(set(words))


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary files")
def test_tokens_of_a_real_vocabulary(spark):
    with open(VOCABULARY, "rb") as f:
        lines = f.read()
    pieces = {base64.b64decode(x.split()[0]) for x in lines.splitlines() if x}
    longest = max(map(len, pieces))

    def greedy(word):
        n = at = 0
        while at < len(word):
            at += next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in pieces)
            n += 1
        return n

    docs = table(spark, SF, "documents")
    rng = random.Random(1)
    odd = spark.createDataFrame([(-1, "ab" * 60_000 + " x " + "".join(chr(rng.randrange(33, 0x500)) for _ in range(9000))), (-2, None), (-3, " "), (-4, "same"), (-4, "same")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(odd)
    got = Counter((r["doc_id"], r["n_words"], r["n_tokens"], r["n_bytes"]) for r in token_counts.token_counts(rows.withColumn("n_words", F.lit("clash")), lines).collect())
    want: Counter = Counter()
    for r in rows.collect():
        words = brute.WORD.findall(r["text"] or "")
        want[r["doc_id"], len(words), sum(greedy(b" " + w.encode()) for w in words), len((r["text"] or "").encode())] += 1
    assert got == want


def plain_em(patterns, rounds=50):
    """Posteriors of vote patterns, one text at a time."""
    k = len(patterns[0])
    good = [min(0.98, max(0.02, 0.5 + 0.5 * (p.count(1) - p.count(2)) / k)) for p in patterns]
    for _ in range(rounds):
        rate = [[[1.0, 4.0, 1.0] for _ in range(k)], [[1.0, 1.0, 4.0] for _ in range(k)]]
        for p, g in zip(patterns, good, strict=True):
            for i, v in enumerate(p):
                rate[0][i][v] += g
                rate[1][i][v] += 1 - g
        rate = [[[x / sum(r) for x in r] for r in side] for side in rate]
        prior = [(sum(good) + 2) / (len(good) + 3), (len(good) - sum(good) + 1) / (len(good) + 3)]
        now = []
        for p in patterns:
            like = [prior[c] * np.prod([rate[c][i][v] for i, v in enumerate(p)]) for c in (0, 1)]
            now.append(like[0] / sum(like))
        if max(abs(a - b) for a, b in zip(now, good, strict=True)) < 1e-9:
            return now
        good = now
    return good


def test_posterior_and_repeats_against_plain_forms(spark):
    docs = table(spark, SF, "documents")
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    votes = {r[0]: list(r[1:]) for r in quality_rules.measures(docs).select("doc_id", *quality_rules.votes()).collect()}
    ids = sorted(votes)
    for d, want in zip(ids, plain_em([votes[d] for d in ids]), strict=True):
        assert abs(out[d]["posterior"] - want) < 1e-6
        assert out[d]["kept"] == (not out[d]["base_failed"] and out[d]["posterior"] >= 0.5)
    for r in docs.collect():
        words = brute.WORD.findall(r["text"] or "")
        three = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        twice = {i + k for i in range(len(words) - 2) if three[tuple(words[i : i + 3])] > 1 for k in range(3)}
        assert out[r["doc_id"]]["n_repeat_words"] == len(twice)


def test_labels_that_disagree_teach_nothing(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 1), (3, 1), (5, 2), (None, 1), (6, 0)], "doc_id long, quality int")
    want = {(d, q) for d, q in ((3, 1), (6, 0)) if zlib.crc32(str(d).encode()) % 4 != 2}
    assert {tuple(r) for r in quality_model.known_labels(labels).collect()} == want


def test_quality_of_held_out_rows(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    out = {r["doc_id"]: r for r in quality_model.quality_scores(docs, labels).collect()}
    again = {r["doc_id"]: r["score"] for r in quality_model.quality_scores(docs.repartition(5), labels.repartition(3)).collect()}
    assert all(abs(out[d]["score"] - again[d]) < 1e-9 for d in out)
    rows = [r for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    score = {q: [out[r["doc_id"]]["score"] for r in rows if r["quality"] == q] for q in (0, 1)}
    assert np.mean([a > b for a in score[1] for b in score[0]]) > 0.95
    # A score is of the text alone.
    moved = quality_model.quality_scores(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")), labels)
    assert all(abs(out[r["doc_id"]]["score"] - r["score"]) < 1e-9 for r in moved.collect())


def test_filters_have_room_and_bounds(spark):
    docs = table(spark, SF, "documents")
    made = language_id.fit(docs)
    assert max(made.false_positive()) < 0.05
    with pytest.raises(ValueError, match="slots"):
        language_id.Filters(["a"], np.zeros((1, 1 << 21), np.uint64), 3)
    with pytest.raises(ValueError, match="lang has more"):
        language_id.fit(docs.withColumn("lang", F.col("doc_id").cast("string")), most_languages=10)


def test_shares_of_language_hits_against_sets(spark):
    docs = table(spark, SF, "documents")
    made = language_id.fit(docs, least_share=0.0)
    # All n-grams of the sample are in the filters: its own language contains every text whole.
    out = language_id.identify(docs, made).join(docs.select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL AND lang_pred != 'und'").collect()
    hits = {r["doc_id"]: r["score"] for r in out if r["lang"] == r["lang_pred"]}
    assert len(hits) > 0.9 * len(out) and min(hits.values()) > 0.99
