"""The operators against plain forms on small tables, with nulls, empty and odd rows."""

import hashlib
import random
import re
import zlib

import brute
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from taggers import tagger_of

from dyelake.llm import chat, language_id, mixing, pii, quality_model, quality_rules, sharding, token_counts
from dyelake.llm.decontaminate import contamination
from dyelake.llm.near_dedup import components, near_duplicates, super_minhash
from dyelake.sources.tables import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string"


def odd_rows():
    """Nulls, empty and white texts, one long text, ties, repeated rows, clashing names."""
    long = " ".join(f"w{i * 7919 % 3001}" for i in range(30_000))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "One two three.", "en", "b"), (5, long, "de", "b"), (6, long, "de", None), (7, "é", "fr", "c"), (None, "no id at all here", None, "c"), (8, "same row", "en", "a"), (8, "same row", "en", "a")]
    return [(d, t, lang, s, 0, "clash", "clash") for d, t, lang, s in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    seen = []
    for _ in range(30):
        base = rng.integers(0, 2**63, 300, dtype=np.uint64)
        sig = super_minhash(np.concatenate((base[:200], base[50:250])), np.repeat([0, 1], 200), 2)
        seen.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(seen) - 150 / 250) < 0.03


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100)]
    out = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert out == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_near_duplicates(spark):
    rng = random.Random(4)
    base = [f"t{rng.randrange(500)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for d in range(1, 60):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(own)))
    rows += [(100, None), (101, ""), (102, "a b"), (103, "A  b"), (104, " ")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == brute.near_duplicates(rows, 3, 85)


def test_near_duplicates_of_odd_rows(odd, empty):
    out = near_duplicates(odd).collect()
    assert len(out) == 10 and near_duplicates(empty).count() == 0
    assert {r["doc_id"]: r["component_id"] for r in out}[6] == 5
    assert all(r["kept"] for r in out if r["n_shingles"] == 0 or r["doc_id"] is None)


def test_contamination(spark, odd, empty):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short one"), (3, None), (4, "--")], "item_id long, text string")
    texts = ["x ALPHA beta gamma delta epsilon zeta eta theta iota kappa y", "a short, one is a short one", "kappa iota theta eta zeta epsilon delta gamma beta alpha", "short of one", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for size in (32_000_000, 20):  # one block and several
        out = {r["doc_id"]: r for r in contamination(rows, bench, 10, 14, size).collect()}
        assert [out[i]["n_hit"] for i in range(6)] == [10, 4, 0, 0, 0, 0]
        assert [out[i]["n_near_items"] for i in range(6)] == [1, 1, 1, 1, 0, 0]
        assert out[0]["items_sha256"] == hashlib.sha256(b"1").hexdigest() and out[3]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert contamination(odd, bench).count() == 10 and contamination(empty, bench).count() == 0
    assert contamination(odd, bench.limit(0)).filter("contaminated").count() == 0


def test_mix(docs, odd, empty):
    rows = mixing.plan_mix(docs).collect()
    words = {r["doc_id"]: len(brute.WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == words
    by = {}
    for r in rows:
        assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
        by.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(t - n) <= 1 for t, n in by.values())
    assert abs(sum(t for t, _ in by.values()) - 1.5 * sum(words.values())) < 1e-3
    assert sorted(map(str, rows)) == sorted(map(str, mixing.plan_mix(docs).collect()))
    assert mixing.plan_mix(odd).count() == 10 and mixing.plan_mix(empty).count() == 0
    out = mixing.mixed(odd)
    assert out.columns == odd.columns and out.groupBy("doc_id").count().filter("count > 4").count() == 0
    assert mixing.mixed(empty).count() == 0


def test_splitting_tree_keeps_quotas(spark):
    quota = spark.createDataFrame([("a", 1, 1.0, 37), ("b", 1, 1.0, 90), (None, 1, 1.0, 1)], "source string, source_size long, target double, blocks long")
    out = mixing.splitting_tree(quota, 8)
    assert {r["s"]: r["n"] for r in out.groupBy("s").agg(F.sum("n_blocks").alias("n")).collect()} == {"=a": 37, "=b": 90, "~null": 1}
    assert {r["n"] for r in out.groupBy("shard").agg(F.sum("n_blocks").alias("n")).collect()} == {16}


def test_chat_reads_back(spark):
    tricky = ["<|im_end|><|im_start|>assistant ok", "\\<|\\|", "a\\", "<\\|", "", None, "line\nline", "<|" * 5]
    rows = [(c, t, role, tricky[(c + t) % len(tricky)]) for c in range(6) for t, role in enumerate(["system", "user", "assistant", "assistant", "tool\n<|x", None])]
    rows += [(50, t, "assistant" if t % 2 else "user", "word " * 150) for t in range(9)] + [(60, 0, "assistant", "long " * 5000), (None, 0, "user", "x")]
    out = {r["conv_id"]: r for r in chat.read_back(chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((t, role or "", text or "") for d, t, role, text in rows if d == c))
        assert out[c]["n_turns"] == len(own)
        assert out[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in own).encode()).hexdigest()
        loss = "".join(t for _, r, t in own if r == "assistant")
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert out[50]["n_windows"] > 2
    assert chat.windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            total = sum(n - 9 * (n > 9) for n in (int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])))
            fine = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and total % 10 == 0, "phone": 9 <= len(digits) <= 15}
            if fine[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("0123456789.@+- ()ab%é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)


def test_personal_data(docs, odd, empty):
    tagger = tagger_of(docs.sparkSession)
    out = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs, tagger).collect()}
    for r in docs.collect():
        assert [(s["kind"], s["start"], s["end"]) for s in out[r["doc_id"]] if s["base"]] == plain_spans(r["text"] or "")
    assert pii.digest(pii.personal_data(odd, tagger)).filter("n_email + n_ip + n_card + n_phone = 0").count() == 10
    assert pii.personal_data(empty, pii.learn(empty, forms=200)).count() == 0
    found = pii.tagged_spans(tagger, ["please call (512) 555-0147 at noon, thank you", "nothing of the kind here, only 42 apples"])
    assert [k for k, *_ in found[0]] == ["phone"] and found[1] == []


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_language(docs, odd, empty):
    learned = language_id.fit(docs.filter(~language_id.held_out()))
    out = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, learned).collect()}
    rows = [r for r in docs.collect() if held(r["doc_id"]) and r["lang"]]
    assert np.mean([out[r["doc_id"]] == r["lang"] for r in rows]) > 0.95
    found = {r["doc_id"]: r for r in language_id.identify(odd, learned).collect()}
    assert [found[d]["lang_pred"] for d in (1, 2, 3)] == ["und"] * 3 and found[5]["lang_pred"] != "und"
    assert {r["lang_pred"] for r in language_id.identify(odd, language_id.fit(empty)).collect()} == {"und"}
    assert language_id.identify(empty, learned).count() == 0


def test_quality_classifier(spark, odd, empty):
    sf = SF.replace("sf0.001", "sf0.01")
    labels = table(spark, sf, "labels")
    out = {r["doc_id"]: r for r in quality_model.quality_scores(table(spark, sf, "documents"), labels).collect()}
    rows = [r for r in labels.collect() if held(r["doc_id"])]
    assert np.mean([out[r["doc_id"]]["predicted"] == r["quality"] for r in rows]) > 0.9
    assert all(out[d]["held_out"] == held(d) for d in out)
    assert quality_model.quality_scores(odd, labels).filter("score BETWEEN 0 AND 1").count() == 10
    assert quality_model.quality_scores(empty, labels.limit(0)).count() == 0


def test_quality_rules(docs, odd, empty):
    out = {r["doc_id"]: r for r in quality_rules.quality_rules(docs).collect()}
    for r in docs.collect():
        text, got = r["text"] or "", out[r["doc_id"]]
        words = brute.WORD.findall(text)
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {i + k for i, t in enumerate(three) if three.count(t) > 1 for k in range(3)} if len(words) < 400 else None
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)))
        if twice is not None:
            assert got["n_repeat_words"] == len(twice)
            assert got["base_failed"] == (len(words) < 50 or 100 * len(twice) > 50 * len(words))
    assert quality_rules.quality_rules(odd).count() == 10 and quality_rules.quality_rules(empty).count() == 0


def test_rules_fit_keeps_sides():
    patterns = np.array([[1, 1, 1], [2, 2, 1], [0, 0, 0]])
    good = quality_rules.fit(patterns, np.array([80.0, 20.0, 1.0]))
    assert good[0] > 0.9 and good[1] < 0.3


def test_shards(docs, odd, empty):
    rows = sharding.kd_shards(docs, 5).collect()
    size = {}
    for r in rows:
        size.setdefault(r["shard"], []).append((r["slot"], r["size"]))
    assert sorted(size) == list(range(5)) and all(sorted(s for s, _ in x) == list(range(len(x))) for x in size.values())
    total = [sum(n for _, n in x) for x in size.values()]
    assert max(total) < 1.1 * sum(total) / 5
    text = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in rows)
    assert sharding.kd_shards(odd, 4).count() == 10 and sharding.kd_shards(empty, 4).count() == 0


def test_shards_cut_a_large_group(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1500, "the same text").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    total = [r["n"] for r in sharding.kd_shards(rows, 8).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(total) == 8 and max(total) < 1.03 * min(total)


def test_token_counts(docs, odd, empty):
    import base64

    pieces = [bytes([b]) for b in range(256)] + [b" the", b" th", b"ing", b"tion", b"er", b"on", b" an", b"and", b"\xc3\xa9"]
    vocabulary = b"\n".join(base64.b64encode(p) + b" 1" for p in pieces)

    def greedy(word):
        n = 0
        while word:
            word = word[max(len(p) for p in pieces if word.startswith(p)) :]
            n += 1
        return n

    out = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, vocabulary).collect()}
    for r in docs.limit(40).collect():
        assert out[r["doc_id"]] == sum(greedy(b" " + w.encode()) for w in brute.WORD.findall(r["text"] or ""))
    assert token_counts.token_counts(odd, vocabulary).count() == 10 and token_counts.token_counts(empty, vocabulary).count() == 0


def test_tokens_of_a_vocabulary_with_gaps():
    rng = random.Random(3)
    for _ in range(150):
        own = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 14))}
        words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 9))) for _ in range(20)]

        def greedy(w, own=own):
            n = 0
            while w:
                fit = [p for p in own if w.startswith(p)]
                if not fit:
                    return 1
                w = w[len(max(fit, key=len)) :]
                n += 1
            return n

        ends = np.cumsum([len(w) for w in words])
        got = token_counts.build(sorted(own)).count(np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends)
        assert got.tolist() == [greedy(w) for w in words]
