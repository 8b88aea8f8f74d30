"""Chat windows that keep their budget, against the SQL form and plain digests."""

import hashlib
import random

import duckdb
import pytest

from dyelake.llm import chat, sql

SCHEMA = "conv_id long, turn long, role string, text string, window string, own int"


def conversations():
    rng = random.Random(6)
    say = lambda n: " ".join(rng.choice(("a", "bb", "<|im_end|>", "\\", "é\n", "<|")) for _ in range(n))
    rows = []
    for c in range(12):
        rows += [(c, 0, "system", say(rng.choice((5, 120, 124, 125, 3000))))]
        rows += [(c, t, ("user", "assistant")[t % 2 == 0], say(rng.choice((1, 40, 370, 507, 508, 509, 1600)))) for t in range(1, 14)]
    rows += [(20, 0, "system", "s " * 3000)] + [(20, t, "user", "t " * 370) for t in range(1, 10)]
    rows += [(21, 0, "assistant", "same"), (21, 0, "assistant", "same"), (21, 0, None, None), (21, None, "user\nx", "")]
    rows += [(22, 0, "assistant", f"  {'w ' * 1300}  "), (22, 1, "user", " \n"), (23, 0, "assistant", "")]
    rows += [(24, 0, "role " * 3000, "said"), (24, 1, "two\nwords <|im_end|>", "<|im_role|>5"), (24, 2, "assistant", "w " * 400), (24, 3, "a " * 40, ""), (24, 4, "<|im_role|>9", "x")]
    rows += [(None, 0, "user", "alone"), (None, 0, "user", "alone"), (None, 1, "assistant", "also alone")]
    return rows


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in conversations()], SCHEMA).repartition(3)


def test_no_window_is_over_its_budget(turns):
    made = chat.windows(turns).collect()
    assert max(r["n_tokens"] for r in made) <= chat.BUDGET
    for r in made:
        words = r["text"].replace(chat.START, "").replace(chat.MORE, "").split(chat.END + "\n")[:-1]
        assert r["n_tokens"] == sum(len(w.replace("\\\n", " ").partition("\n")[2].split()) + chat.MARKERS for w in words)
        assert r["n_repeated"] + r["n_new"] == len(words)
    # Ordinary windows do repeat what came before.
    assert sum(r["n_repeated"] > 0 for r in made) > 10


def test_reads_back_as_plain_digests(turns):
    out = {r["conv_id"]: r for r in chat.read_back(chat.windows(turns)).collect() if r["conv_id"] is not None}
    rows = conversations()
    for c in {r[0] for r in rows if r[0] is not None}:
        own = sorted(((-1 if t is None else t, role or "", text or "") for d, t, role, text in rows if d == c))
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        loss = "".join(t for _, r, t in own if r == "assistant")
        assert (out[c]["n_turns"], out[c]["turns_sha256"]) == (len(own), digest("".join(f"{r}\n{t}\n" for _, r, t in own)))
        assert (out[c]["loss_chars"], out[c]["loss_sha256"]) == (len(loss), digest(loss))


def test_as_sql(turns):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", conversations())
    want = con.execute(sql.OP2)
    columns = [c[0] for c in want.description]
    rows = [r for r in want.fetchall() if r[0] != -1]
    got = [tuple(r[c] for c in columns) for r in chat.read_back(chat.windows(turns)).collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    assert sum(r[0] is None for r in got) == 2


def test_empty(spark, turns):
    assert chat.read_back(chat.windows(turns.limit(0))).count() == 0
    with pytest.raises(ValueError, match="no room"):
        chat.windows(turns, budget=600)
