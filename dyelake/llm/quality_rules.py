"""Quality rules that vote, weighed by weak supervision.

Each rule looks at one measure of a text and votes good, bad or abstains. Nobody labels anything:
expectation-maximisation over the votes estimates how often each rule is right on good and on bad
texts and how common good texts are, and a document's verdict is its posterior probability of being good. The
documents only matter through their vote patterns, so a grouped count over all documents
(at most 3 to the number of rules rows) holds all that the fit needs, whatever the corpus's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.text import NOT_SPACE, Rows, by_row, fingerprints, mix, rows_of, texts_of

_U = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0xC0:] = True

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_marked", "n_long", "n_twins")


def measures(docs: DataFrame, more: tuple[str, str, Callable[[Rows], pa.Array]] | None = None) -> DataFrame:
    """(doc_id, and MEASURES as long) of each row of ``docs`` (doc_id, text), and ``more``: one column's name, type and function of some rows' texts.

    Beyond the counts that quality_rules() returns: n_lines lines with a word, n_upper ASCII
    capitals and n_letters letters (both in code points), n_marked words that end in one of ``!|#*$%&``,
    n_long words of over 25 bytes, n_twins words equal to the word before.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch.column("text"), fold=False):
                n, data = len(part), part.data
                word = NOT_SPACE[data]
                starts, ends, row = part.spans(word)
                n_words = np.bincount(row, minlength=n)
                # Lines: runs between line feeds, kept where some word lies in them.
                a, b, line_row = part.spans(data != 0x0A)
                some = np.searchsorted(starts, b) > np.searchsorted(starts, a)
                a, b, line_row = a[some], b[some], line_row[some]
                own = mix(fingerprints(data, a, b) ^ mix(line_row.astype(_U) + _U(1)))
                _, firsts = np.unique(own, return_index=True)
                n_lines = np.bincount(line_row, minlength=n)
                n_dup = n_lines - np.bincount(line_row[firsts], minlength=n)
                repeat, twin = np.zeros(len(row), bool), np.zeros(len(row), bool)
                h = fingerprints(data, starts, ends)
                if len(row) >= 2:
                    twin[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
                if len(row) >= 3:
                    at = np.flatnonzero(row[:-2] == row[2:])
                    three = mix(h[:-2] * _U(0xA24BAED4963EE407) + h[1:-1] * _U(0x9FB21C651E98DF25) + h[2:] * _U(0xD6E8FEB86659FD93))[at]
                    three = mix(three ^ mix(row[at].astype(_U) + _U(1)))
                    order = np.argsort(three)
                    same = np.concatenate(([False], three[order][1:] == three[order][:-1]))
                    same[:-1] |= same[1:]
                    twice = at[order[same]]
                    for k in range(3):
                        repeat[twice + k] = True
                out = {
                    "n_words": n_words,
                    "word_chars": part.per_row(word & ((data & 0xC0) != 0x80)),
                    "n_symbols": part.per_row(_SYMBOL[data]),
                    "n_dup_lines": n_dup,
                    "n_repeat_words": by_row(repeat, row, n),
                    "n_lines": n_lines,
                    "n_upper": part.per_row(_UPPER[data]),
                    "n_letters": part.per_row(_LETTER[data]),
                    "n_marked": by_row(np.isin(data[ends - 1], np.frombuffer(b"!|#*$%&", np.uint8)), row, n),
                    "n_long": by_row(ends - starts > 25, row, n),
                    "n_twins": by_row(twin, row, n),
                }
                own = [more[2](part)] if more else []
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(part.first, n), *(pa.array(np.asarray(out[k], np.int64)) for k in MEASURES), *own], names=names)

    names = ["doc_id", *MEASURES, *([more[0]] if more else [])]
    return texts_of(docs).mapInArrow(make, "doc_id long, " + ", ".join(f"{k} long" for k in MEASURES) + (f", {more[0]} {more[1]}" if more else ""))


def _vote(bad: str, good: str) -> Column:
    return F.expr(f"CASE WHEN n_words = 0 THEN 0 WHEN {bad} THEN 2 WHEN {good} THEN 1 ELSE 0 END")


def votes() -> list[Column]:
    """One column per rule: 1 good, 2 bad, 0 abstains. Texts without words get no votes."""
    return [
        _vote("n_symbols > 0.25 * n_words", "n_symbols < 0.05 * n_words").alias("symbols"),
        _vote("2 * n_dup_lines > n_lines", "10 * n_dup_lines < n_lines").alias("lines"),
        _vote("10 * n_repeat_words > 3 * n_words", "20 * n_repeat_words < n_words").alias("repeats"),
        _vote("word_chars < 3 * n_words OR word_chars > 12 * n_words", "word_chars BETWEEN 4 * n_words AND 9 * n_words").alias("word_length"),
        _vote("n_words < 50", "n_words >= 80").alias("length"),
        _vote("n_upper > 0.3 * n_letters", "n_upper < 0.1 * n_letters").alias("capitals"),
        _vote("n_letters < 0.6 * word_chars", "n_letters > 0.85 * word_chars").alias("letters"),
        _vote("n_marked > 0.3 * n_words", "n_marked < 0.05 * n_words").alias("marks"),
        _vote("n_twins > 0.3 * n_words", "n_twins < 0.05 * n_words").alias("twins"),
        _vote("n_long > 0.1 * n_words", "n_long = 0 OR n_long < 0.02 * n_words").alias("long_words"),
    ]


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """The posterior of good for each vote pattern (rows of 0, 1, 2), by expectation-maximisation.

    Each rule has a distribution over its three votes for good and for bad texts, smoothed by a few
    imagined texts on which it is right; that, and the start from the majority of votes, keeps the
    names of the two classes from changing places. A pattern of no votes gets the prior.
    """
    n, k = patterns.shape
    vote = np.stack([(patterns == v).astype(float) for v in range(3)], axis=2)
    balance = (patterns == 1).sum(1) - (patterns == 2).sum(1)
    good = np.clip(0.5 + 0.5 * balance / max(1, k), 0.02, 0.98)
    imagined = np.tile(np.array([[1.0, 4.0, 1.0], [1.0, 1.0, 4.0]])[:, None, :], (1, k, 1))
    for _ in range(rounds):
        weight = np.stack((good, 1 - good)) * counts
        rate = np.einsum("cn,nkv->ckv", weight, vote) + imagined
        rate /= rate.sum(2, keepdims=True)
        prior = (weight.sum(1) + [2.0, 1.0]) / (counts.sum() + 3.0)
        score = np.log(prior)[:, None] + np.einsum("ckv,nkv->cn", np.log(rate), vote)
        score -= score.max(0)
        like = np.exp(score)
        now = like[0] / like.sum(0)
        if np.abs(now - good).max() < 1e-9:
            good = now
            break
        good = now
    return good


def quality_rules(docs: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, posterior, kept).

    Words are runs of characters other than ASCII white space. word_chars counts their code points, n_symbols
    the characters ``#*$%&|<>``, n_dup_lines the lines (between line feeds) that have a word and equal an earlier
    line of the text, n_repeat_words the words in three-word windows that the text has twice or more.
    base_failed: fewer than 50 words, or more than half of the words are repeats. kept: not base_failed
    and the posterior is at least ``keep_from``.

    A null or empty text counts as 0 words, is base_failed and not kept, and gets the posterior of a text
    that no rule judges. Repeated rows are judged one by one and count one by one in the fit. An
    empty table gives an empty one. Other columns are ignored.
    """
    rules = votes()
    names = [f"v{i}" for i in range(len(rules))]
    seen = written(measures(docs))
    voted = seen.select("*", *(r.alias(n) for r, n in zip(rules, names, strict=True)))
    code = sum((F.col(n) * 3**i for i, n in enumerate(names)), F.lit(0)).cast("int")
    counted = voted.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n")).collect()
    codes = np.array([r["code"] for r in counted], np.int64)
    patterns = np.stack([codes // 3**i % 3 for i in range(len(names))], axis=1) if len(codes) else np.zeros((0, len(names)), np.int64)
    posterior = fit(patterns, np.array([r["n"] for r in counted], float)) if len(codes) else np.zeros(0)
    spark = docs.sparkSession
    table = spark.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior, strict=True)], "code int, posterior double")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # At most 3**rules rows, a bound that no corpus changes.
    return (
        voted.withColumn("code", code)
        .join(F.broadcast(table), "code", "left")
        .select("doc_id", *MEASURES[:5], base_failed.alias("base_failed"), "posterior", (~base_failed & (F.col("posterior") >= keep_from)).alias("kept"))
    )
