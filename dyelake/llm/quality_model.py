"""A quality classifier learned by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its text: of the shares of its hashed byte n-grams, and of a few measures
that n-grams don't show (length, repeats). From labelled documents come preference pairs (a good one over a bad one); the weights minimise the
logistic loss on the pairs' feature differences, in which what all documents share cancels out. The threshold is a quantile of
the strengths: the share of bad labels among the learned documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.language_id import held_out
from dyelake.llm.quality_rules import measures
from dyelake.llm.text import Rows

#: Bytes of an n-gram, and the numbers that they are hashed to.
GRAM, BUCKETS = 3, 2048
#: Penalties of an n-gram's weight and of a measure's.
GRAM_RIDGE, MEASURE_RIDGE = 0.02, 1e-4
#: Each measure's feature in SQL; w is the number of words, 1 at least.
MEASURED = {
    "log_words": "ln(1 + n_words)",
    "word_length": "ln(1 + word_chars / w)",
    "symbols": "least(2.0, n_symbols / w)",
    "repeats": "n_repeat_words / w",
    "dup_lines": "n_dup_lines / greatest(1, n_lines)",
    "capitals": "n_upper / greatest(1, n_letters)",
    "letters": "n_letters / greatest(1, word_chars)",
    "twins": "n_twins / w",
}


def _grams(part: Rows) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of each n-gram of bytes that lies in one row."""
    d = part.data.astype(np.uint32)
    if len(d) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    row = np.repeat(np.arange(len(part)), np.diff(part.offsets))
    whole = row[: -GRAM + 1] == row[GRAM - 1 :]
    gram = d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16)
    return (gram[whole] * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), row[: -GRAM + 1][whole]


@dataclass
class Ranking:
    """Strength = grams . shares + weights . measured; score = logistic of the strength above ``cut`` plus logit(0.7)."""

    grams: np.ndarray
    weights: np.ndarray
    cut: float

    def shares(self) -> tuple:
        """The column of each text's mean n-gram weight, for measures()."""
        grams = self.grams

        def mean(part: Rows) -> pa.Array:
            bucket, row = _grams(part)
            n = np.bincount(row, minlength=len(part))
            return pa.array(np.bincount(row, grams[bucket], len(part)) / np.maximum(1, n))

        return "gram_strength", "double", mean

    def score(self) -> Column:
        total = F.lit(float(np.log(0.7 / 0.3) - self.cut)) + F.col("gram_strength")
        for name, w in zip(MEASURED, self.weights, strict=True):
            total = total + F.lit(float(w)) * F.col(name)
        return 1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), total))))


def _vector(part: Rows) -> pa.Array:
    """The shares of the buckets among each text's n-grams, as float32."""
    bucket, row = _grams(part)
    out = []
    edges = np.searchsorted(row, np.arange(len(part) + 1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out.append((np.bincount(bucket[a:b], minlength=BUCKETS) / max(1, b - a)).astype(np.float32).tobytes())
    return pa.array(out, pa.binary())


def features(seen: DataFrame, *others: str) -> DataFrame:
    """doc_id, MEASURED of measures() rows and ``others`` as they are; all are finite, also for texts without words."""
    w = seen.withColumn("w", F.greatest(F.lit(1.0), F.col("n_words").cast("double")))
    return w.select("doc_id", *(F.expr(f"CAST({sql} AS DOUBLE)").alias(name) for name, sql in MEASURED.items()), *others)


def fit_pairs(x: np.ndarray, good: np.ndarray, ridge: np.ndarray | float, pairs: int = 60_000, epochs: int = 8, seed: int = 7) -> tuple[np.ndarray, float]:
    """(weights, cut) from about ``pairs`` (good, bad) pairs of rows of ``x``, by Adam over shuffled batches; ridge is each weight's penalty.

    If either class is missing there is nothing to prefer: all weights are 0 and every score 0.7 (all
    good) or just below (all bad).
    """
    best, worst = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(best) or not len(worst):
        return np.zeros(x.shape[1]), 0.0 if len(best) or not len(worst) else 0.1
    rng = np.random.default_rng(seed)
    each = max(pairs, len(best), len(worst))
    # Every document of either class is in some pair.
    a, b = np.resize(rng.permutation(best), each), rng.permutation(np.resize(worst, each))
    scale = x.std(axis=0) + 1e-6
    x = (x / scale).astype(np.float32)
    w, m, v, step = np.zeros(x.shape[1], np.float32), 0.0, 0.0, 0
    for epoch in range(epochs):
        rate = 0.03 * 0.6**epoch
        for own in np.array_split(rng.permutation(each), max(1, each // 512)):
            d = x[a[own]] - x[b[own]]
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            slope = -(p @ d) / len(own) + ridge * w
            step += 1
            m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope * slope
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    strength = x.astype(np.float64) @ w
    return w / scale, float(np.quantile(strength, len(worst) / len(x)))


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) to learn from: labels 0 and 1 of rows that aren't held out, on whose quality all rows of a doc_id agree."""
    own = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out()).groupBy("doc_id")
    return own.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most").select("doc_id", "quality")


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 6000) -> Ranking:
    """A ranking of the texts of labelled rows that are not held out.

    About ``most_rows`` rows, drawn by a hash of doc_id, are learned from if there are more, and twice as many at most where a doc_id has several:
    the bound on what comes to the driver, 8 KB a row. Labels other than 0 and 1, null doc_ids, and doc_ids of which labels disagree are left out.
    """
    known = known_labels(labels)
    share = min(1.0, most_rows / max(1, known.count()))
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1_000_003 * share).limit(2 * most_rows)
    # The sample is bounded by most_rows.
    own = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    rows = features(measures(own, ("shares", "binary", _vector)), "shares").join(F.broadcast(sample), "doc_id")
    rows = rows.orderBy("doc_id", *MEASURED, "shares").limit(2 * most_rows).toPandas()
    grams = np.stack([np.frombuffer(s, np.float32) for s in rows["shares"]]) if len(rows) else np.zeros((0, BUCKETS), np.float32)
    # Thousands of n-grams could tell any few documents apart: each counts for little by itself.
    ridge = np.repeat((GRAM_RIDGE, MEASURE_RIDGE), (BUCKETS, len(MEASURED)))
    weights, cut = fit_pairs(np.concatenate((grams, rows[list(MEASURED)].to_numpy(np.float32)), axis=1), rows["quality"].to_numpy() == 1, ridge)
    return Ranking(weights[:BUCKETS], weights[BUCKETS:], cut)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs`` (doc_id, text), as ``labels`` mark quality.

    score is in 0 to 1, higher for a text likelier of label 1; predicted is 1 from ``threshold`` on. Only
    labels of rows whose crc32 of doc_id as text, modulo 4, is not 2 are learned from; a score
    depends on the text alone.

    Null and empty texts have no words and the score of that; very long texts are read whole.
    Rows of one doc_id are scored one by one; for learning each is a row of that label. A null
    doc_id is scored too and not held out. An empty table gives an empty one. Other columns are ignored.
    """
    ranking = fit(docs, labels)
    feats = features(measures(docs, ranking.shares()), "gram_strength")
    scored = written(feats.select("doc_id", held_out().alias("held_out"), ranking.score().alias("score")))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
