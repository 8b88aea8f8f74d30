"""Phrase collocation mining by sampling, negative border and expansion (Toivonen).

A sample of documents, drawn by hash, proposes phrases. A full pass then counts exactly what was proposed and its negative border: every
word, every pair of words that were both proposed, every triple whose two pairs were both proposed. A phrase of the
border that turns out frequent is a border failure: longer phrases through it may be frequent without having been counted. Another pass counts
what the failures add to the border, until there are no more; phrases have three words, so two such passes always close it. The result doesn't depend on the
sample, only the number of passes and the work in them do.

Proposed phrases are held as Bloom filters of bounded size. A phrase that a filter passes by mistake is counted exactly like any
other. Whether a pass counts a phrase depends on the filters alone, so each phrase is counted by one pass and there
completely.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.hash_filter import HashFilter, any_has
from dyelake.llm.text import Rows, fingerprints, mix, rows_of, texts_of

_U = np.uint64
_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_CUT
_WORD[[0x20, 0x09]] = False
#: Bytes of text whose phrases are counted together (a longer row by itself).
_CHUNK = 1_500_000
_ODD = _U(0x9E3779B97F4A7C15)
_SPACE = pa.scalar(b" ", pa.large_binary())


def _words(part: Rows) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of a chunk; each word's number among them, its row, and the number of its piece."""
    inside = _WORD[part.data]
    starts, ends, row = part.spans(inside)
    piece = np.cumsum(_CUT[part.data])[starts] + row if len(starts) else row
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(part.data[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row, piece


def _prints(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return fingerprints(np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets[:-1], offsets[1:])


def _pair_prints(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a * _ODD) ^ b)


def _lang_prints(langs: list[str]) -> np.ndarray:
    text = "".join(langs).encode()
    ends = np.cumsum([len(x.encode()) for x in langs], dtype=np.int64)
    return fingerprints(np.frombuffer(text, np.uint8), np.concatenate(([0], ends[:-1])).astype(np.int64), ends)


class _Border:
    """What a pass counts: filters of proposed words and pairs, those of earlier passes apart from those new in this one."""

    def __init__(self, words: list[HashFilter | Broadcast], pairs: list[HashFilter | Broadcast], first: bool):
        self.words, self.pairs, self.first = words, pairs, first

    def proposed(self, level: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each was proposed by now, and before this pass."""
        filters = (self.words, self.pairs)[level]
        return any_has(filters, prints), any_has([] if self.first else filters[:-1], prints)


def _count(batches: Iterator[pa.RecordBatch], border: _Border | None) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of each chunk: of all phrases, or of those in the border; n of all words under the empty phrase."""
    for batch in batches:
        lang_of, langs = _coded(batch.column("lang").fill_null("und"))
        for part in rows_of(batch.column("text"), _CHUNK):
            words, word, row, piece = _words(part)
            if not len(word):
                continue
            # From here on a word is one of a language.
            own, word = np.unique(lang_of[part.first + row] * len(words) + word, return_inverse=True)
            lang, text = own // len(words), words.take(pa.array(own % len(words)))
            h1 = mix(_prints(words)[own % len(words)] ^ _lang_prints(langs)[lang])
            out = []
            if border is None or border.first:
                n = np.bincount(word, minlength=len(own))
                out.append((lang, text, n))
                total = np.bincount(lang, weights=n, minlength=len(langs)).astype(np.int64)
                out.append((np.arange(len(langs)), pa.array([b""] * len(langs), pa.large_binary()), total))
            at = np.flatnonzero(piece[1:] == piece[:-1])
            a, b = word[at], word[at + 1]
            pairs, pair = np.unique(a * len(own) + b, return_inverse=True)
            i, j = pairs // len(own), pairs % len(own)
            n, told = np.bincount(pair, minlength=len(pairs)), np.ones(len(pairs), bool)
            if border is not None:
                now, before = border.proposed(0, h1)
                told = now[i] & now[j] & ~(before[i] & before[j])
            both = pc.binary_join_element_wise(text.take(pa.array(i)), text.take(pa.array(j)), _SPACE)
            out.append((lang[i][told], both.filter(pa.array(told)), n[told]))
            pair_at = np.full(len(word), -1)
            pair_at[at] = pair
            at = at[:-1][pair_at[at[:-1] + 1] >= 0] if len(at) else at
            p, q = pair_at[at], pair_at[at + 1]
            if border is not None:
                now, before = border.proposed(1, _pair_prints(h1[i], h1[j]))
                keep = now[p] & now[q] & ~(before[p] & before[q])
                p, q = p[keep], q[keep]
            triples, n = np.unique(p * len(own) + j[q], return_counts=True)
            p, c = triples // len(own), triples % len(own)
            out.append((lang[c], pc.binary_join_element_wise(both.take(pa.array(p)), text.take(pa.array(c)), _SPACE), n))
            for of, phrase, n in out:
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(of)), phrase.cast(pa.binary()).cast(pa.string()), pa.array(n.astype(np.int64))], names=["lang", "phrase", "n"])


def _coded(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def counts(docs: DataFrame, least: int, border: _Border | None = None) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``docs`` that occur ``least`` times, of the border if there is one."""
    found = texts_of(docs, "text", "lang").mapInArrow(lambda batches: _count(batches, border), "lang string, phrase string, n long")
    return found.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("phrase") == ""))


def _hashed(phrases: DataFrame, filters: list[HashFilter | Broadcast] | None = None) -> DataFrame:
    """(h) of each of ``phrases`` (lang, phrase), all words or all pairs; only those that none of ``filters`` has."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang_of, langs = _coded(batch.column("lang"))
            for part in rows_of(batch.column("phrase"), _CHUNK):
                words, word, row, _ = _words(part)
                if not len(word):
                    continue
                h = mix(_prints(words)[word] ^ _lang_prints(langs)[lang_of[part.first + row]])
                first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                if len(first) < len(h):
                    h = _pair_prints(h[first], h[first + 1])
                h = h[~any_has(filters or [], h)]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return texts_of(phrases, "lang", "phrase").mapInArrow(make, "h long")


def _of_size(phrases: DataFrame, words: int) -> DataFrame:
    return phrases.filter(_size() == words)


def _size():
    """Words of a phrase."""
    return F.when(F.col("phrase") == "", 0).otherwise(1 + F.length("phrase") - F.length(F.translate("phrase", " ", "")))


def frequent_phrases(docs: DataFrame, least: int = 10, sample_every: int = 8) -> DataFrame:
    """(lang, phrase, n) of all phrases of one to three words with at least ``least`` occurrences, and the empty phrase with n of all words.

    About every ``sample_every``-th document, drawn by a hash of its row, proposes phrases; it proposes what occurs there least / sample_every times, twice at least.
    """
    drawn = docs.filter(F.pmod(F.xxhash64("text", "doc_id"), F.lit(sample_every)) == 0)
    proposed = written(counts(drawn, max(2, least // sample_every)).filter(F.col("phrase") != ""))
    # A filter is broadcast once for all passes, and the driver's Python keeps none.
    share = lambda hashes: docs.sparkSession.sparkContext.broadcast(HashFilter.of(hashes))
    words, pairs = [share(_hashed(_of_size(proposed, 1)))], [share(_hashed(_of_size(proposed, 2)))]
    passes = [written(counts(docs, least, _Border(words, pairs, True)))]
    while len(passes) < 3:
        # Border failures: frequent, yet not proposed.
        missed = [written(_hashed(_of_size(passes[-1], k + 1), filters)) for k, filters in enumerate((words, pairs))]
        if all(m.isEmpty() for m in missed):
            break
        words, pairs = [*words, share(missed[0])], [*pairs, share(missed[1])]
        passes.append(written(counts(docs, least, _Border(words, pairs, False))))
    for f in (*words, *pairs):
        f.destroy()
    return reduce(DataFrame.unionByName, (p if i == 0 else p.filter(F.col("phrase") != "") for i, p in enumerate(passes)))


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, sample_every: int = 8) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two or three words, by a * a / (l * r).

    A-Z are folded; pieces end at ``.,;:!?`` and line breaks; words lie between spaces and tabs. l and r count the two parts of the phrase at the cut that scores
    lowest, the earliest of equal ones. A phrase of which some longer frequent phrase makes up half of the occurrences is left out. Scores are exact: products are decimals
    of 38 digits, enough for counts of 13. Null texts and texts without words have no phrases, a null lang is ``und``. Rows count as often as they
    come. An empty table gives an empty one; other columns are not looked at.
    """
    known = written(frequent_phrases(docs.select("doc_id", "text", "lang"), least, sample_every))
    total = known.filter(F.col("phrase") == "").select("lang", F.col("n").alias("total"))
    word = F.split("phrase", " ")
    found = known.withColumn("size", _size()).filter("size > 1").select("lang", "phrase", F.col("n").alias("a"), "size")
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice(word, F.lit(1), F.col("k")), " ")).withColumn("right", F.array_join(F.slice(word, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    part = lambda side, n: known.select("lang", F.col("phrase").alias(side), F.col("n").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    wide = lambda c: f"cast({c} as decimal(13, 0))"
    cuts = cuts.withColumn("score", F.expr(f"(1000000 * ({wide('a')} * {wide('a')})) div ({wide('l')} * {wide('r')})"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"))
    longer = found.filter("size = 3").select("lang", F.explode(F.array(F.array_join(F.slice(word, 1, 2), " "), F.array_join(F.slice(word, 2, 2), " "))).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = best.join(longer, ["lang", "phrase"], "left").filter("longer IS NULL OR 100 * longer < 50 * a")
    rows = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The best of each of 64 parts of a language first, so that no task orders all of a language's phrases.
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return rows.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
