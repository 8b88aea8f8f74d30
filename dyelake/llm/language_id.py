"""Language identification by language-bitmask n-gram filters.

A bit-sliced Bloom filter answers for all languages at once: slot s of the filter is a mask with bit
l set if some n-gram of language l hashes to s, and the AND of an n-gram's slots has the bit of every language
that contains it. A document's n-grams are looked up together; per-language counts of set bits, less
the hits that the filter's fill would give by chance, decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dyelake.llm.text import Rows, by_row, mix, rows_of, texts_of, type_of

_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
#: Slots of a filter: as many a gram as make false positives rare, and no more than the hash bits tell apart.
SLOTS_PER_GRAM, MOST_SLOTS, MOST_HASHES = 10, 1 << 20, 3


def _grams(part: Rows) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, row): each run of four bytes after all but letters became one space; rows are padded."""
    letters = _LETTER[part.data]
    starts, ends, row = part.spans(letters)
    if not len(starts):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    # Each word's bytes and one space after it, behind one space: " word word ".
    size = ends - starts
    head = np.concatenate(([True], row[1:] != row[:-1]))
    at = np.cumsum(size + 1 + head)
    buffer = np.full(at[-1], 0x20, np.uint8)
    where = np.repeat(at - size - 1, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    buffer[where] = part.data[letters]
    owner = np.repeat(row, size + 1 + head)
    b = buffer.astype(np.uint32)
    gram = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    whole = owner[:-3] == owner[3:]
    return gram[whole], owner[:-3][whole]


@dataclass
class Filters:
    """Bit-sliced Bloom filters of up to 64 languages for each plane of masks."""

    languages: list[str]
    masks: np.ndarray
    hashes: int

    def __post_init__(self) -> None:
        if self.masks.shape[1] > MOST_SLOTS or self.hashes > MOST_HASHES:
            raise ValueError(f"a filter has at most {MOST_SLOTS} slots and {MOST_HASHES} hashes: 20 bits of a hash are one slot's")

    def slots(self, grams: np.ndarray) -> list[np.ndarray]:
        drawn = mix(grams.astype(_U) + _U(0x9E3779B97F4A7C15))
        return [((drawn >> _U(20 * k)) & _U(self.masks.shape[1] - 1)).astype(np.int64) for k in range(self.hashes)]

    def false_positive(self) -> np.ndarray:
        """For each language the chance that an n-gram it lacks passes."""
        fill = [((self.masks[i // 64] >> _U(i % 64)) & _U(1)).mean() for i in range(len(self.languages))]
        return np.array(fill) ** self.hashes

    def hits(self, grams: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """(rows, languages): the n-grams of each row that each language's filter contains."""
        slots = self.slots(grams)
        out = np.zeros((rows, len(self.languages)), np.int64)
        for plane in range(len(self.masks)):
            found = self.masks[plane][slots[0]]
            for s in slots[1:]:
                found = found & self.masks[plane][s]
            for bit in range(min(64, len(self.languages) - 64 * plane)):
                out[:, 64 * plane + bit] = by_row(((found >> _U(bit)) & _U(1)).astype(np.int8), row, rows)
        return out


def fit(docs: DataFrame, per_language: int = 3000, least_share: float = 1e-5, hashes: int = 3, most_languages: int = 1024) -> Filters:
    """Filters from the text and lang of labelled ``docs`` (doc_id, text, lang; null lang is left out).

    A language's n-grams are those that make up ``least_share`` or more of the n-grams of about
    ``per_language`` of its documents (all, if it has fewer), drawn by a hash of doc_id. So a language adds at
    most 1 / least_share n-grams, which bounds what comes to the driver. Slots are SLOTS_PER_GRAM times the n-grams of the language that has
    most, rounded up to a power of two and at most MOST_SLOTS. More than ``most_languages`` values of lang are an error: such a column doesn't name languages.
    """
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).orderBy("lang").limit(most_languages + 1).collect()
    if len(sizes) > most_languages:
        raise ValueError(f"lang has more than {most_languages} values")
    languages = [r["lang"] for r in sizes]
    share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["docs"])))) if sizes else F.lit(None)
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1_000_003 * share[F.col("lang")]) if sizes else known
    number = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for part in rows_of(batch.column("text")):
                grams, row = _grams(part)
                keys, n = np.unique(lang[part.first + row] << 32 | grams, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], names=["key", "n"])

    counts = texts_of(sample, "text", "lang").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("l", F.shiftright("key", 32))
    totals = {r["l"]: r["n"] for r in counts.groupBy("l").agg(F.sum("n").alias("n")).collect()}
    least = F.create_map(*(F.lit(x) for l, n in totals.items() for x in (l, least_share * n))) if totals else F.lit(None)
    kept = counts.filter(F.col("n") >= least[F.col("l")]).select("key").toPandas()["key"].to_numpy(np.int64) if totals else np.empty(0, np.int64)
    sets = [(kept[kept >> 32 == l] & 0xFFFFFFFF).astype(np.uint32) for l in range(len(languages))]
    slots = min(MOST_SLOTS, 1 << max(10, (SLOTS_PER_GRAM * max(map(len, sets), default=0)).bit_length()))
    made = Filters(languages, np.zeros((max(1, -(-len(languages) // 64)), slots), _U), hashes)
    for l, own in enumerate(sets):
        for s in made.slots(own):
            made.masks[l // 64][np.unique(s)] |= _U(1 << l % 64)
    return made


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score) of each row of ``docs`` (doc_id, text).

    score is the share of the text's n-grams that the predicted language contains, corrected for
    false positives: near 1 for clean prose and near 0 for a text in no learned language.

    * A null text, one without letters, and any text if no language was learned is ``und`` with
      score 0. ``und`` needs no letter in Unicode's sense; a text of other bytes above ASCII only (say, emoji)
      has none.
    * Equal counts go to the language that sorts first. Repeated rows get equal answers.
    * An empty table gives an empty one. Other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast((filters, filters.false_positive()))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, chance = held.value
        names = np.array([*own.languages, "und"], object)
        for batch in batches:
            texts = batch.column("text")
            for part in rows_of(texts):
                grams, row = _grams(part)
                n = len(part)
                total = np.bincount(row, minlength=n)[:, None]
                share = np.zeros((n, max(1, len(own.languages))))
                if own.languages:
                    share = (own.hits(grams, row, n) - total * chance) / np.maximum(1e-9, total * (1 - chance))
                best = share.argmax(1)
                score = np.clip(share[np.arange(n), best], 0, 1)
                ascii_letters = part.per_row((part.data < 0x80) & _LETTER[part.data]) > 0
                none = np.full(n, not own.languages)
                for r in np.flatnonzero(~ascii_letters):
                    text = texts[part.first + int(r)].as_py() or ""
                    none[r] |= not any(c.isalpha() for c in text)
                best = np.where(none, len(own.languages), best)
                score = np.where(none, 0.0, score)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(part.first, n), pa.array(names[best].tolist(), pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return texts_of(docs).mapInArrow(make, f"doc_id {type_of(docs, 'doc_id')}, lang_pred string, score double")


def held_out() -> Column:
    """Whether a row of (doc_id) is kept from learning: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
