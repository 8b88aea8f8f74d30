"""Ranked lexical search over a block index, by presence masks.

The index is a table with a row for each block of documents: their ids and sizes, and the postings of its terms. Of each item,
the documents of a block are grouped by the bitmask of the item's terms that they hold. No document of a group can score
more than the terms of its mask at their best in the block, so groups are evaluated by descending bound, until the bound of the next
one is below the twentieth score found so far: all that is left is safely worse. A share of the blocks is searched first, which gives every item a score to start from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.hash_filter import HashFilter
from dyelake.llm.text import ALNUM, Rows, fingerprints, rows_of, texts_of, type_of

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CHUNK = 8_000_000
#: Terms of the items that are searched for at once: what is broadcast to a search is bounded by it.
MOST_TERMS = 20_000
#: Terms times documents of the dense tables that a search works on.
_CELLS = 8_000_000
#: One block in so many is searched first.
_FIRST = 16


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of ``items`` (item_id, text); equal rows count once, other rows of one item_id together."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", "text").distinct().select("item_id", F.explode(words).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))


def _compact(part: Rows, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(part.data[ALNUM[part.data]])])


def _distinct(part: Rows) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct terms and their hashes; each term's number among them, and its row."""
    starts, ends, row = part.spans(ALNUM[part.data])
    coded = _compact(part, starts, ends).dictionary_encode()
    terms = coded.dictionary
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[: len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], np.uint8) if terms.buffers()[2] is not None else np.empty(0, np.uint8)
    return terms, fingerprints(data, offsets[:-1], offsets[1:]), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), row


def _term_hashes(terms: DataFrame) -> DataFrame:
    """(h) of each of ``terms`` (term)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch.column("term"), _CHUNK):
                if len(part.data):
                    yield pa.RecordBatch.from_arrays([pa.array(_distinct(part)[1].view(np.int64))], names=["h"])

    return texts_of(terms, "term").mapInArrow(make, "h long")


def block_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """A row for each block of ``docs``: ids, sizes (terms with repeats), terms, n_docs of each term, and postings (doc, tf) one term after another.

    A block is an Arrow batch, whole documents of some megabytes. Documents without a term are left out. Of the terms only those in a filter of bounded size
    made from ``terms`` (term) are kept, with some others that pass by mistake.
    """
    wanted = docs.sparkSession.sparkContext.broadcast(HashFilter.of(_term_hashes(terms)))
    schema = f"ids array<{type_of(docs, 'doc_id')}>, sizes array<long>, terms array<string>, n_docs array<int>, doc array<int>, tf array<int>"

    def lists(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch.column("text"), _CHUNK):
                terms, h, term, row = _distinct(part)
                if not len(term):
                    continue
                size = np.bincount(row, minlength=len(part))
                rows = np.flatnonzero(size)
                place = np.cumsum(size > 0) - 1
                keep = wanted.value.has(h)
                kept = np.flatnonzero(keep)
                number = np.cumsum(keep) - 1
                told = keep[term]
                posting, tf = np.unique(number[term[told]] * len(rows) + place[row[told]], return_counts=True)
                n_docs = np.bincount(posting // len(rows), minlength=len(kept)) if len(kept) else np.zeros(0, np.int64)
                ids = batch.column("doc_id").slice(part.first, len(part)).take(pa.array(rows))
                columns = [ids, pa.array(size[rows].astype(np.int64)), terms.take(pa.array(kept)).cast(pa.binary()).cast(pa.string()), *(pa.array(x.astype(np.int32)) for x in (n_docs, posting % len(rows), tf))]
                yield pa.RecordBatch.from_arrays([lists(c) for c in columns], names=["ids", "sizes", "terms", "n_docs", "doc", "tf"])

    return texts_of(docs).mapInArrow(make, schema)


@dataclass
class _Wanted:
    """Items of one search: weights by term, each item's terms and their repeats, and the score that a result must have."""

    terms: dict[str, int]
    weights: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]
    least: np.ndarray


@dataclass
class _Best:
    """The best documents of an item so far: (score, doc_id), equal scores by doc_id, null last."""

    top: int
    least: int
    rows: list[tuple[int, Any]] = field(default_factory=list)

    def add(self, scores: np.ndarray, ids: pa.Array, at: np.ndarray) -> None:
        told = np.flatnonzero(scores >= self.least)
        if not len(told):
            return
        self.rows += zip(scores[told].tolist(), ids.take(pa.array(at[told])).to_pylist(), strict=True)
        self.rows.sort(key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))
        del self.rows[self.top :]
        if len(self.rows) == self.top:
            self.least = max(self.least, self.rows[-1][0])


def _search_block(row: dict[str, pa.Array], mean: tuple[int, int], wanted: _Wanted, best: list[_Best]) -> None:
    """Puts a block's best documents of each item into ``best``."""
    n_all, words_all = mean
    known = [(i, wanted.terms[t]) for i, t in enumerate(row["terms"].to_pylist()) if t in wanted.terms]
    if not known:
        return
    sizes = row["sizes"].to_numpy(zero_copy_only=False)
    m = 75 + (25 * sizes * n_all) // words_all
    doc, tf = row["doc"].to_numpy(zero_copy_only=False).astype(np.int64), row["tf"].to_numpy(zero_copy_only=False).astype(np.int64)
    edges = np.concatenate(([0], np.cumsum(row["n_docs"].to_numpy(zero_copy_only=False))))
    gain = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
    place = np.full(len(wanted.weights), -1)
    place[[t for _, t in known]] = np.arange(len(known))
    width = max(1, _CELLS // len(known))
    for low in range(0, len(sizes), width):
        docs = min(width, len(sizes) - low)
        gains = np.zeros((len(known), docs), np.int32)
        for p, (i, _) in enumerate(known):
            own = slice(edges[i], edges[i + 1])
            inside = (doc[own] >= low) & (doc[own] < low + docs)
            gains[p, doc[own][inside] - low] = gain[own][inside]
        bits = np.packbits(gains > 0, axis=1)
        most = gains.max(axis=1)
        for (terms, times), found in zip(wanted.items, best, strict=True):
            p = place[terms]
            told = p >= 0
            p, weight = p[told], (times * wanted.weights[terms])[told]
            bound = weight * most[p]
            if bound.sum() < found.least:
                continue
            # Groups of equal masks, by what their terms can give at most.
            there = np.unpackbits(bits[p], axis=1, count=docs)
            mask = np.packbits(there, axis=0)
            mask = np.ascontiguousarray(np.vstack((mask, np.zeros((-len(mask) % 8, docs), np.uint8))).T)
            mask = mask.view(np.uint64)[:, 0] if mask.shape[1] == 8 else mask.view(f"V{mask.shape[1]}")[:, 0]
            _, one, group = np.unique(mask, return_index=True, return_inverse=True)
            can = bound @ there[:, one].astype(np.int64)
            order = np.argsort(-can)
            members = np.argsort(group, kind="stable")
            first = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=len(one)))))
            step, k = 1, 0
            while k < len(order) and can[order[k]] >= found.least:
                groups = order[k : k + step]
                groups = groups[can[groups] >= found.least]
                at = np.concatenate([members[first[g] : first[g + 1]] for g in groups])
                found.add(weight @ gains[p][:, at], row["ids"], at + low)
                k, step = k + step, 2 * step


def _search(index: DataFrame, wanted: _Wanted, mean: tuple[int, int], top: int) -> DataFrame:
    """(item, doc_id, score): the best of each task."""
    held = index.sparkSession.sparkContext.broadcast(wanted)
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        best = [_Best(top, int(x)) for x in own.least]
        arrow = None
        for batch in batches:
            arrow = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                _search_block({c: batch.column(c)[i].values for c in batch.schema.names}, mean, own, best)
        for k, b in enumerate(best):
            if b.rows:
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(b.rows), pa.int32()), pa.array([d for _, d in b.rows], arrow), pa.array([s for s, _ in b.rows], pa.int64())], names=["item", "doc_id", "score"])

    return texts_of(index, "ids", "sizes", "terms", "n_docs", "doc", "tf").mapInArrow(make, f"item int, doc_id {kind}, score long")


def _best_of(found: DataFrame, top: int, by: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): for each of ``items`` (item_id, text) its ``top`` documents by the weights of its terms.

    Documents score above 0; equal scores go by ascending doc_id, null last, and repeated rows are documents of their own. Null texts, of
    either side, have no terms; a null item_id is an item like others. Empty tables, and items without terms, give no rows. Columns other than doc_id, item_id and text
    are not looked at. Items are searched in turns of about MOST_TERMS terms, each over the whole index.
    """
    spark = docs.sparkSession
    terms = written(item_terms(items))
    index = written(block_index(docs, terms.select("term").distinct()))
    n_all, words_all = index.agg(F.sum(F.size("sizes")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()
    nothing = spark.createDataFrame([], f"item_id {type_of(items, 'item_id')}, rank int, doc_id {type_of(docs, 'doc_id')}, score long")
    if not n_all:
        return nothing
    df = index.select(F.explode(F.arrays_zip("terms", "n_docs")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.n_docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_all + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    total = terms.count()
    turn = F.pmod(F.xxhash64("item_id"), F.lit(-(-total // MOST_TERMS) or 1)).alias("turn")
    weighed = written(terms.join(df, "term").select(turn, "item_id", "term", "times", weight.alias("weight")), "turn")
    found = None
    for k in range(-(-total // MOST_TERMS) or 1):
        rows = weighed.filter(F.col("turn") == k).groupBy("item_id").agg(F.collect_list(F.struct("term", "times", "weight")).alias("terms")).collect()
        if not rows:
            continue
        number = {t: i for i, t in enumerate(sorted({t["term"] for r in rows for t in r["terms"]}))}
        weights = np.zeros(len(number), np.int64)
        for r in rows:
            weights[[number[t["term"]] for t in r["terms"]]] = [t["weight"] for t in r["terms"]]
        of = [(np.array([number[t["term"]] for t in r["terms"]]), np.array([t["times"] for t in r["terms"]], np.int64)) for r in rows]
        wanted = _Wanted(number, weights, of, np.ones(len(rows), np.int64))
        share = index.filter(F.pmod(F.xxhash64("ids"), F.lit(_FIRST)) == 0)
        for r in _best_of(_search(share, wanted, (n_all, words_all), top), top, "item").filter(F.col("rank") == top).collect():
            wanted.least[r["item"]] = r["score"]
        best = _best_of(_search(index, wanted, (n_all, words_all), top), top, "item")
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(rows)), pa.int32()), "item_id": pa.array([r["item_id"] for r in rows])}))
        names = names.select("item", F.col("item_id").cast(type_of(items, "item_id")))
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    return nothing if found is None else found
