"""Benchmark decontamination over a positional inverted index of the training documents.

The index is a table of segments: the whole rows that one task reads together, with the sorted token positions (postings)
of each of the segment's terms. Terms are 64-bit hashes of words. As a term's postings are spread over all
segments, no term, document or passage makes a large group, however frequent it is, and a segment is one row, so a
search moves nothing between tasks.

A search counts each test term over the whole index and orders every window's terms from the rarest. In each
segment it takes up the windows whose rarest term the segment holds, all side by side: each posting of the rarest term,
moved back by the term's offset in the window, is a place where the window may start, and the lists of the next terms are
intersected with it, one after another, until none are left. The test set is searched in blocks of bounded size, kept as arrays, so what
is sent to the tasks doesn't grow with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.text import ALNUM, fingerprints, rows_of, texts_of, type_of

#: Test text of one block at most, in bytes: what the driver reads and sends to tasks at once. A window starts at each of its words
#: and takes 6 bytes a word in a search, so that a block's arrays are some 10 times its text.
BLOCK_BYTES = 4_000_000
SEGMENT_BYTES = 1_000_000
#: Places of windows that a segment's search works on at once.
PLACES = 400_000
#: Words of the longest window of a proximity search: its terms are bits of a number.
MOST_NEAR = 62

_U = np.uint64
_NONE = hashlib.sha256(b"").hexdigest()
_COUNTED = "doc_id {}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_near_items long"


def positional_index(docs: DataFrame, terms: np.ndarray | None = None, gap: int = 64) -> DataFrame:
    """(segment, doc_ids, n_words, terms, counts, postings) over ``docs`` (doc_id, text): one row a segment.

    doc_ids and n_words have an entry a document. terms are the segment's distinct terms in order, counts their postings' numbers, and
    postings (int32, binary) all their positions, term by term. Documents of a segment follow each other in one run of positions with ``gap``
    positions that no token has between them. ``terms`` (sorted hashes) keeps the postings of those terms only: what a search
    of a given test set can use. Without it, all terms are stored.
    """
    kind = type_of(docs, "doc_id")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 32
        if terms is not None:
            sieve = np.zeros(1 << 20, bool)
            sieve[(terms >> _U(44)).astype(np.int64)] = True
        for batch in batches:
            for part in rows_of(batch.column("text"), SEGMENT_BYTES):
                n = len(part)
                starts, ends, row = part.spans(ALNUM[part.data])
                hashes = fingerprints(part.data, starts, ends)
                place = np.arange(len(row), dtype=np.int64) + row * gap
                if terms is not None:
                    some = np.flatnonzero(sieve[(hashes >> _U(44)).astype(np.int64)])
                    at = np.searchsorted(terms, hashes[some])
                    some = some[terms[np.minimum(at, len(terms) - 1)] == hashes[some]] if len(terms) else some[:0]
                    hashes, place = hashes[some], place[some]
                order = np.argsort(hashes, kind="stable")
                hashes = hashes[order]
                heads = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.empty(0, np.int64)
                lists = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment]), lists(batch.column("doc_id").slice(part.first, n)), lists(pa.array(np.bincount(row, minlength=n).astype(np.int64))),
                        lists(pa.array(hashes[heads].view(np.int64))), lists(pa.array(np.diff(np.append(heads, len(hashes))))), pa.array([place[order].astype(np.int32).tobytes()], pa.binary()),
                    ],
                    names=["segment", "doc_ids", "n_words", "terms", "counts", "postings"],
                )
                segment += 1

    return texts_of(docs).mapInArrow(make, f"segment long, doc_ids array<{kind}>, n_words array<long>, terms array<long>, counts array<long>, postings binary")


@dataclass
class Tests:
    """Distinct windows of test items: terms (windows, width) of hashes, length of each, and who has it.

    The items of window w are those numbered items[edges[w] : edges[w + 1]], names being the items' ids in order.
    """

    words: np.ndarray
    length: np.ndarray
    edges: np.ndarray
    items: np.ndarray
    names: list[str]

    @property
    def terms(self) -> np.ndarray:
        return np.unique(self.words[np.arange(self.words.shape[1]) < self.length[:, None]])


def test_windows(rows: list, width: int) -> Tests:
    """The ``width``-word windows of (item_id, text) rows; an item of fewer words is one window."""
    names = sorted({"" if i is None else str(i) for i, _ in rows})
    number = {name: k for k, name in enumerate(names)}
    words, length, owner = [np.empty((0, width), _U)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part in rows_of(pa.array([t for _, t in rows], pa.string())):
        starts, ends, row = part.spans(ALNUM[part.data])
        hashes = np.concatenate((fingerprints(part.data, starts, ends), np.zeros(width, _U)))
        count = np.bincount(row, minlength=len(part))
        first = np.cumsum(count) - count
        # A window starts at each word that has width - 1 more after it, or at the first of a short item.
        at = np.flatnonzero((np.arange(len(row)) - first[row] <= np.maximum(0, count[row] - width)))
        size = np.minimum(count[row[at]], width)
        own = hashes[at[:, None] + np.arange(width)]
        own[np.arange(width) >= size[:, None]] = 0
        words.append(own)
        length.append(size)
        owner.append(np.array([number["" if rows[part.first + r][0] is None else str(rows[part.first + r][0])] for r in range(len(part))], np.int64)[row[at]])
    words, length, owner = np.concatenate(words), np.concatenate(length), np.concatenate(owner)
    whole = np.ascontiguousarray(np.concatenate((words, length[:, None].astype(_U)), axis=1)).view(f"V{8 * (width + 1)}").ravel()
    _, firsts, which = np.unique(whole, return_index=True, return_inverse=True)
    pairs = np.unique(np.stack((which.ravel(), owner), axis=1), axis=0) if len(owner) else np.empty((0, 2), np.int64)
    return Tests(words[firsts], length[firsts], np.searchsorted(pairs[:, 0], np.arange(len(firsts) + 1)), pairs[:, 1], names)


@dataclass
class _Plan:
    """Windows by rarest term: of window w, term[w, j] is the number of its j-th rarest term among ``terms``, at offset[w, j] in it.

    Windows of one rarest term r are numbers start[r] to start[r + 1].
    """

    terms: np.ndarray
    start: np.ndarray
    term: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    edges: np.ndarray
    items: np.ndarray
    names: list[str]


def _plan(tests: Tests, terms: np.ndarray, counts: np.ndarray) -> _Plan:
    """Windows all of whose terms occur, with terms from the rarest (of equal ones the first of the window)."""
    width = tests.words.shape[1]
    inside = np.arange(width) < tests.length[:, None]
    at = np.searchsorted(terms, tests.words)
    at[~inside] = 0
    known = (counts[np.minimum(at, max(0, len(terms) - 1))] > 0) if len(terms) else np.zeros(at.shape, bool)
    fine = np.flatnonzero((known | ~inside).all(axis=1))
    at, inside, length = at[fine], inside[fine], tests.length[fine]
    rarity = np.where(inside, counts[at] if len(terms) else at, np.iinfo(np.int64).max)
    offset = np.argsort(rarity, axis=1, kind="stable")
    term = np.take_along_axis(at, offset, 1)
    order = np.argsort(term[:, 0], kind="stable") if len(term) else np.empty(0, np.int64)
    own = fine[order]
    sizes = tests.edges[own + 1] - tests.edges[own]
    edges = np.concatenate(([0], np.cumsum(sizes)))
    items = tests.items[np.repeat(tests.edges[own], sizes) + np.arange(edges[-1]) - np.repeat(edges[:-1], sizes)]
    return _Plan(terms, np.searchsorted(term[order, 0], np.arange(len(terms) + 1)) if len(term) else np.zeros(len(terms) + 1, np.int64), term[order].astype(np.int32), offset[order].astype(np.int16), length[order].astype(np.int16), edges, items, tests.names)


@dataclass
class _Segment:
    """A segment's postings of test terms. held maps a position to its term's number (-1: none); keys are term << 32 | position, in order."""

    held: np.ndarray
    keys: np.ndarray
    number: np.ndarray
    low: np.ndarray
    count: np.ndarray
    postings: np.ndarray


def _segment(plan: _Plan, terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, size: int) -> _Segment:
    edges = np.cumsum(counts) - counts
    at = np.searchsorted(plan.terms, terms)
    mine = np.flatnonzero(plan.terms[np.minimum(at, len(plan.terms) - 1)] == terms) if len(plan.terms) else np.empty(0, np.int64)
    number, low, count = at[mine], edges[mine], counts[mine]
    each = np.repeat(number, count)
    place = postings[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())].astype(np.int64)
    held = np.full(size, -1, np.int32)
    held[place] = each
    return _Segment(held, each << 32 | place, number, np.cumsum(count) - count, count, place)


def _places(plan: _Plan, seg: _Segment) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, position of its rarest term) of all windows whose rarest term the segment holds, about PLACES at a time."""
    windows = plan.start[seg.number + 1] - plan.start[seg.number]
    window = np.repeat(plan.start[seg.number] - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    low, count = np.repeat(seg.low, windows), np.repeat(seg.count, windows)
    upto = np.cumsum(count)
    first = 0
    while first < len(window):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] - count[first] + PLACES, "right")))
        n, own = count[first:last], slice(first, last)
        yield np.repeat(window[own], n), seg.postings[np.repeat(low[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        first = last


def _exact(plan: _Plan, seg: _Segment, window: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of the places at which the window's terms stand in a row."""
    at = at - plan.offset[window, 0]
    fine = at >= 0
    window, at = window[fine], at[fine]
    for j in range(1, plan.term.shape[1]):
        # Terms of short windows end before j; offsets of what isn't there are passed over.
        there = j < plan.length[window]
        spot = np.minimum(at + plan.offset[window, j], len(seg.held) - 1)
        fine = ~there | (seg.held[spot] == plan.term[window, j])
        window, at = window[fine], at[fine]
        if not len(at):
            break
    return window, at


def _near(plan: _Plan, seg: _Segment, window: np.ndarray, at: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Those places of the rarest term that lie in some run of ``span`` words with all the window's terms."""
    for j in range(1, plan.term.shape[1]):
        there = j < plan.length[window]
        want = plan.term[window, j].astype(np.int64) << 32
        i = np.searchsorted(seg.keys, want | np.maximum(0, at - (span - 1)))
        found = seg.keys[np.minimum(i, len(seg.keys) - 1)]
        fine = ~there | ((i < len(seg.keys)) & (found >= want) & (found <= (want | (at + span - 1))))
        window, at = window[fine], at[fine]
        if not len(at):
            return window, at
    keep = [np.empty(0, np.int64)]
    around = np.arange(1 - span, span)
    for s in range(0, len(at), 20_000):
        own = window[s : s + 20_000]
        spot = at[s : s + 20_000, None] + around
        held = np.where((spot >= 0) & (spot < len(seg.held)), seg.held[np.clip(spot, 0, len(seg.held) - 1)], -1)
        # Bit j of a place: it holds the j-th term.
        bits = np.zeros(held.shape, np.int64)
        for j in range(plan.term.shape[1]):
            bits |= ((held == plan.term[own, j][:, None]) & (j < plan.length[own])[:, None]).astype(np.int64) << j
        every = (np.int64(1) << plan.length[own].astype(np.int64)) - 1
        ok = np.zeros(len(own), bool)
        for low in range(span):
            ok |= np.bitwise_or.reduce(bits[:, low : low + span], axis=1) == every
        keep.append(s + np.flatnonzero(ok))
    keep = np.concatenate(keep)
    return window[keep], at[keep]


def _items_of(plan: _Plan, doc: np.ndarray, window: np.ndarray, n: int) -> tuple[np.ndarray, list[str]]:
    """(edges, names): the sorted ids of the items of the windows found in document d are names[edges[d] : edges[d + 1]]."""
    pairs = np.unique(np.stack((doc, window), axis=1), axis=0) if len(doc) else np.empty((0, 2), np.int64)
    sizes = plan.edges[pairs[:, 1] + 1] - plan.edges[pairs[:, 1]]
    item = plan.items[np.repeat(plan.edges[pairs[:, 1]] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    both = np.unique(np.stack((np.repeat(pairs[:, 0], sizes), item), axis=1), axis=0)
    edges = np.searchsorted(both[:, 0], np.arange(n + 1))
    return edges, [plan.names[i] for i in both[:, 1]]


def _digest(names: list[str]) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def search(index: DataFrame, tests: Tests, near_span: int = 0, gap: int = 64, counted: bool = False) -> DataFrame:
    """(segment, slot, doc_id, n_words, covered binary, items, near_items) of each indexed document, or, ``counted``, contamination()'s columns.

    covered has a (start, end) int32 pair for each run of words of the document inside exact
    matches. items has the ids of items with an exact match, in order. near_items, where ``near_span`` > 0,
    has the ids of items one of whose windows has all its terms, in any order, within near_span words
    of the document (exact matches included). ``gap`` is the index's.
    """
    if near_span and tests.words.shape[1] > MOST_NEAR:
        raise ValueError(f"a proximity search takes windows of {MOST_NEAR} words at most")
    spark = index.sparkSession
    terms = tests.terms
    wanted = spark.createDataFrame(pd.DataFrame({"term": terms.view(np.int64)}), "term long")
    # At most as many terms as a block of tests has words.
    each = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.counts").alias("n"))
    found = each.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(terms), np.int64)
    counts[np.searchsorted(terms, found["term"].to_numpy(np.int64).view(_U))] = found["n"].to_numpy(np.int64)
    held = spark.sparkContext.broadcast(_plan(tests, terms, counts))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = held.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("doc_ids")[k].values
                n_words, own, number = (batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("n_words", "terms", "counts"))
                n = len(ids)
                first = np.cumsum(n_words) - n_words + np.arange(n) * gap
                size = int(first[-1] + n_words[-1]) + 1
                seg = _segment(plan, own.view(_U), number, np.frombuffer(batch.column("postings")[k].as_buffer(), np.int32), size)
                edge = np.zeros(size + 1, np.int32)
                hits, close = [[np.empty(0, np.int64)] * 2], [[np.empty(0, np.int64)] * 2]
                doc_of = lambda at: np.searchsorted(first, at, "right") - 1  # noqa: B023, E731
                for window, at in _places(plan, seg):
                    if near_span:
                        near, spot = _near(plan, seg, window, at, near_span)
                        close.append((doc_of(spot), near))
                        if near_span >= plan.term.shape[1]:
                            # An exact match holds all terms within its own words.
                            window, at = near, spot
                    window, at = _exact(plan, seg, window, at)
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + plan.length[window], -1)
                    hits.append((doc_of(at), window))
                    if near_span:
                        close.append(hits[-1])
                turn = np.diff(np.concatenate(([0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0])))
                starts, ends = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
                owner = doc_of(starts)
                runs = np.stack((starts - first[owner], ends - first[owner]), axis=1).astype(np.int32)
                cut = np.searchsorted(owner, np.arange(n + 1))
                (upto, names), (near_upto, near_names) = _items_of(plan, *map(np.concatenate, zip(*hits, strict=True)), n), _items_of(plan, *map(np.concatenate, zip(*close, strict=True)), n)
                columns = {"doc_id": ids, "n_words": pa.array(n_words)}
                if counted:
                    hit = np.bincount(owner, ends - starts, n).astype(np.int64)
                    digests = [_digest(names[a:b]) if b > a else _NONE for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
                    columns |= {"n_hit": pa.array(hit), "n_items": pa.array(np.diff(upto)), "items_sha256": pa.array(digests, pa.string()), "contaminated": pa.array(hit > 0), "n_near_items": pa.array(np.diff(near_upto))}
                else:
                    lists = lambda edges, own: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(own, pa.string()))
                    columns = {"segment": pa.array(np.full(n, batch.column("segment")[k].as_py())), "slot": pa.array(np.arange(n))} | columns
                    columns |= {"covered": pa.array([runs[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()), "items": lists(upto, names), "near_items": lists(near_upto, near_names)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = _COUNTED.format(kind) if counted else f"segment long, slot long, doc_id {kind}, n_words long, covered binary, items array<string>, near_items array<string>"
    return texts_of(index, *index.columns).mapInArrow(look, schema)


def blocks_of(bench: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Callable[[], list]]:
    """Readers of the (item_id, text) rows of ``bench``, of about ``block_bytes`` of text each."""
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + total // block_bytes
    for k in range(parts):
        part = bench if parts == 1 else bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield lambda part=part: [tuple(r) for r in part.select("item_id", "text").collect()]


def contamination(docs: DataFrame, bench: DataFrame, width: int = 10, near_span: int = 0, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items) per row of ``docs``.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A window is
    ``width`` consecutive words of an item; an item of fewer words, but not none, is one window.
    n_hit counts the document's words inside any occurrence of a window, n_items the items with an
    occurring window, items_sha256 is the hex digest of their ids, sorted as strings and joined by
    commas, n_near_items counts items with a proximity match (0 if near_span is 0).

    * Null and empty texts have no words and are not contaminated; null item ids read as "".
    * Rows with one doc_id, or none, are judged one by one, each on its own text.
    * Without benchmark rows nothing is contaminated; an empty table gives an empty one.
    * Other columns of either table are ignored.
    """
    gap = max(width, near_span) + 1
    index = found = None
    for k, rows in enumerate(blocks := list(blocks_of(bench, block_bytes))):
        tests = test_windows(rows(), width)
        if index is None:
            # Of one block only its own terms are of use; more blocks share an index of all terms.
            index = written(positional_index(docs, tests.terms if len(blocks) == 1 else None, gap))
        if len(blocks) == 1:
            return search(index, tests, near_span, gap, counted=True)
        part = search(index, tests, near_span, gap)
        found = part if k == 0 else found.unionByName(written(part))
    # A document has one row for each block.
    one = lambda name: F.flatten(F.collect_list(name)).alias(name)
    return _counted(found.groupBy("segment", "slot").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("covered").alias("covered"), one("items"), one("near_items")))


def _counted(found: DataFrame) -> DataFrame:
    """Counts and digests of search() results of several blocks."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            hit, digest = [], []
            names = [sorted(set(own)) for own in x.column("items").to_pylist()]
            for own, runs in zip(names, x.column("covered").to_pylist(), strict=True):
                pairs = np.concatenate([np.frombuffer(r, np.int32).reshape(-1, 2) for r in runs])
                pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                reach = np.maximum.accumulate(np.concatenate(([0], pairs[:, 1])))
                hit.append(int(np.maximum(0, pairs[:, 1] - np.maximum(pairs[:, 0], reach[:-1])).sum()))
                digest.append(_digest(own))
            near = [len(set(own)) for own in x.column("near_items").to_pylist()]
            made = [pa.array(hit, pa.int64()), pa.array([len(n) for n in names], pa.int64()), pa.array(digest, pa.string()), pa.array([n > 0 for n in hit], pa.bool_()), pa.array(near, pa.int64())]
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), x.column("n_words"), *made], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items"])

    return found.select("doc_id", "n_words", "covered", "items", "near_items").mapInArrow(make, _COUNTED.format(type_of(found, "doc_id")))
