"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

The plan keeps every step distributed and every group splittable:

1. one pass over the texts makes a compact sketch of each document: the size of its shingle set, a
   128-bit key of the whole set, and the band keys of its SuperMinHash signature;
2. documents with equal sets are one class, stood for by their smallest id, so that groups of
   exact copies of any size never meet the band join;
3. in each band bucket the classes are compared with the bucket's most central class only (the one
   whose band keys are the most shared), which keeps the pairs linear in the bucket; pairs are
   confirmed on full shingle sets;
4. after a union-find, classes that their centre didn't take in may still be linked with others of the centre's
   classes. What such classes share beyond what the centre has lies in their differences with it, so these are joined by
   prefixes: of each difference, in the order of how many classes of the centre have an element, only as many of the
   rarest as two linked classes can't both do without. So no link is lost for want of a centre, and the variants of one
   template, however many, meet only where they share rare elements. Of letters filled in from one form all elements are common; such
   classes meet in bands of a much longer signature instead. Pairs are confirmed on full sets;
5. union-find again over all confirmed links.

Union-find runs as large-star and small-star rounds over the table of links: each round is a
grouped minimum and a join, and each is written out, so nothing is collected and a lost executor
costs one round at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm.text import NOT_SPACE, Rows, fingerprints, mix, rows_of, shingles, texts_of

#: Signature slots, and rows of a band. A pair at similarity 0.85 shares no band with
#: probability (1 - 0.85**6)**32, 3e-7; one at 0.3 shares some band with probability 0.02.
SLOTS, BAND_ROWS = 192, 6
#: Elements whose long signatures are made together.
LONG_ELEMENTS = 6000
_U = np.uint64


def super_minhash(hashes: np.ndarray, row: np.ndarray, rows: int, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures of many sets at once: an array (rows, slots), infinite for empty sets.

    Element e visits the slots in the order of a random permutation of its own; its value at the
    slot visited in step j is j + u with u uniform in [0, 1), and a slot keeps the least value. As
    an element gives each rank to one slot only, the slots are negatively correlated and the
    estimate of similarity varies less than with independent hashes. Step j only makes values
    from j on, so a set stops as soon as no slot holds more than that: the early stop. All sets
    of the batch take a step together; sets that have stopped leave.
    """
    sketch = np.full(rows * slots, np.inf)
    live, at, order = hashes, row, None
    for j in range(slots):
        if not len(live):
            break
        drawn = mix(live + _U((0x9E3779B97F4A7C15 * (j + 1)) & (2**64 - 1)))
        u = (drawn >> _U(11)).astype(np.float64) * 2.0**-53
        pick = j + (((drawn * _U(0x9FB21C651E98DF25) >> _U(32)) * _U(slots - j)) >> _U(32)).astype(np.int64)
        if order is None:
            slot = pick
        else:
            each = np.arange(len(live))
            slot = order[each, pick].astype(np.int64)
            order[each, pick] = order[each, j]
        np.minimum.at(sketch, at * slots + slot, j + u)
        going = sketch.reshape(rows, slots).max(axis=1) > j + 1
        stay = going[at]
        if order is None:
            # Few sets get here: only now the permutations of their elements are laid out.
            live, at, pick = live[stay], at[stay], pick[stay]
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(live), 1))
            order[np.arange(len(live)), pick] = 0
        else:
            live, at, order = live[stay], at[stay], order[stay]
    return sketch.reshape(rows, slots)


def _sets(part: Rows, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of each row, sorted by hash within a row."""
    starts, ends, row = part.spans(NOT_SPACE[part.data])
    made, at = shingles(fingerprints(part.data, starts, ends), row, len(part), width)
    edges = np.searchsorted(at, np.arange(len(part) + 1))
    own = [np.unique(made[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    sizes = [len(x) for x in own]
    return (np.concatenate(own) if own else np.empty(0, _U)), np.repeat(np.arange(len(part)), sizes)


def sketches(docs: DataFrame, width: int, slots: int = SLOTS, band_rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands array) of each row of (doc_id, text).

    k1 and k2 are equal for equal shingle sets. A row without words has 0 shingles and no bands.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = mix(np.arange(1, band_rows + 1, dtype=_U)) | _U(1)
        for batch in batches:
            for part in rows_of(batch.column("text")):
                hashes, row = _sets(part, width)
                n = len(part)
                size = np.bincount(row, minlength=n)
                edges = np.concatenate(([0], np.cumsum(size)))
                keys = []
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    sums = np.concatenate((np.zeros(1, _U), np.cumsum(mix(hashes ^ _U(salt)), dtype=_U)))
                    keys.append(mix((sums[edges[1:]] - sums[edges[:-1]]) ^ size.astype(_U)).view(np.int64))
                sig = super_minhash(hashes, row, n, slots).view(_U)
                words = mix(sig.reshape(n, slots // band_rows, band_rows) * odd).sum(axis=2, dtype=_U)
                bands = mix(words + np.arange(slots // band_rows, dtype=_U) * _U(0xD1342543DE82EF95)).view(np.int64)
                full = size > 0
                lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(full * bands.shape[1]))).astype(np.int32), bands[full].ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(part.first, n), pa.array(size), pa.array(keys[0]), pa.array(keys[1]), lists],
                    names=["doc_id", "n_shingles", "k1", "k2", "bands"],
                )

    if slots % band_rows:
        raise ValueError("bands are of equal size")
    return texts_of(docs).mapInArrow(make, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles binary): the sorted distinct 64-bit shingle hashes of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in rows_of(batch.column("text")):
                hashes, row = _sets(part, width)
                edges = np.searchsorted(row, np.arange(len(part) + 1))
                sets = [hashes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(part.first, len(part)), pa.array(sets, pa.binary())], names=["doc_id", "shingles"])

    return texts_of(docs).mapInArrow(make, "doc_id long, shingles binary")


def _both(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, x, y): pairs with their sets."""
    wide = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b")
    return texts_of(wide.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a"), "a", "b", "x", "y")


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Each (a, b) of ``pairs`` on full sets: (a, b, n, apart, linked).

    n is the size of b's set, apart that of the symmetric difference with a's, linked says whether
    100 * intersection >= percent * union.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                one, two = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                apart = len(one) + len(two) - 2 * shared
                rows.append((len(two), apart, 100 * shared >= percent * (shared + apart)))
            n, apart, linked = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(n, pa.int64()), pa.array(apart, pa.int64()), pa.array(linked, pa.bool_())], names=["a", "b", "n", "apart", "linked"])

    return _both(pairs, sets).mapInArrow(check, "a long, b long, n long, apart long, linked boolean")


def differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, e): the elements of the symmetric difference of each pair's sets, as an array."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odd = [np.setxor1d(np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U), assume_unique=True) for x, y in zip(batch.column("x"), batch.column("y"), strict=True)]
            edges = np.concatenate(([0], np.cumsum([len(o) for o in odd]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.ListArray.from_arrays(edges, np.concatenate([np.empty(0, _U), *odd]).view(np.int64))], names=["a", "b", "e"])

    return _both(pairs, sets).mapInArrow(make, "a long, b long, e array<long>")


def band_shape(percent: int) -> tuple[int, int]:
    """(rows, bands) of long bands: two sets of that similarity share none with a probability of 3e-7."""
    rows = 16 if percent >= 85 else 14
    return rows, math.ceil(15 / (percent / 100) ** rows)


def long_bands(sets: DataFrame, percent: int) -> DataFrame:
    """(doc_id, bands) of each row of full_sets(): band keys of a SuperMinHash signature that is as long as band_shape() asks."""
    band_rows, bands = band_shape(percent)
    slots = band_rows * bands

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = mix(np.arange(1, band_rows + 1, dtype=_U)) | _U(1)
        number = np.arange(bands, dtype=_U) * _U(0xD1342543DE82EF95)
        for batch in batches:
            each = [np.frombuffer(x.as_buffer(), _U) for x in batch.column("shingles")]
            at = 0
            while at < len(each):
                # A permutation of all slots is laid out for each element that goes on: few sets at a time.
                size, end = 0, at
                while end < len(each) and (end == at or size + len(each[end]) <= LONG_ELEMENTS):
                    size, end = size + len(each[end]), end + 1
                own = each[at:end]
                sig = super_minhash(np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own]), len(own), slots).view(_U)
                keys = mix((mix(sig.reshape(len(own), bands, band_rows) * odd)).sum(axis=2, dtype=_U) + number).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(len(own) + 1, dtype=np.int32) * bands, keys.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(own)), lists], names=["doc_id", "bands"])
                at = end

    return texts_of(sets, "doc_id", "shingles").mapInArrow(make, "doc_id long, bands array<long>")


def loose_pairs(around: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of classes of one centre that may be linked, one of them at least loose, by prefixes of their differences.

    ``around`` (a, b, n, apart, loose, of_b) has centre a's classes b, the sizes of b's set and of its difference with a's, whether
    it isn't a's component's, and its own component. With k = (100 - percent) / (100 + percent), classes x and y of n_x and n_y elements are linked
    if their sets differ in at most k (n_x + n_y) elements; differences D_x and D_y with the centre then share
    (|D_x| + |D_y| - k (n_x + n_y)) / 2 or more. Neither set is longer than the other by more than 100 / percent, |D_x| and |D_y| are no
    further apart than the sets are, and a loose class differs from the centre by more than would link them. So the larger difference shares all but k n
    (1 + 100 / percent) of its elements, and the smaller all but half of that or (1 + k) / 2 of its own; one more element than these, taken in the order
    of rarity, must be common.

    Where elements are common, as in letters filled in from a form, prefixes rule out little. A centre of which they would make more pairs a class than there are long bands goes by these
    instead, if they make fewer: signatures of thousands of slots in bands so long that classes which aren't linked seldom share one, while linked ones
    do so as surely as in the first banding.
    """
    k, longest = (100 - percent) / (100 + percent), 1 + 100 / percent
    each = written(differences(around.select("a", "b"), sets)).select("a", "b", F.explode("e").alias("e"))
    # Elements of one class only come first in the order and join with nothing: their number is what matters.
    common = each.groupBy("a", "e").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    ranked = each.join(common, ["a", "e"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("times", "e"))).alias("es"))
    rows = around.join(ranked, ["a", "b"]).withColumn("alone", F.col("apart") - F.size("es"))
    limit = k * longest * F.col("n")
    first = lambda most: F.explode(F.slice("es", 1, F.greatest(F.lit(0), F.floor(most + 1e-6) + 1 - F.col("alone")).cast("int")))
    rows = written(rows)
    facts = ("a", "b", "n", "apart", "loose", "of_b")
    large = written(rows.select(*facts, first(limit).alias("p")).select(*facts, F.col("p.e").alias("e")))
    small = written(rows.select(*facts, first(F.least(limit / 2, (1 + k) / 2 * F.col("apart"))).alias("p")).select(*facts, F.col("p.e").alias("e")))
    # How many pairs prefixes would make of each centre's classes, and long bands.
    sides = [side.groupBy("a", "e").agg(F.count(F.lit(1)).alias(c), F.count_if("loose").alias(f"{c}_loose")) for side, c in ((large, "x"), (small, "y"))]
    pairs = F.col("x_loose") * F.col("y") + (F.col("x") - F.col("x_loose")) * F.col("y_loose")
    cost = sides[0].join(sides[1], ["a", "e"]).groupBy("a").agg(F.sum(pairs).alias("by_prefix")).join(around.groupBy("a").agg(F.count(F.lit(1)).alias("classes")), "a")
    crowded = written(cost.filter(F.col("by_prefix") > band_shape(percent)[1] * F.col("classes")))
    banded = written(around.join(crowded.select("a"), "a", "left_semi"))
    marked = written(banded.select(*facts).join(long_bands(sets.join(banded.select(F.col("b").alias("doc_id")).distinct(), "doc_id", "left_semi"), percent), F.col("b") == F.col("doc_id")).select(*facts, F.explode("bands").alias("e")))
    shared = marked.groupBy("a", "e").agg(F.count(F.lit(1)).alias("m"), F.min("of_b").alias("low"), F.max("of_b").alias("high"), F.bool_or("loose").alias("any")).filter("low < high AND any")
    marked = written(marked.join(shared, ["a", "e"]))
    by_band = crowded.join(marked.groupBy("a", "e").agg(F.first("m").alias("m")).groupBy("a").agg(F.sum(F.col("m") * F.col("m")).alias("by_band")), "a", "left")
    better = written(by_band.filter(F.coalesce("by_band", F.lit(0)) < F.col("by_prefix")).select("a"))
    marked = marked.join(better, "a", "left_semi").select(*facts, "e")
    large, small = (side.join(better, "a", "left_anti").unionByName(marked) for side in (large, small))
    x, y = large.alias("x"), small.alias("y")
    same = (F.col("x.a") == F.col("y.a")) & (F.col("x.e") == F.col("y.e"))
    may = F.expr(
        f"(x.apart > y.apart OR (x.apart = y.apart AND x.b < y.b)) AND (x.loose OR y.loose) AND x.of_b != y.of_b AND x.apart - y.apart <= {k!r} * (x.n + y.n) + 1e-6 AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)"
    )
    return x.join(y, same & may).select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that ``links`` (a, b) lead to, for each node of a link.

    Alternates large-star and small-star rounds until the links no longer change; then every
    node is linked with its component's smallest node. Rounds grow with the logarithm of the
    longest path, and a node with very many links costs a grouped minimum with partial sums.
    """
    links = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    def star(both: DataFrame, larger: bool) -> DataFrame:
        least = written(both.groupBy("u").agg(F.min("v").alias("w")).withColumn("w", F.least("u", "w")))
        to = both.join(least, "u")
        if larger:
            out = to.filter("v > u").select(F.col("v").alias("u"), F.col("w").alias("v"))
        else:
            out = to.select(F.col("v").alias("u"), F.col("w").alias("v")).unionByName(least.select("u", F.col("w").alias("v")))
        return written(out.filter("u != v").distinct())

    before = state(links)
    while before[0]:
        links = star(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))), True)
        links = star(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False)
        now = state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs`` (doc_id, text).

    Links join documents whose sets of distinct ``width``-word shingles have
    100 * intersection >= percent * union; component_id is the smallest doc_id reachable over
    links, itself included, and kept says whether that is the document's own.

    * Words are runs of bytes other than ASCII white space, with A-Z lower-cased.
    * A text of fewer than ``width`` words has one shingle of all its words; a null text, an empty
      one and one of white space have none, are linked with nothing, and are kept.
    * Rows with one doc_id are one node; each row gets that node's component, and if their texts
      differ, each row's links count for the node.
    * A null doc_id is linked with nothing: its component is null and it is kept.
    * An empty table gives an empty table. Other columns are ignored.
    """
    sketch = written(sketches(docs, width))
    classes = written(sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")))
    # A class's representative, once even where a doc_id has several rows.
    reps = sketch.join(classes.withColumnRenamed("rep", "doc_id"), ["k1", "k2", "doc_id"], "left_semi").dropDuplicates(["k1", "k2", "doc_id"])
    rows = reps.select("doc_id", F.explode("bands").alias("band"))
    shared = written(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    members = written(rows.join(shared, "band"))
    central = written(members.groupBy("doc_id").agg(F.sum("n").alias("c")))
    centres = written(
        members.select("band", "doc_id").join(central, "doc_id").groupBy("band").agg(F.max(F.struct("c", (-F.col("doc_id")).alias("minus"))).alias("h")).select("band", (-F.col("h.minus")).alias("a"))
    )
    pairs = members.select("band", F.col("doc_id").alias("b")).join(centres, "band").filter("a != b").select("a", "b").distinct()
    sets = written(full_sets(docs.filter("doc_id IS NOT NULL").join(central.select("doc_id"), "doc_id", "left_semi"), width).dropDuplicates(["doc_id", "shingles"]))
    around = written(compared(pairs, sets, percent))
    links = around.filter("linked").select("a", "b")
    joined = written(components(links))

    # Classes that their centre didn't take in, against the centre's other classes of other components.
    of = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    around = around.join(of("b"), "b", "left").join(of("a"), "a", "left").withColumns({"of_a": F.coalesce("of_a", "a"), "of_b": F.coalesce("of_b", "b")})
    around = around.withColumn("loose", F.col("of_a") != F.col("of_b"))
    open_centres = written(around.filter("loose").select("a").distinct())
    around = written(around.join(open_centres, "a", "left_semi"))
    links2 = written(compared(loose_pairs(around, sets, percent), sets, percent).filter("linked").select("a", "b"))
    # Rows of one doc_id with different texts are one node: the class ids are linked through it.
    same = sketch.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(classes, ["k1", "k2"]).groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).filter("a < b").select("a", "b")
    joined = components(links.unionByName(links2).unionByName(same))
    joined = written(classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component_id")))
    return sketch.join(joined, ["k1", "k2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    ).withColumn("component_id", F.coalesce("component_id", "doc_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
