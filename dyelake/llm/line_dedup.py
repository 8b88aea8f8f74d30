"""Line dedup over levelled sorted runs of line keys.

A run is a table of line keys, dealt into buckets by key and sorted within, with the number of documents that hold each
key and the largest doc_id among them. Every batch of documents is brought into the same buckets and merge-anti-joined with the runs there
are: keys that no run has become a run of their own, keys seen before add their counts to the repeats. Whenever a level
holds ``fan_in`` runs they are compacted into one run of the next level, so there are few runs at any time and each key is
rewritten once a level. As all runs have the same buckets, neither merging nor compacting shuffles.

Keys are two independent 64-bit hashes of the line; lines of a corpus of 10**12 lines share both by chance with a probability of 10**-14.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dyelake.functions.storage import Bucketed, written

KEY = ["k1", "k2"]
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: As many of the most frequent keys are broadcast to the lines; any other key has at most one in so many of all lines.
HOT = 1000


def lines_of(text: Column) -> Column:
    """A text's lines; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, least_chars: int) -> DataFrame:
    """(k1, k2, doc_id, row, pos) of each line whose key has ``least_chars`` code points; row is a hash of the text."""
    keys = F.transform(lines_of(F.col("text")), lambda x: F.translate(F.trim(x, F.lit(WHITE)), UPPER, LOWER))
    lines = docs.select("doc_id", F.xxhash64("text").alias("row"), F.posexplode(keys).alias("pos", "line")).filter(F.length("line") >= least_chars)
    return lines.select(F.xxhash64("line").alias("k1"), F.xxhash64(F.lit("second"), "line").alias("k2"), "doc_id", "row", "pos")


class LineRuns:
    """Runs of line keys (k1, k2, n_docs, last_doc) by level; a key is in one run only, later sights of it are in the repeats."""

    def __init__(self, spark: SparkSession, buckets: int = 32, fan_in: int = 2):
        self.spark, self.buckets, self.fan_in = spark, buckets, fan_in
        self.levels: list[list[Bucketed]] = []
        self.repeats: list[DataFrame] = []

    def runs(self) -> list[Bucketed]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Takes in the keys of a batch; all lines of a doc_id must come in one batch, so that documents are counted once."""
        once = lines.select(*KEY, "doc_id").distinct()
        keys = once.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        batch = self._run(keys.repartition(self.buckets, *KEY))
        fresh = reduce(lambda left, run: left.join(run.table().hint("merge"), KEY, "left_anti"), self.runs(), batch.table())
        if not self.runs():
            self._push(0, batch)
            return
        own = self._run(fresh)
        self.repeats.append(written(batch.table().join(own.table().hint("merge"), KEY, "left_anti")))
        batch.drop()
        self._push(0, own)

    def _run(self, keys: DataFrame) -> Bucketed:
        return Bucketed(keys, self.buckets, KEY)

    def _push(self, level: int, run: Bucketed) -> None:
        """Puts a run on a level; a full level is merged into one run of the next. No key is in two runs, so merging is a union bucket by bucket."""
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fan_in:
            full, self.levels[level] = self.levels[level], []
            keys = reduce(DataFrame.unionByName, (r.table() for r in full))
            merged = self._run(keys.groupBy(*KEY).agg(F.first("n_docs").alias("n_docs"), F.first("last_doc").alias("last_doc")))
            for r in full:
                r.drop()
            self._push(level + 1, merged)

    def frequent(self, least_docs: int) -> DataFrame:
        """(k1, k2, n_docs, last_doc) of all keys that ``least_docs`` documents hold."""
        first = reduce(DataFrame.unionByName, (r.table() for r in self.runs()))
        if not self.repeats:
            return first.filter(F.col("n_docs") >= least_docs)
        again = reduce(DataFrame.unionByName, self.repeats).groupBy(*KEY).agg(F.sum("n_docs").alias("more"), F.max("last_doc").alias("later"))
        both = first.join(again, KEY, "left").select(*KEY, (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "later").alias("last_doc"))
        return both.filter(F.col("n_docs") >= least_docs)


def dropped_lines(lines: DataFrame, frequent: DataFrame) -> DataFrame:
    """(doc_id, row, gone): places of the lines to drop, for each document that loses some.

    A key that very many lines have would fill one task of a shuffled join. The HOT most frequent keys, a table of bounded
    size, are therefore broadcast; of any other key there are few lines.
    """
    hot = written(frequent.orderBy(F.desc("n_docs"), *KEY).limit(HOT))
    rest = frequent.join(F.broadcast(hot), KEY, "left_anti")
    found = lines.join(F.broadcast(hot), KEY).unionByName(lines.join(F.broadcast(hot), KEY, "left_anti").join(rest, KEY))
    lost = found.filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    return lost.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("gone"))


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, batches: int = 4, buckets: int = 32, fan_in: int = 2) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): texts without the lines that ``least_docs`` documents share, except in the largest doc_id that has them.

    A line counts without white space at its ends and with A-Z in lower case, if ``least_chars`` code points are left. Documents are dealt into
    ``batches`` by doc_id; rows of one doc_id are one document. Rows without doc_id are one document too, smaller than all others.
    Null and empty texts have one empty line and stay (null becomes empty). Lines left stay in order and as they are, those with
    a carriage return too. Repeated rows come back as often as they were given. An empty table gives an empty one; other columns are not looked at.
    ``buckets`` should give buckets of keys (32 bytes a line) that fit in a task.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    lines = written(keyed_lines(docs, least_chars).select("*", batch), "batch")
    runs = LineRuns(spark, buckets, fan_in)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    gone = dropped_lines(lines.drop("batch"), written(runs.frequent(least_docs)))
    for run in runs.runs():
        run.drop()
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    on = own["doc_id"].eqNullSafe(gone["doc_id"]) & (own["row"] == gone["row"])
    rows = own.join(gone, on, "left").select(own["doc_id"], F.coalesce("text", F.lit("")).alias("text"), "gone", lines_of(F.col("text")).alias("lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    kept = F.array_join(F.transform(places, lambda p: F.get("lines", p)), "\n")
    return rows.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"),
    )
