"""Shards of near-equal bytes by a k-d tree over the documents' metadata.

Each node of the tree holds a box of documents and the number of shards to make of it. It is split along
the dimension in which its documents spread widest, at the weighted quantile that gives either side the bytes of
its shards. The quantile of every node of a level is found by counting: documents fall into bins of their node's
range, bins are summed by a grouped aggregate, and the bin that holds the
quantile is opened again until what is left in it is small beside a shard. So the driver sees a bounded number of
sums, documents don't move, and the tree is a table of one row a node, which is sent to the tasks.

Dimensions are length, shares of non-ASCII and of white-space characters, language and source, each scaled to what the table has. Equal
texts are one point of the space, also where their language or source differ, and a cut never
parts them; only where one text's copies alone outweigh what a cut may miss are they dealt out by doc_id. Documents of one value
go by a hash of their text.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.storage import written

#: Bins of all nodes of a level together, and those of a node at most.
LEVEL_BINS, BINS = 65_536, 1024
#: Levels whose cuts are worked out anew by each pass before the documents' nodes are written.
WRITE_LEVELS = 6
DIMENSIONS = ("length", "non_ascii", "spaces", "lang_place", "source_place")
_FIELDS = (*DIMENSIONS, "tie")
#: The logarithm of more bytes than a text can have.
_LONGEST = 22.0


def points(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, tie, DIMENSIONS) of each row of (doc_id, text) and, where ``docs`` has them, lang and source.

    Copies of a text take the least lang and source of them all. lang_place and source_place are places in the order of code points by
    rows, 0 to 1, and by length within a language or source, so that a cut that falls within one divides it by length. Languages and sources are few
    beside documents.
    """
    kind = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    base = docs.select("doc_id", kind("lang").alias("lang"), kind("source").alias("source"), F.coalesce("text", F.lit("")).alias("t"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    size, chars = F.octet_length("t").cast("long"), F.char_length("t").cast("double")
    share = lambda n: F.when(chars > 0, n / F.greatest(F.lit(1.0), chars)).otherwise(0.0)
    # Equal values go by text first, so that copies stay together, and by doc_id among copies.
    tie = (F.coalesce("text_crc32", F.lit(0)) + F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)) / float(1 << 32)
    spaces = chars - F.char_length(F.translate("t", " \n\t", ""))
    seen = written(
        base.select("doc_id", (size + 16).alias("size"), "text_crc32", F.xxhash64("t").alias("print"), tie.alias("tie"), F.log1p(size.cast("double")).alias("length"), share(size - chars).alias("non_ascii"), share(spaces).alias("spaces"), "lang", "source")
    )
    # Groups of copies of several languages or sources: few, and joined back.
    mixed = seen.groupBy("print", "size").agg(*(f(c).alias(f"{n}_{c}") for c in ("lang", "source") for n, f in (("least", F.min), ("most", F.max))))
    mixed = written(mixed.filter("least_lang != most_lang OR least_source != most_source").select("print", "size", "least_lang", "least_source"))
    seen = seen.join(mixed, ["print", "size"], "left").withColumns({c: F.coalesce(f"least_{c}", c) for c in ("lang", "source")})
    for c in ("lang", "source"):
        counts = seen.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        every = F.sum("n").over(W.partitionBy())
        places = counts.select(c, ((F.sum("n").over(W.orderBy(c)) - F.col("n")) / every).alias("from"), (F.col("n") / every).alias("part"))
        seen = seen.join(written(places), c).withColumn(f"{c}_place", F.col("from") + F.col("part") * F.col("length") / _LONGEST).drop("from", "part")
    return written(seen.select("doc_id", "size", "text_crc32", "tie", *DIMENSIONS))


@dataclass
class _Cut:
    """A node of shards first .. first + count - 1, and where its cut along ``dim`` may lie: values of ``field`` in [low, high], ``before``
    bytes below low.

    field is the dimension itself or, within its one value ``at``, the order of texts and doc_ids. In the end
    a document goes left if its value is below ``at``, or equals it and its tie is below ``tie_at``.
    """

    node: int
    first: int
    count: int
    total: int = 0
    dim: str = ""
    field: str = ""
    low: float = 0.0
    high: float = 0.0
    before: int = 0
    at: float = 0.0
    tie_at: float = float("-inf")

    def narrow(self, bins: list, most_left: float) -> bool:
        """Takes the sums of bins, in order; whether the search goes on."""
        goal, total = self.total * (self.count // 2) / self.count, self.before
        for k, r in enumerate(bins):
            if total + r["size"] < goal and k + 1 < len(bins):
                total += r["size"]
                continue
            # The goal lies in this bin: cut before it, after it, or look into it.
            under, over = goal - total, total + r["size"] - goal
            if min(under, over) > most_left and not (r["low"] == r["high"] and self.field == "tie"):
                self.before = total
                if r["low"] == r["high"]:
                    # One value outweighs what may be missed: it is cut by the order of its texts, then of doc_ids.
                    self.at, self.field, self.low, self.high = r["low"], "tie", 0.0, 1.0
                else:
                    self.low, self.high = r["low"], r["high"]
                return True
            last = over < under and k + 1 == len(bins)
            edge = r["low"] if over >= under else float("inf") if last else bins[k + 1]["low"]
            if self.field == "tie":
                self.tie_at = edge
            elif last:
                # Everything up to and with the last value looked at.
                self.at, self.tie_at = r["high"], edge
            else:
                self.at = edge
            break
        return False


def _sent(df: DataFrame, rows: dict[str, list]) -> DataFrame:
    """A table of one row a node, as many as shards at most, for tasks to look up."""
    return F.broadcast(df.sparkSession.createDataFrame(pa.table(rows)))


def _value(field: str) -> Column:
    return F.get(F.array(*map(F.col, _FIELDS)), F.col(field))


def _run(seen: DataFrame, cuts: list[_Cut], most_left: float) -> None:
    """Carries on the searches, of different nodes, until each has its cut."""
    going = cuts
    while going:
        bins = max(8, min(BINS, LEVEL_BINS // len(going)))
        sent = _sent(seen, {
            "node": [c.node for c in going], "field": [_FIELDS.index(c.field) for c in going], "lo": [float(c.low) for c in going], "hi": [float(c.high) for c in going],
            "own": [_FIELDS.index(c.dim) for c in going], "spot": [float(c.at) for c in going], "tied": [c.field == "tie" for c in going],
        })
        value = F.col("value")
        # A search within one value looks at that value only.
        held = seen.join(sent, "node").withColumn("value", _value("field")).filter((~F.col("tied") | (_value("own") == F.col("spot"))) & (value >= F.col("lo")) & (value <= F.col("hi")))
        spot = F.least(F.lit(bins - 1), F.floor((value - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(5e-324)) * bins)).cast("int")
        sums = held.groupBy("node", spot.alias("bin")).agg(F.sum("size").alias("size"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
        found: dict[int, list] = {c.node: [] for c in going}
        for r in sorted(sums, key=lambda r: r["bin"]):
            found[r["node"]].append(r)
        going = [c for c in going if c.narrow(found[c.node], most_left)]


def _aim(seen: DataFrame, cuts: list[_Cut]) -> None:
    """Gives each node the dimension in which its documents' scaled values deviate most."""
    aggs = [f(d).alias(f"{n}_{d}") for d in DIMENSIONS for f, n in ((F.min, "min"), (F.max, "max"), (F.stddev_pop, "std"))]
    known = {r["node"]: r for r in seen.join(_sent(seen, {"node": [c.node for c in cuts]}), "node").groupBy("node").agg(F.sum("size").alias("total"), *aggs).collect()}
    # A side without documents, of tables smaller than their shards, is no node any more.
    cuts[:] = [c for c in cuts if c.node in known]
    for c in cuts:
        r = known[c.node]
        c.dim = c.field = max(DIMENSIONS, key=lambda d: r[f"std_{d}"] or 0.0)  # noqa: B023
        c.total, c.low, c.high = r["total"], r[f"min_{c.dim}"], r[f"max_{c.dim}"]


def kd_tree(seen: DataFrame, shards: int, slack: float = 0.002) -> DataFrame:
    """points() rows with their shard. A cut misses its byte goal by ``slack`` of a shard, or by half of the document that lies on it."""
    facts = seen.agg(F.sum("size").alias("total"), *(f(d).alias(f"{n}_{d}") for d in DIMENSIONS for f, n in ((F.min, "min"), (F.max, "max")))).first()
    if not facts["total"]:
        return seen.withColumn("shard", F.lit(0))
    scaled = {d: (F.col(d) - facts[f"min_{d}"]) / (facts[f"max_{d}"] - facts[f"min_{d}"] or 1.0) for d in DIMENSIONS}
    seen = seen.withColumns(scaled).withColumn("node", F.lit(1).cast("long"))
    level, leaves = [_Cut(1, 0, shards)], {}
    depth = 0
    while level:
        leaves |= {c.node: c.first for c in level if c.count == 1}
        cuts = [c for c in level if c.count > 1]
        if not cuts:
            break
        _aim(seen, cuts)
        _run(seen, cuts, slack * facts["total"] / shards)
        sent = _sent(seen, {"node": [c.node for c in cuts], "field": [_FIELDS.index(c.dim) for c in cuts], "spot": [float(c.at) for c in cuts], "tie_at": [float(c.tie_at) for c in cuts]})
        below = (_value("field") < F.col("spot")) | ((_value("field") == F.col("spot")) & (F.col("tie") < F.col("tie_at")))
        node = F.when(F.col("field").isNull(), F.col("node")).otherwise(F.col("node") * 2 + F.when(below, 0).otherwise(1))
        seen = seen.join(sent, "node", "left").withColumn("node", node).drop("field", "spot", "tie_at")
        depth += 1
        seen = written(seen) if depth % WRITE_LEVELS == 0 else seen
        level = [_Cut(2 * c.node + k, c.first + k * (c.count // 2), (c.count // 2, c.count - c.count // 2)[k]) for c in cuts for k in (0, 1)]
    return seen.join(_sent(seen, {"node": list(leaves), "shard": list(leaves.values())}), "node").withColumn("shard", F.col("shard").cast("int")).drop("node")


def kd_shards(docs: DataFrame, shards: int = 40) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``docs`` (doc_id, text; lang and source if there).

    The law is ``bytes``: sizes of shards are near equal. size is the text's UTF-8 bytes (null: none) plus 16,
    text_crc32 the text's (null: null), slot counts a shard's rows from 0 without gaps, grown_shard is null. Equal
    texts share a shard unless a cut falls on them that can't be moved without loss of balance.

    Null texts are one point like any other, as are null doc_ids for the order within copies; null languages and sources are empty ones. Rows that
    are equal in all columns get slots of their own. An empty table gives an empty one; other columns are
    ignored. Of fewer documents than shards some shards stay empty.
    """
    seen = kd_tree(points(docs), shards)
    placed = written(seen.select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(4096)).alias("part")))
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    offset = counts.withColumn("from", F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")) - 1
    return placed.withColumn("own", own).join(offset, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("from") + F.col("own")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
