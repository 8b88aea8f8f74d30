"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source is a line of words: its documents one after another in a seeded random order. Its target cuts that line
(taken round again, if the target exceeds the source) into blocks, all sources' blocks about equal in words.
The numbers of blocks by source are the mix's exact quotas. A binary tree over the output shards deals them
out: at each node a uniform draw without replacement of half the node's blocks goes left, which makes
the left side's numbers by source multivariate-hypergeometric, and quotas are kept exactly at every level.
A shard then draws that many blocks of each source's permuted list, the next ones that no shard before it drew, and
what it takes is put in the order of a seeded hash.

All of it is DataFrame work. Documents are only ever summed in small groups: a line's prefix sums are
made of three levels of digest prefixes, so a source of any size is spread over many tasks. The tree works on
numbers of blocks, which are as many as shards ask for, whatever the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dyelake.functions.storage import written

#: Weights of the sources by rank, repeating; share of all words to take; most passes over a source.
WEIGHTS, SHARE, MOST_PASSES = (5, 2, 1), 1.5, 2
SHARDS, BLOCKS_PER_SHARD, SEED = 16, 64, 17
#: Bytes that a shard of a large mix has, and most shards of one tree.
SHARD_BYTES, MOST_SHARDS = 4_000_000_000, 1024

_WORDS = r"[^\x20\x09-\x0D]+"


def _draw(*parts: Column | str | int) -> Column:
    """A seeded random value: the hex digest of the parts."""
    return F.md5(F.concat_ws(":", *(p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts)).cast("binary"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _words(text: Column | str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, key): size in words, key the order of the seeded permutation, of doc_id or else of the text."""
    known = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return docs.select("doc_id", "source", _words().alias("size"), _draw(seed, known).alias("key"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, target) by water-filling.

    Sources in order of code points, null last, have WEIGHTS in turn; their targets share SHARE of all words, none is
    above MOST_PASSES times its source's words, and what a full source can't take goes to the others by
    weight. One row a source: sources number far fewer than documents.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank + 1).cast("int"))
    rows = each.withColumn("w", weight.cast("long")).withColumn("cap", F.col("source_size") * MOST_PASSES)
    # Sources fill up in the order of cap / weight. Where the level of the rest is first below the next one's, it stays.
    fill = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before, rest = fill.rowsBetween(W.unboundedPreceding, -1), fill.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    rows = rows.withColumns({"full": F.coalesce(F.sum("cap").over(before), F.lit(0)), "left": F.sum("w").over(rest), "all": F.sum("source_size").over(everything)})
    rows = rows.withColumn("open", F.col("all") * SHARE - F.col("full"))
    # The first source, in this order, that isn't filled; the level is open words a unit of weight there.
    first = F.min(F.when(F.col("open") * F.col("w") <= F.col("cap") * F.col("left"), F.struct((F.col("cap") / F.col("w")).alias("r"), F.col("full"), "open", "left"))).over(everything)
    rows = rows.withColumn("level", first)
    target = F.least(F.col("cap").cast("double"), F.col("level.open") * F.col("w") / F.col("level.left"))
    return rows.select("source", "source_size", target.alias("target"))


def lines(sized: DataFrame) -> DataFrame:
    """Rows of ``sized`` that have words, with ``start``: the words of the document's source before it in the permuted line."""
    held = sized.filter("size > 0").withColumns({"a": F.substring("key", 1, 2), "b": F.substring("key", 1, 4), "s": _key()})
    before = lambda of, by, order: F.coalesce(F.sum(of).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = written(held.groupBy("s", "a", "b").agg(F.sum("size").alias("words")))
    wide = parts.groupBy("s", "a").agg(F.sum("words").alias("words"))
    wide = wide.select("s", "a", before("words", ["s"], ["a"]).alias("before_a"))
    parts = parts.select("s", "a", "b", before("words", ["s", "a"], ["b"]).alias("before_b")).join(written(wide), ["s", "a"])
    parts = written(parts.select("s", "b", (F.col("before_a") + F.col("before_b")).alias("before")))
    own = held.withColumn("own", before("size", ["s", "b"], ["key", "doc_id", "size"]))
    return own.join(parts, ["s", "b"]).withColumn("start", F.col("before") + F.col("own")).drop("a", "b", "before", "own")


def quotas(aims: DataFrame, shards: int = SHARDS, blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """(source, source_size, target, blocks): whole blocks of each source, one at least where the target isn't 0."""
    total = F.sum("target").over(W.partitionBy())
    blocks = F.when(F.col("target") > 0, F.greatest(F.lit(1), F.round(F.col("target") / total * shards * blocks_per_shard))).otherwise(0)
    return aims.select("source", "source_size", "target", blocks.cast("long").alias("blocks"))


def splitting_tree(quota: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(shard, s, first_block, n_blocks): which of a source's permuted blocks each shard draws.

    A node is one row with the numbers of blocks by source. Its blocks, written out as source numbers
    and sorted by a seeded digest, are a uniform permutation; the first of them, as many as the left child has
    room for, go left. The children's numbers add up to the node's. ``shards`` is a power of two.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("shards is a power of two")
    ordered = F.sort_array(F.collect_list(F.struct(_key().alias("s"), "blocks")))
    node = quota.agg(ordered.alias("q")).select(F.col("q.s").alias("names"), F.col("q.blocks").alias("n"), F.lit(0).cast("long").alias("node"))
    for level in range(shards.bit_length() - 1):
        units = F.flatten(F.transform("n", lambda c, i: F.array_repeat(i, c.cast("int"))))
        drawn = F.transform(F.array_sort(F.transform(units, lambda s, i: F.struct(_draw(seed, "tree", level, F.col("node"), i).alias("h"), i.alias("i"), s.alias("s")))), lambda x: x["s"])  # noqa: B023
        node = node.withColumn("drawn", drawn).withColumn("half", F.expr("slice(drawn, 1, CAST(size(drawn) DIV 2 AS INT))"))
        left = F.transform("n", lambda c, i: F.size(F.filter("half", lambda s: s == i)).cast("long"))
        node = node.withColumn("left", left)
        child = F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("n")), F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("n", "left", lambda a, b: a - b).alias("n"))))
        node = node.select("names", child.alias("c")).select("names", "c.n", "c.node")
        # Levels deeper than this are worked out by as many tasks as there are nodes.
        node = written(node.repartition("node")) if level % 5 == 4 else node
    rows = node.select(F.col("node").cast("int").alias("shard"), F.explode(F.arrays_zip("names", "n")).alias("x")).select("shard", F.col("x.names").alias("s"), F.col("x.n").alias("n_blocks"))
    first = F.coalesce(F.sum("n_blocks").over(W.partitionBy("s").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("first_block", first).filter("n_blocks > 0")


def shard_of_blocks(quota: DataFrame, drawn: DataFrame, seed: int = SEED) -> DataFrame:
    """(s, source_size, target, goal, blocks, shards): each source's plan; shards has the shard of every block of its line.

    The source's blocks are permuted by a seeded digest, and a shard has those at the places that splitting_tree() gives it. One row a
    source; the arrays have as many entries as there are blocks in all.
    """
    by_place = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("shard", "n_blocks"))), lambda x: F.array_repeat(x["shard"], x["n_blocks"].cast("int"))))
    plan = quota.withColumn("s", _key()).join(drawn.groupBy("s").agg(by_place.alias("by_place")), "s", "left")
    every = F.when(F.col("blocks") > 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array().cast("array<bigint>"))
    permuted = F.array_sort(F.transform(every, lambda k: F.struct(_draw(seed, "block", F.col("s"), k).alias("h"), k.alias("k"))))
    shards = F.transform(F.array_sort(F.zip_with(permuted, "by_place", lambda x, p: F.struct(x["k"].alias("k"), p.alias("shard")))), lambda x: x["shard"])
    return plan.select("s", "source_size", "target", F.round("target").cast("long").alias("goal"), "blocks", F.coalesce(shards, F.array().cast("array<int>")).alias("shards"))


def _key(source: str = "source") -> Column:
    """A source as a join key: null is a source of its own, last in the order of keys."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~null"))


def taken_pieces(line: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, start, source_size, target, pieces, taken) of lines() rows and shard_of_blocks().

    pieces has (shard, block, place, words) for each block of the source that takes some of the document, in the line's order: the block's
    shard, its number, the order in which the shard has it, and how many words. taken is their sum. Block k of a source ends
    before word (k + 1) * goal DIV blocks of its line, going round, so a source's sum is its target, rounded, and taken is at most
    MOST_PASSES times the size.
    """
    held = line.join(plan, "s", "left")
    goal, blocks = F.col("goal"), F.col("blocks")

    def of_pass(k: int) -> Column:
        low = F.col("start") + k * F.col("source_size")
        high = F.least(low + F.col("size"), goal)
        # Word w lies in block ((w + 1) * blocks - 1) DIV goal.
        first, last = _div((low + 1) * blocks - 1, goal), _div(high * blocks - 1, goal)
        edge = lambda b: _div(b * goal, blocks)
        made = F.transform(
            F.sequence(first, last),
            lambda b: F.struct(
                F.get("shards", b.cast("int")).alias("shard"), b.alias("block"), F.substring(_draw(seed, "place", F.col("key"), b), 1, 8).alias("place"), (F.least(high, edge(b + 1)) - F.greatest(low, edge(b))).alias("words")
            ),
        )
        return F.when((low < high) & (F.col("size") > 0), made).otherwise(F.array().cast("array<struct<shard:int,block:bigint,place:string,words:bigint>>"))

    held = held.withColumn("pieces", F.concat(*(of_pass(k) for k in range(MOST_PASSES))))
    return held.select("doc_id", "source", "size", "start", "source_size", "target", "pieces", F.aggregate("pieces", F.lit(0).cast("long"), lambda s, x: s + x["words"]).alias("taken"))


def plan_mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, start, source_size, target, pieces, taken) of each row of ``docs`` (doc_id, text, source).

    size counts the text's words (runs of characters other than ASCII white space), taken the words that the
    mix takes of the document, repeats counted, and pieces says which output shard takes how many of them as part of which of the source's
    blocks, and in what order it has them. A source's taken words add up to its target, rounded to a word: the one document at the end
    of its line is taken in part.

    Null and empty texts have size 0, no place in a line (start is null) and no pieces. A null source is a source, the last in
    order. Documents of one doc_id are placed one by one, equal rows next to each other; those of none go by their texts. An empty
    table gives an empty one; other columns are ignored. Runs agree: all draws are seeded digests.
    """
    sized = written(sizes(docs, seed))
    quota = written(quotas(targets(sized), shards))
    plan = written(shard_of_blocks(quota, splitting_tree(quota, shards, seed), seed))
    rest = sized.filter("size = 0").withColumns({"s": _key(), "start": F.lit(None).cast("long")})
    return taken_pieces(lines(sized).unionByName(rest), plan, seed)


def digest(planned: DataFrame) -> DataFrame:
    """plan_mix() rows with pieces as text: shard:block:place:words of each, comma-joined."""
    text = F.array_join(F.transform("pieces", lambda x: F.concat_ws(":", x["shard"].cast("string"), x["block"].cast("string"), x["place"], x["words"].cast("string"))), ",")
    return planned.select("doc_id", "size", "source_size", "target", "taken", text.alias("pieces"))


def shards_for(size: int) -> int:
    """Shards of a mix of about ``size`` bytes: a power of two, from SHARDS to MOST_SHARDS."""
    return min(MOST_SHARDS, max(SHARDS, 1 << (size // SHARD_BYTES).bit_length()))


def mixed(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as the mix takes them, with ``docs``' columns: whole documents, repeated up to MOST_PASSES times.

    A document at the end of its source's line is taken once more if its middle lies in the target. Documents
    without words weigh nothing and are taken once. A copy goes to an output shard that drew words of the document. Copies are dealt out by
    ranges of the shard and, within it, of the seeded place, and sorted so: output partitions, read in order, are the shards one after another, each shuffled.

    Rows that agree in doc_id, source and size are taken alike, as the first of them in the line. Other cases
    as in plan_mix(). Without ``shards`` there are as many as the texts' bytes ask for.
    """
    if shards is None:
        shards = shards_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    first = plan_mix(docs, shards, seed).groupBy("doc_id", "source", "size").agg(F.min(F.struct("start", "taken", "pieces")).alias("c"))
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("c.taken") / F.col("size") + 0.5)).cast("int")
    # A copy goes where a piece of the document goes: the first copy with the first piece, the next with the last.
    none = F.struct(F.lit(0).alias("shard"), F.lit("").alias("place"))
    at = lambda k: F.get("c.pieces", F.when(k == 0, 0).otherwise(F.size("c.pieces") - 1))
    to = lambda k: F.coalesce(F.when(at(k).isNotNull(), F.struct(at(k)["shard"].alias("shard"), at(k)["place"].alias("place"))), none)
    chosen = first.withColumn("copies", copies).filter("copies > 0").select("doc_id", "source", "size", F.transform(F.sequence(F.lit(0), F.col("copies") - 1), to).alias("to"))
    names = docs.columns
    whole = docs.withColumn("size of the mix", _words()).alias("x")
    match = F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & F.col("x.source").eqNullSafe(F.col("y.source")) & (F.col("x.size of the mix") == F.col("y.size"))
    # Verdicts are a few bytes a document: a task holds those of its documents, and texts aren't sorted to be joined.
    out = whole.join(chosen.hint("shuffle_hash").alias("y"), match).select(*(F.col(f"x.`{c}`") for c in names), F.explode("y.to").alias("place of the mix"))
    return out.repartitionByRange("place of the mix").sortWithinPartitions("place of the mix").select(*(F.col(f"`{c}`") for c in names))
