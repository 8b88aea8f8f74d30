"""Pipeline stages: operators whose decisions take effect on a table of documents.

Each takes documents (doc_id, text, lang, source and any others) and returns rows of them with the same columns. What an
operator rejects is a set of ids or of text keys, far fewer than documents, that is joined away; Spark broadcasts it where
it is small and shuffles otherwise. Keys that a stage adds have names that no other column has, so a table may have
columns of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dyelake.functions.storage import written
from dyelake.llm import language_id
from dyelake.llm.decontaminate import contamination
from dyelake.llm.mixing import mixed
from dyelake.llm.near_dedup import near_duplicates
from dyelake.llm.sharding import kd_shards

_KEY, _GONE, _WHOLE = "key of the stage", "key that goes", "print of the row"


def _text_key() -> Column:
    """128 bits of a row's text: verdicts on a text alone are joined back by it, also without doc_id."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def _hashable(docs: DataFrame) -> list[Column]:
    """The columns as they can be hashed: what holds a map or a variant as JSON."""
    odd = lambda kind: "map<" in kind or "variant" in kind
    return [F.to_json(F.struct(c)) if odd(kind) else c for c, (_, kind) in zip(_columns(docs), docs.dtypes, strict=True)]


def _without(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose key is in ``gone`` (one column); a null key is in none."""
    keyed = docs.select(*_columns(docs), key.alias(_KEY))
    return keyed.join(gone.toDF(_GONE), F.col(_KEY) == F.col(_GONE), "left_anti").select(*_columns(docs))


def known_language(docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """Documents whose text is in a language learned from ``docs``' lang column.

    Rejected are texts without letters (null and empty ones among them) and those of whose n-grams the best language has less
    than ``least_score``. Where no row has a lang, nothing was learned and only texts without letters go. Rows of equal text
    share a verdict, also repeated rows and rows without doc_id. An empty table gives an empty one.
    """
    learned = language_id.fit(docs.filter(~language_id.held_out()))
    if not learned.languages:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    found = language_id.identify(docs.select(_text_key().alias("doc_id"), "text"), learned)
    gone = written(found.filter((F.col("lang_pred") == "und") | (F.col("score") < least_score)).select("doc_id").distinct())
    return _without(docs, _text_key(), gone)


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest doc_id.

    Only near copies go. Where a doc_id is null or has several rows, each row is a document of its own, and of a group the
    row least by doc_id (nulls last), hash of doc_id and text, and hash of all columns stays; rows equal in all columns are one. Documents
    without words (null and empty texts too) are in no group and stay. An empty table gives an empty one.
    """
    if docs.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty():
        gone = near_duplicates(docs, width, percent).filter("NOT kept").select("doc_id")
        return _without(docs, F.col("doc_id"), written(gone))
    words = F.coalesce(F.col("text").rlike(r"[^\x09-\x0D\x20]"), F.lit(False))
    own = F.xxhash64("doc_id", "text").alias(_GONE)
    # Copies of a whole row are one; the rows that are left get numbers, which stay as they are once written.
    keyed = docs.filter(words).select(*_columns(docs), own, F.xxhash64(*_hashable(docs)).alias(_WHOLE)).dropDuplicates([_GONE, _WHOLE])
    keyed = written(keyed.withColumn(_KEY, F.monotonically_increasing_id()))
    found = near_duplicates(keyed.select(F.col(_KEY).alias("doc_id"), "text"), width, percent).select(F.col("doc_id").alias("node"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("null"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col(_GONE), F.col(_WHOLE), F.col(_KEY).alias("stays"))
    best = keyed.select(order.alias("row"), F.col(_KEY)).join(found, F.col(_KEY) == F.col("node")).groupBy("component_id").agg(F.min("row").alias("row"))
    stay = written(best.select(F.col("row.stays").alias("stays")))
    return keyed.join(stay, F.col(_KEY) == F.col("stays"), "left_semi").select(*_columns(docs)).unionByName(docs.filter(~words))


def uncontaminated(docs: DataFrame, bench: DataFrame, width: int = 10) -> DataFrame:
    """Documents that hold no ``width``-word window of a benchmark item.

    Rows of equal text share a verdict, also repeated rows and rows without doc_id. Null and empty texts stay, as do all documents if the
    benchmark is empty. An empty table gives an empty one.
    """
    found = contamination(docs.select(_text_key().alias("doc_id"), "text"), bench, width)
    gone = written(found.filter("contaminated").select("doc_id").distinct())
    return _without(docs, _text_key(), gone)


def to_target_weights(docs: DataFrame) -> DataFrame:
    """Documents as the mix takes them, repeated up to twice.

    Texts without words, null ones too, weigh nothing and stay once. A null source is a source of its own. Rows that agree in doc_id,
    source and number of words are taken alike. An empty table gives an empty one.
    """
    return mixed(docs)


def sharded(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard of each row, as kd_shards() deals them out.

    Every row gets its own place, also rows of one doc_id or none and rows that are equal; rows are told apart by numbers that they get once, when they are written. A column of
    ``docs`` that is named like one of these is renamed, with "of the document" behind. An empty table gives an empty one.
    """
    keyed = written(docs.select(*_columns(docs), F.monotonically_increasing_id().alias(_KEY)))
    known = [c for c in ("text", "lang", "source") if c in docs.columns]
    found = kd_shards(keyed.select(F.col(_KEY).alias("doc_id"), *known), shards).withColumnRenamed("doc_id", _GONE)
    facts = [c for c in found.columns if c != _GONE]
    own = [c.alias(f"{name} of the document") if name in facts else c for c, name in zip((F.col(f"x.`{c}`") for c in docs.columns), docs.columns, strict=True)]
    # Places are a few bytes a row: a task holds those of its rows, and texts aren't sorted to be joined.
    both = keyed.alias("x").join(found.hint("shuffle_hash").alias("y"), F.col(f"x.`{_KEY}`") == F.col(f"y.`{_GONE}`"))
    return both.select(*own, *(F.col(f"y.`{c}`") for c in facts))
