"""The queries of this subpackage and, where SQL can express them, the SQL that DuckDB runs."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dyelake.llm import chat, language_id, mixing, pii, sql
from dyelake.llm.decontaminate import contamination
from dyelake.llm.line_dedup import drop_repeated_lines
from dyelake.llm.near_dedup import near_duplicates
from dyelake.llm.phrases import collocations
from dyelake.llm.quality_model import quality_scores
from dyelake.llm.quality_rules import quality_rules
from dyelake.llm.ranked_search import ranked_search
from dyelake.llm.sharding import kd_shards
from dyelake.llm.token_counts import token_counts
from dyelake.sources.tables import table

#: Where public tokenizers' vocabularies lie; a parameter of the deployment.
TOKENIZERS = os.environ.get("DYELAKE_TOKENIZERS", "/opt/tokenizers")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights of their sources."""
    return mixing.digest(mixing.plan_mix(table(spark, sf_dir, "documents")))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = chat.END + chat.START + "assistant ok"
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.windows(turns.unionByName(more)))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text."""
    docs = table(spark, sf_dir, "documents")
    return pii.digest(pii.personal_data(docs, pii.learn(docs)))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from the labels that aren't held out."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from the languages that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    learned = language_id.fit(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, learned)
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: three-word shingles at similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op7_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    return kd_shards(table(spark, sf_dir, "documents"), 40)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy longest-match token counts of all documents."""
    with open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        return token_counts(table(spark, sf_dir, "documents"), f.read())


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents: windows of ten words; near matches lie within 14."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10, near_span=14)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, their votes weighed, on all documents."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that three documents share, except in the last that has them."""
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"), least_chars=20, least_docs=3)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of two and three words in all documents, by language."""
    return collocations(table(spark, sf_dir, "documents"), least=10, top=2000)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents of each benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_chat_format,
        op3_pii,
        op4_quality_classifier,
        op5_language_id,
        op6_minhash_near_dedup,
        op7_kd_shards,
        op8_token_counts,
        op9_benchmark_decontamination,
        op10_quality_rules,
        op11_line_dedup,
        op12_phrases,
        op13_ranked_search,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_mix_sources": sql.OP1,
    "op2_chat_format": sql.OP2,
    "op6_minhash_near_dedup": sql.OP6,
    "op9_benchmark_decontamination": sql.OP9,
    "op11_line_dedup": sql.OP11,
    "op12_phrases": sql.OP12,
    "op13_ranked_search": sql.OP13,
}
