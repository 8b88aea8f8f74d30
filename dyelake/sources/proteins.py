"""Protein lists: CSV, FASTA and inline lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_inline(lines: DataFrame) -> DataFrame:
    """``lines`` (line) with name and sequence of "name:SEQUENCE"; anything else than two parts is an error."""
    parts = F.split("line", ":")
    bad = F.raise_error(F.concat(F.lit("not name:sequence: "), "line")).cast("array<string>")
    return lines.withColumn("parts", F.when(F.size(parts) == 2, parts).otherwise(bad)).select("*", F.trim(F.col("parts")[0]).alias("name"), F.trim(F.col("parts")[1]).alias("sequence")).drop("parts")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(id, sequence) of each record: a line ">...", then lines of the sequence.

    The id is the second "|" part of the first word after ">", or the first if there is none. Records are split at ">", so a
    record may be of any length and files split over tasks only at files. Text before the first ">" is an error.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select("value", F.input_file_name().alias("file"))
    # Only a file's first record still has its ">".
    text = F.regexp_replace("value", r"^\s*>", "")
    head = F.split(F.regexp_extract(text, r"^([^\r\n]*)", 1), r"\s+")[0]
    parts = F.split(head, r"\|")
    body = F.regexp_replace(F.regexp_replace(text, r"^[^\r\n]*", ""), r"\s", "")
    named = raw.withColumn("first", F.col("value").rlike(r"^\s*>")).filter(F.trim("value") != "")
    files = named.groupBy("file").agg(F.count_if("first").alias("heads"))
    bad = F.raise_error(F.lit("a FASTA file starts with a record")).cast("string")
    out = named.join(files, "file")
    return out.select(F.when(F.col("heads") > 0, F.when(F.size(parts) > 1, parts[1]).otherwise(parts[0])).otherwise(bad).alias("id"), body.alias("sequence"))


def read_protein_csv(spark: SparkSession, path: str) -> DataFrame:
    """(name, sequence, abundance, ptm_locs, report) of a CSV with a header Name, Seq [, Abundance, PTM, POI] in any order.

    Header and cells are trimmed; PTM is "" where absent, abundance null, POI 0. No Name or Seq, and repeated names or sequences,
    are errors. Rows come by abundance and name, highest first, or by name if none has an abundance.
    """
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    found = {c.strip().lower(): c for c in raw.columns}
    for c in ("name", "seq"):
        if c not in found:
            raise ValueError(f"no column {c.title()}")
    take = lambda c, default: F.trim(F.col(f"`{found[c]}`")) if c in found else F.lit(default).cast("string")
    rows = raw.select(
        take("name", "").alias("name"), F.regexp_replace(take("seq", ""), r"\s", "").alias("sequence"), take("abundance", None).cast("double").alias("abundance"),
        F.coalesce(take("ptm", ""), F.lit("")).alias("ptm_locs"), F.coalesce(take("poi", "0").cast("int"), F.lit(0)).alias("report"),
    )
    for key in ("name", "sequence"):
        if rows.groupBy(key).count().filter("count > 1").head(1):
            raise ValueError(f"repeated {key}")
    return rows.orderBy(F.col("abundance").desc_nulls_last(), F.desc("name")) if "abundance" in found else rows.orderBy("name")
