"""Per-field tables and instrument files, and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dyelake.operators.radmat import require_cycles

#: One JSON object a field and cycle.
METADATA = T.StructType([T.StructField(n, T.IntegerType()) for n in ("field_i", "cycle_i")] + [T.StructField(n, T.DoubleType()) for n in ("x", "y", "z", "pfs_offset", "exposure_time", "camera_temp")] + [T.StructField("pfs_status", T.StringType())])


def stack_fields(spark: SparkSession, path: str) -> DataFrame:
    """All fields' rows of a Parquet folder with a part ``field_i=<n>`` for each; fields without rows add none."""
    return spark.read.option("mergeSchema", True).parquet(path)


def stream_fields(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same as a stream: a field's rows come in once its files are there."""
    return spark.readStream.schema(schema).parquet(path)


def read_field_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Stage place and exposure by field and cycle, of JSON files."""
    return spark.read.schema(METADATA).json(path, multiLine=True).withColumnsRenamed({"x": "stage_x", "y": "stage_y", "z": "stage_z"})


def read_scope_tsv(spark: SparkSession, path: str) -> DataFrame:
    """(file, key, value, number) of UTF-16 text in which the two characters \\n part lines and \\t key and value.

    "a/b/c" keys become "a.b.c"; number is the value where it is one.
    """
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.decode("content", "UTF-16").alias("text"))
    line = raw.select("file", F.explode(F.split("text", r"\\n")).alias("line")).filter(F.contains("line", F.lit("\\t")))
    parts = F.split("line", r"\\t")
    value = F.trim(parts[1])
    return line.select("file", F.replace(F.trim(parts[0]), F.lit("/"), F.lit(".")).alias("key"), value.alias("value"), value.try_cast("double").alias("number"))


def export_radmat(radmat: DataFrame, path: str, files: int = 16) -> None:
    """CSV of channel, peak, cycle, field, signal and noise, in the order of field, channel, peak, cycle over all files."""
    order = ["field_i", "channel_i", "peak_i", "cycle_i"]
    columns = ["channel_i", "peak_i", "cycle_i", "field_i", "signal", "noise"]
    radmat.select(*columns).repartitionByRange(files, *order).sortWithinPartitions(*order).write.option("header", True).csv(path)


def photometry_table(radmat: DataFrame, threshold: float, n_cycles: int | None = None) -> DataFrame:
    """One row a peak and channel: CHANNEL, FIELD, H, W, CATEGORY of each cycle's signal above the threshold, and FRAME 0 .. n - 1.

    A table with more than ``n_cycles`` cycles is an error. Without it, all cycles of ``radmat``, counted first.
    """
    if n_cycles is None:
        n_cycles = radmat.agg(F.coalesce(F.max("cycle_i") + 1, F.lit(0))).first()[0]
    radmat = require_cycles(radmat, n_cycles)

    def at(c: int, x: Column) -> Column:
        return F.max(F.when(F.col("cycle_i") == c, x))

    frames = [at(c, F.col("signal")).alias(f"FRAME {c}") for c in range(n_cycles)]
    wide = radmat.groupBy("field_i", "channel_i", "peak_i").agg(*frames)
    flags = [F.when(F.coalesce(F.col(f"FRAME {c}") > threshold, F.lit(False)), "True").otherwise("False") for c in range(n_cycles)]
    return wide.select(
        F.concat(F.lit("ch"), (F.col("channel_i") + 1).cast("string")).alias("CHANNEL"), F.col("field_i").alias("FIELD"), F.col("peak_i").alias("H"), F.col("peak_i").alias("W"),
        F.concat(F.lit("("), F.concat_ws(", ", *flags), F.lit(")")).alias("CATEGORY"), *(f"FRAME {c}" for c in range(n_cycles)),
    )


def assert_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` if it has the columns and types of ``schema``, else an error."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"missing or of another type: {', '.join(wrong)}")
    return df


def write_table(df: DataFrame, path: str, schema: T.StructType, by: tuple = ()) -> None:
    """Parquet of a checked table, in parts by the given columns."""
    assert_schema(df, schema).write.partitionBy(*by).parquet(path)


def export_report(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """CSV of some columns in order."""
    df.select(*columns).orderBy(*order).write.option("header", True).csv(path)
