"""Field files and exports."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dyelake.sources import fields as S


@pytest.fixture(scope="module")
def radmat(spark):
    return spark.range(12).select((F.col("id") % 2).cast("int").alias("field_i"), F.lit(0).alias("channel_i"), F.floor(F.col("id") / 3).cast("int").alias("peak_i"), (F.col("id") % 3).cast("int").alias("cycle_i"), F.col("id").cast("double").alias("signal"), F.lit(1.0).alias("noise"))


def test_fields_batch_and_stream(spark, radmat, tmp_path):
    path = str(tmp_path / "r")
    radmat.write.partitionBy("field_i").parquet(path)
    assert S.stack_fields(spark, path).count() == 12
    q = S.stream_fields(spark, path, radmat.schema).writeStream.format("memory").queryName("fields").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("fields").count() == 12


def test_metadata(spark, tmp_path):
    for f in range(2):
        (tmp_path / f"{f}.json").write_text(json.dumps({"field_i": f, "cycle_i": 1, "x": 1.5, "y": 2, "z": 3.0}))
    assert sorted((r["field_i"], r["stage_x"]) for r in S.read_field_metadata(spark, str(tmp_path)).collect()) == [(0, 1.5), (1, 1.5)]


def test_scope_tsv(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes("a/b/c\\t1.5\\nname\\tred".encode("utf-16"))
    assert sorted((r["key"], r["value"], r["number"]) for r in S.read_scope_tsv(spark, str(tmp_path)).collect()) == [("a.b.c", "1.5", 1.5), ("name", "red", None)]


def test_exports(spark, radmat, tmp_path):
    S.export_radmat(radmat, str(tmp_path / "c"), 3)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 12
    row = S.photometry_table(radmat.filter("peak_i = 1").withColumn("field_i", F.lit(0)), 3.5, 3).first()
    assert (row["CHANNEL"], row["CATEGORY"], row["FRAME 2"]) == ("ch1", "(False, True, True)", 5.0)
    with pytest.raises(ValueError, match="signal string"):
        S.write_table(radmat, str(tmp_path / "w"), T.StructType([T.StructField("signal", T.StringType())]))


def test_the_export_is_in_order_over_all_files(spark, tmp_path):
    rows = spark.range(500).selectExpr("CAST(id % 2 AS INT) AS channel_i", "CAST(id * 37 % 100 AS INT) AS peak_i", "CAST(id % 5 AS INT) AS cycle_i", "CAST(id * 7 % 3 AS INT) AS field_i", "CAST(id AS DOUBLE) AS signal", "1.5D AS noise")
    S.export_radmat(rows, str(tmp_path / "r"), 4)
    lines = [x for f in sorted((tmp_path / "r").glob("part-*.csv")) for x in f.read_text().splitlines() if not x.startswith("channel_i")]
    got = [tuple(float(v) for v in x.split(",")) for x in lines]
    want = [(r["channel_i"], r["peak_i"], r["cycle_i"], r["field_i"], r["signal"], r["noise"]) for r in rows.collect()]
    order = [(r[3], r[0], r[1], r[2]) for r in got]
    assert order == sorted(order) and sorted(got) == sorted(want) and len(list((tmp_path / "r").glob("part-*.csv"))) > 1


def test_tables_are_checked_before_they_are_written(spark, radmat, tmp_path):
    fields = {f.name: f for f in radmat.schema}
    schema = T.StructType([fields["peak_i"], fields["signal"]])
    S.write_table(radmat, str(tmp_path / "w"), schema, ("field_i",))
    assert sorted(x.name for x in (tmp_path / "w").glob("field_i=*")) == ["field_i=0", "field_i=1"] and spark.read.parquet(str(tmp_path / "w")).count() == 12
    with pytest.raises(ValueError, match="missing double"):
        S.write_table(radmat, str(tmp_path / "v"), T.StructType([*schema, T.StructField("missing", T.DoubleType())]))
    assert not (tmp_path / "v").exists()


def test_reports_as_csv(spark, radmat, tmp_path):
    S.export_report(radmat, str(tmp_path / "e"), ["peak_i", "signal"], ["signal"])
    rows = [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "e"), inferSchema=True).collect()]
    assert rows == [(i // 3, float(i)) for i in range(12)]
