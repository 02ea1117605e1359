from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantmetrics.sources import tables

T0 = datetime(2024, 1, 1)


def grid(spark):
    return spark.range(1600).select(
        F.format_string("EQ%03d", F.col("id") % 40).alias("equipment_id"), (F.floor(F.col("id") / 40)).alias("t"), "id"
    )


def spans(df, column):
    """Mean share of the value range that one partition covers, over distinct ranks."""
    parts = df.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.countDistinct(column).alias("n")
    ).agg(F.avg("n")).first()[0]
    return parts


def test_z_layout_narrows_both_columns(spark):
    df = grid(spark)
    laid = tables.cluster_rewrite(df, ["equipment_id", "t"], 16, "z")
    assert laid.exceptAll(df).count() == 0 and laid.count() == 1600
    assert spans(laid, "equipment_id") < 25 and spans(laid, "t") < 25


def test_range_layout_narrows_first_column_and_splits_a_hot_value(spark):
    df = grid(spark).withColumn("equipment_id", F.when(F.col("id") % 2 == 0, "EQ000").otherwise(F.col("equipment_id")))
    laid = tables.cluster_rewrite(df, ["equipment_id"], 8)
    sizes = [r["count"] for r in laid.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    assert sum(sizes) == 1600 and max(sizes) < 500


def test_append_evolve_fills_absent_columns_with_null(spark):
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([(2, 2.5)], "id int, extra double")
    rows = {r.id: r for r in tables.append_evolve(old, new).collect()}
    assert rows[1].extra is None and rows[2].name is None and rows[2].extra == 2.5
    more = tables.append_rows(old, [(3, "c")], "id int, name string", flag=F.lit(True))
    assert sorted((r.id, r.flag) for r in more.collect()) == [(1, None), (3, True)]


def test_snapshot_replaces_data_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(5), path)
    tables.write_snapshot(spark.range(3).withColumn("x", F.lit(1)), path)
    back = spark.read.parquet(path)
    assert back.columns == ["id", "x"] and back.count() == 3


def test_landing_file_count_and_lineage(spark, tmp_path):
    path = str(tmp_path / "landing")
    tables.write_landing(spark.range(100).repartition(6), path, files=2)
    marked = tables.with_lineage(spark.read.parquet(path))
    assert marked.select("_source_file").distinct().count() == 2
    assert marked.filter("_ingestion_time IS NULL").count() == 0


def test_row_counts_and_union(spark):
    counts = {r.table_name: r.row_count for r in tables.row_counts({"a": spark.range(4), "b": spark.range(0)}).collect()}
    assert counts == {"a": 4, "b": 0}
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(tuple(r) for r in tables.union_by_name([left, right]).collect()) == [(1, "x"), (2, "y")]


def test_compact_writes_even_files(spark, tmp_path):
    path = str(tmp_path / "compact")
    tables.compact(spark.range(1000).repartition(20), path, 4)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and sum(r["count"] for r in files) == 1000
    assert timedelta(0) < datetime.now() - T0


def test_z_value_of_six_columns_stays_positive(spark):
    df = spark.range(500).selectExpr(*[f"(id * {k + 3}) % 101 AS c{k}" for k in range(6)])
    low, high = df.select(tables.z_value(df, [f"c{k}" for k in range(6)]).alias("z")).selectExpr("min(z)", "max(z)").first()
    assert low >= 0 and high < 2**36 and high > 2**31
    with pytest.raises(ValueError, match="fit"):
        tables.z_value(df, [f"c{k}" for k in range(6)], bits=11)
