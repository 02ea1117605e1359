import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from plantmetrics.operators import anomaly, quality

T0 = datetime(2024, 1, 30, 12)
READING = (
    "event_id int, equipment_id string, line_id string, event_time timestamp_ntz, temperature_c double, vibration_ms2 double, "
    "pressure_bar double, rpm double, quality_score double"
)


def reading(event_id, temperature=50.0, vibration=1.0, pressure=5.0, rpm=100.0, score=0.9, equipment="EQ001", at=T0):
    return (event_id, equipment, "LINE01", at, temperature, vibration, pressure, rpm, score)


def test_silver_filter_keeps_limits_and_drops_null(spark):
    rows = [
        reading(1, 10.0), reading(2, 150.0), reading(3, 9.99), reading(4, None), reading(5, vibration=-0.1), reading(6, pressure=0.0),
        reading(7, score=1.0), reading(8, score=1.01), reading(9, rpm=-1.0),
    ]
    kept = quality.silver_filter(spark.createDataFrame(rows, READING))
    assert sorted(r.event_id for r in kept.collect()) == [1, 2, 6, 7]
    assert sorted(r.event_id for r in quality.incremental_bounds(spark.createDataFrame(rows, READING)).collect()) == [1, 2, 3, 6, 7, 8, 9]


def test_zscore_of_single_and_constant_keys_is_null(spark):
    rows = [("one", 1.0), ("flat", 2.0), ("flat", 2.0), (None, 1.0), (None, 3.0)]
    rows += [("wide", 0.0)] * 30 + [("wide", 100.0)]
    got = quality.with_zscore(spark.createDataFrame(rows, "equipment_id string, temperature_c double"))
    assert got.filter("equipment_id IN ('one', 'flat') AND temp_zscore IS NOT NULL").count() == 0
    assert got.filter("equipment_id IS NULL AND temp_zscore IS NULL").count() == 0
    assert got.filter("is_anomaly").count() == 1 and got.count() == len(rows)


def test_zscore_does_not_shuffle_the_rows(spark):
    plan = quality.with_zscore(spark.range(100).select(F.col("id").alias("equipment_id"), F.rand(1).alias("temperature_c")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_expectations_count_null_as_failed(spark):
    rows = [reading(1), reading(2, 200.0), reading(3, None), reading(4, equipment="X1"), reading(5, at=None)]
    kept, metrics = quality.expect(spark.createDataFrame(rows, READING))
    assert sorted(r.event_id for r in kept.collect()) == [1, 4]
    got = {r.rule: (r.action, r.passed, r.failed) for r in metrics.collect()}
    assert got == {
        "valid_equipment": ("warn", 4, 1), "valid_temperature": ("drop", 3, 2), "valid_vibration": ("drop", 5, 0),
        "has_time": ("drop", 4, 1),
    }


def test_rescue_keeps_what_does_not_fit(spark):
    schema = StructType([StructField("n", IntegerType()), StructField("x", DoubleType())])
    df = spark.createDataFrame([("1", "2.5", "k"), ("one", "2.5", "k"), (None, "bad", "k"), ("7", None, "k")], "n string, x string, other string")
    rows = quality.rescue(df, schema).collect()
    assert [(r.n, r.x) for r in rows] == [(1, 2.5), (None, 2.5), (None, None), (7, None)]
    assert [r._rescued_data and json.loads(r._rescued_data) for r in rows] == [None, {"n": "one"}, {"x": "bad"}, None]
    assert all(r.other == "k" for r in rows)


def test_contract_reports_each_rule(spark):
    df = spark.createDataFrame([("2024-01-30", 0.9), ("2024-01-29", None)], "production_date string, quality double")
    got = {r.check_name: r.status for r in quality.contract_check(df, "production_date", "2024-01-30", ["quality"], 3).collect()}
    assert got == {"data present": "PASS", "no NULL in quality": "FAIL", "minimum rows": "FAIL"}
    late = {r.check_name: r.status for r in quality.contract_check(df, "production_date", "2024-01-31", [], 2).collect()}
    assert late == {"data present": "FAIL", "minimum rows": "PASS"}


def test_alert_type_precedence_and_repeatable_ids(spark):
    rows = [reading(1, 95.0, 6.0), reading(2, 95.0, 1.0), reading(3, 50.0, 5.0), reading(4, 50.0, 5.1)]
    df = spark.createDataFrame(rows, READING)
    kinds = {r.event_id: r.alert_type for r in anomaly.alert_rows(df).collect()}
    assert kinds == {1: "vibration", 2: "temperature", 4: "vibration"}
    first = {r.alert_id for r in anomaly.alert_records(anomaly.alert_rows(df)).collect()}
    assert first == {r.alert_id for r in anomaly.alert_records(anomaly.alert_rows(df)).collect()} and len(first) == 3
    assert [r.event_id for r in anomaly.newest_alerts(df, 2).collect()] == [4, 2]


def test_rolling_zscore_ignores_windows_without_spread(spark):
    df = spark.range(40).select(
        F.col("id").alias("event_id"), F.lit("EQ001").alias("equipment_id"), F.timestamp_seconds("id").alias("event_time"),
        F.when(F.col("id") == 39, 90.0).otherwise(20.0).alias("temperature_c"),
    )
    found = anomaly.rolling_zscore(df, rows=20, tie=("event_id",)).collect()
    assert [r.event_id for r in found] == [39] and found[0].z_score == pytest.approx(4.25, abs=0.01)
