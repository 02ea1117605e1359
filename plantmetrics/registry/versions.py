"""Queries on snapshots and change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.operators import changes
from plantmetrics.registry.base import Inputs, query
from plantmetrics.session import scratch_path
from plantmetrics.sources.tables import write_snapshot

KEYS = ["event_id"]
COLUMNS = ["event_id", "equipment_id", "line_id", "event_time", "temperature_c", "vibration_ms2", "quality_score", "shift"]
STAMPS = {v: f"2024-02-0{v} 00:00:00" for v in range(1, 6)}


def _v1(t: Inputs) -> DataFrame:
    return t.silver().select(*COLUMNS)


def _v2(t: Inputs) -> DataFrame:
    return changes.delete_where(_v1(t), "quality_score > 0.95")


def _v3(t: Inputs) -> DataFrame:
    cooler = F.when(F.col("shift") == "NIGHT", F.col("temperature_c") - 0.5).otherwise(F.col("temperature_c"))
    return _v2(t).withColumn("temperature_c", cooler)


def _log(t: Inputs) -> DataFrame:
    """Log of three versions - load, delete, update - written once, as a stored change log would be."""
    path = scratch_path(t.spark, "changelog")
    parts = [
        changes.initial_load(_v1(t), 1, STAMPS[1]), changes.change_feed(_v1(t), _v2(t), KEYS, 2, STAMPS[2]),
        changes.change_feed(_v2(t), _v3(t), KEYS, 3, STAMPS[3]),
    ]
    for part in parts:
        part.write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


def _restored(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "restored")
    write_snapshot(changes.restore(_log(t), KEYS, 1, 4, STAMPS[4]), path)
    return t.spark.read.parquet(path)


_KEY = ["equipment_id", "event_time"]


@query("m1_merge_upsert", """
SELECT coalesce(t.equipment_id, s.equipment_id) AS equipment_id, coalesce(t.event_time, s.event_time) AS event_time,
       coalesce(t.line_id, s.line_id) AS line_id, coalesce(s.temperature_c, t.temperature_c) AS temperature_c,
       CASE WHEN t.equipment_id IS NULL THEN s.vibration_ms2 ELSE t.vibration_ms2 END AS vibration_ms2, t.shift AS shift
FROM (SELECT * FROM sensor_unique WHERE event_time < TIMESTAMP '2024-01-16') t
FULL OUTER JOIN (SELECT * REPLACE (temperature_c + 1 AS temperature_c) FROM sensor_unique
                 WHERE event_time >= TIMESTAMP '2024-01-15') s
ON t.equipment_id = s.equipment_id AND t.event_time = s.event_time""", ["sensor_unique"])
def merge_upsert(t: Inputs):
    rows = t.silver().select("equipment_id", "event_time", "line_id", "temperature_c", "vibration_ms2", "shift")
    target = rows.filter("event_time < TIMESTAMP_NTZ '2024-01-16'")
    source = rows.filter("event_time >= TIMESTAMP_NTZ '2024-01-15'").withColumn("temperature_c", F.col("temperature_c") + 1)
    return changes.merge_upsert(
        target, source, _KEY, update=["temperature_c"], insert=["line_id", "temperature_c", "vibration_ms2"]
    )


@query("m2_new_rows", """
SELECT event_id, event_time FROM sensor_events WHERE event_time > (
    SELECT coalesce(max(event_time), TIMESTAMP '2000-01-01') FROM sensor_silver WHERE event_time < TIMESTAMP '2024-01-16')""",
       ["sensor_events", "sensor_silver"])
def new_rows(t: Inputs):
    target = t.silver().filter("event_time < TIMESTAMP_NTZ '2024-01-16'")
    return changes.new_rows(t.view("sensor_events"), target, "event_time").select("event_id", "event_time")


@query("m2_new_rows_empty_target", "SELECT event_id, event_time FROM sensor_events", ["sensor_events"])
def new_rows_empty(t: Inputs):
    events = t.view("sensor_events")
    return changes.new_rows(events, events.filter("event_time IS NULL"), "event_time").select("event_id", "event_time")


def _checkpoints(t: Inputs, version: int) -> DataFrame:
    """Checkpoint table that already holds the pipeline, next to one row per shift's load."""
    other = t.view("sensor_events").groupBy(F.concat(F.lit("load_"), F.col("shift")).alias("pipeline_name")).agg(
        F.max("event_id").alias("last_processed_version")
    )
    row = t.spark.range(1).select(
        F.lit("bronze_to_silver").alias("pipeline_name"), F.lit(version).cast("long").alias("last_processed_version")
    )
    return other.unionByName(row).withColumn("updated_at", F.lit(STAMPS[1]).cast("timestamp_ntz"))


_OTHER_MARKS = """SELECT concat('load_', shift) AS pipeline_name, max(event_id) AS last_processed_version,
       TIMESTAMP '2024-02-01' AS updated_at FROM sensor_events GROUP BY 1"""


@query("m3_advance_checkpoint", _OTHER_MARKS + """
UNION ALL SELECT 'bronze_to_silver', 3, TIMESTAMP '2024-02-05'""", ["sensor_events"])
def advance_checkpoint(t: Inputs):
    latest = _log(t).agg(F.max("_commit_version")).scalar()
    return changes.advance_checkpoint(_checkpoints(t, 1), "bronze_to_silver", latest, STAMPS[5])


@query("m4_change_feed", "SELECT * FROM changelog WHERE _commit_version > 1", ["changelog"])
def change_feed(t: Inputs):
    return changes.change_feed(_v1(t), _v2(t), KEYS, 2, STAMPS[2]).unionByName(
        changes.change_feed(_v2(t), _v3(t), KEYS, 3, STAMPS[3])
    )


@query("m4_changes_between", """
SELECT * FROM changelog WHERE _commit_version BETWEEN 2 AND 3 AND _change_type IN ('delete', 'update_postimage')""", ["changelog"])
def changes_between(t: Inputs):
    return changes.changes_between(_log(t), 2, 3, ["delete", "update_postimage"])


@query("m5_change_summary", "SELECT _change_type, _commit_version, count(*) AS row_count FROM restored GROUP BY 1, 2", ["restored"])
def change_summary(t: Inputs):
    return changes.change_summary(_restored(t))


@query("m6_delete_where", "SELECT * FROM snapshot WHERE NOT quality_score > 0.95", ["snapshot"])
def delete_where(t: Inputs):
    return _v2(t)


@query("m7_state_as_of_version", "SELECT * FROM snapshot WHERE quality_score <= 0.95", ["snapshot"])
def state_version(t: Inputs):
    return changes.state_as_of(_log(t), KEYS, version=2)


@query("m7_state_as_of_time", """
SELECT * REPLACE (CASE WHEN shift = 'NIGHT' THEN temperature_c - 0.5 ELSE temperature_c END AS temperature_c) FROM snapshot
WHERE quality_score <= 0.95""", ["snapshot"])
def state_time(t: Inputs):
    return changes.state_as_of(_log(t), KEYS, timestamp="2024-02-03 12:00:00")


@query("m8_restore", "SELECT * FROM restored", ["restored"])
def restore(t: Inputs):
    return changes.restore(_log(t), KEYS, 1, 4, STAMPS[4])


@query("m8_restored_state", "SELECT * FROM snapshot", ["snapshot"])
def restored_state(t: Inputs):
    return changes.state_as_of(_restored(t), KEYS)


@query("m9_version_counts", """
SELECT 'current' AS version, count(*) AS cnt FROM snapshot WHERE quality_score <= 0.95
UNION ALL SELECT 'version_1', count(*) FROM snapshot""", ["snapshot"])
def version_counts(t: Inputs):
    log = _log(t)
    return changes.version_counts({"current": changes.state_as_of(log, KEYS), "version_1": changes.state_as_of(log, KEYS, 1)})


@query("m10_incremental_target", """
SELECT * FROM snapshot WHERE quality_score <= 0.95
UNION ALL SELECT * FROM snapshot WHERE quality_score > 0.95 AND temperature_c BETWEEN 0 AND 150 AND vibration_ms2 BETWEEN 0 AND 20""",
       ["snapshot"])
def incremental_target(t: Inputs):
    return changes.incremental_clean(_restored(t), _v2(t), _checkpoints(t, 1), "bronze_to_silver", STAMPS[5]).target


@query("m10_incremental_dedup", "SELECT * FROM snapshot", ["snapshot"])
def incremental_dedup(t: Inputs):
    """Restored rows that the target already holds are not appended again."""
    return changes.incremental_clean(
        _restored(t), _v1(t), _checkpoints(t, 1), "bronze_to_silver", STAMPS[5], dedup_keys=KEYS
    ).target


@query("m10_incremental_checkpoint", _OTHER_MARKS + """
UNION ALL SELECT 'bronze_to_silver', 4, TIMESTAMP '2024-02-05'""", ["sensor_events"])
def incremental_checkpoint(t: Inputs):
    return changes.incremental_clean(_restored(t), _v2(t), _checkpoints(t, 1), "bronze_to_silver", STAMPS[5]).checkpoints


@query("m10_incremental_status", """
SELECT 'no_inserts' AS status, CAST(1 AS BIGINT) AS from_version, max(_commit_version) AS latest_version FROM changelog""", ["changelog"])
def incremental_status(t: Inputs):
    return changes.incremental_clean(_log(t), _v2(t), _checkpoints(t, 1), "bronze_to_silver", STAMPS[5]).status


@query("m11_history", """
SELECT _change_type, min(_commit_version) AS first_version, (SELECT max(_commit_version) FROM restored) AS latest_version
FROM restored GROUP BY 1""", ["restored"])
def history(t: Inputs):
    return changes.history_summary(_restored(t))


@query("m12_expire", """
SELECT * FROM changelog WHERE _commit_version >= 3
UNION ALL SELECT * FROM changelog WHERE _commit_version = 1 AND quality_score <= 0.95""", ["changelog"])
def expire(t: Inputs):
    return changes.expire_changes(_log(t), KEYS, "2024-02-10 00:00:00", hours=168)
