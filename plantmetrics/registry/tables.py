"""Reads, writes, cleaning, quality and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from plantmetrics.functions.sizing import join_back
from plantmetrics.operators import quality
from plantmetrics.operators.ordered import dedup
from plantmetrics.plans import medallion
from plantmetrics.registry.base import Inputs, day_text, near, query, sql_near
from plantmetrics.session import scratch_path
from plantmetrics.sources import tables
from plantmetrics.streaming import evolving, ingest

EVENTS = "SELECT * FROM events"


def _events_source(t: Inputs) -> str:
    """A glob, so that a table kept in one file streams like a folder of files."""
    return f"{t.root}/events.parque[t]"


def _events_stream(t: Inputs, **options):
    return ingest.file_stream(t.spark, _events_source(t), **options)


def _sensor_stream(t: Inputs):
    """Sensor-shaped columns on the event stream."""
    events = _events_stream(t)
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")

    def code(prefix: str, n: int, width: int):
        return F.concat(F.lit(prefix), F.lpad((F.col("user_id") % n + 1).cast("string"), width, "0"))

    kinds = F.array(*[F.lit(x) for x in ("CNC", "AOI", "ROBOT", "PRESS", "CONVEYOR")])
    return events.select(
        "event_id", code("EQ", 50, 3).alias("equipment_id"), code("LINE", 10, 2).alias("line_id"),
        kinds[(F.col("user_id") % 5).cast("int")].alias("equipment_type"), F.col("ts").alias("event_time"),
        F.col("value").alias("temperature_c"), (k / 10).alias("vibration_ms2"),
        ((F.col("event_id") % 280) / 10 - 1).alias("pressure_bar"),
        ((F.col("event_id") * 37) % 3200).cast("double").alias("rpm"), (k / 95).alias("quality_score"),
    )


@query("a2_write_snapshot", EVENTS)
def write_snapshot(t: Inputs):
    path = scratch_path(t.spark, "snapshot")
    tables.write_snapshot(t.table("events"), path)
    return t.spark.read.parquet(path)


@query("a3_write_landing", EVENTS)
def write_landing(t: Inputs):
    path = scratch_path(t.spark, "landing")
    tables.write_landing(t.table("events"), path)
    return t.spark.read.parquet(path)


@query("a4_ingest_files", EVENTS)
def ingest_files(t: Inputs):
    out, mark = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "bronze-mark")
    source = _events_source(t)
    for _ in range(2):  # The second run finds nothing new.
        ingest.ingest_files(t.spark, source, out, mark, schema=t.table("events").schema).awaitTermination()
    return t.spark.read.parquet(out).drop("_ingestion_time", "_source_file")


@query("a5_lineage", "SELECT event_id, TRUE AS has_time, 'events.parquet' AS source_name FROM events")
def lineage(t: Inputs):
    marked = tables.with_lineage(t.table("events"))
    return marked.select(
        "event_id", F.col("_ingestion_time").isNotNull().alias("has_time"),
        F.regexp_extract("_source_file", "([^/]+)$", 1).alias("source_name"),
    )


@query("a6_ingest_inferred", EVENTS)
def ingest_inferred(t: Inputs):
    out, mark = scratch_path(t.spark, "bronze"), scratch_path(t.spark, "bronze-mark")
    ingest.ingest_files(t.spark, _events_source(t), out, mark).awaitTermination()
    return t.spark.read.parquet(out).drop("_ingestion_time", "_source_file")


@query("a7_append_evolve", """
SELECT event_id, equipment_id, temperature_c, CAST(NULL AS DOUBLE) AS pressure_bar FROM sensor_events
UNION ALL SELECT event_id, equipment_id, NULL, pressure_bar FROM sensor_events""", ["sensor_events"])
def append_evolve(t: Inputs):
    events = t.view("sensor_events")
    return tables.append_evolve(
        events.select("event_id", "equipment_id", "temperature_c"), events.select("event_id", "equipment_id", "pressure_bar")
    )


@query("a8_append_rows", """
SELECT equipment_id, temperature_c, CAST(NULL AS DOUBLE) AS temp_zscore FROM sensor_events
UNION ALL VALUES ('EQ003', 78.5, 3.5), ('EQ007', 94.2, 3.5), ('EQ001', 96.3, 3.5)""", ["sensor_events"])
def append_rows(t: Inputs):
    rows = [("EQ003", 78.5), ("EQ007", 94.2), ("EQ001", 96.3)]
    old = t.view("sensor_events").select("equipment_id", "temperature_c")
    return tables.append_rows(old, rows, "equipment_id string, temperature_c double", temp_zscore=F.lit(3.5))


COUNTED = ["sensor_events", "production_logs", "quality_inspections", "maintenance_records", "maintenance_clean", "equipment_master"]


@query("a9_row_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED), COUNTED)
def row_counts(t: Inputs):
    return tables.row_counts({n: t.view(n) for n in COUNTED})


@query("a10_compact", EVENTS)
def compact(t: Inputs):
    path = scratch_path(t.spark, "compact")
    tables.compact(t.table("events"), path, 4)
    return t.spark.read.parquet(path)


@query("a10_cluster_range", EVENTS)
def cluster_range(t: Inputs):
    return tables.cluster_rewrite(t.table("events"), ["user_id", "ts"], 8)


@query("a10_cluster_z", EVENTS)
def cluster_z(t: Inputs):
    return tables.cluster_rewrite(t.table("events"), ["user_id", "ts"], 8, "z")


@query("c1_silver_filter", "SELECT * FROM sensor_silver", ["sensor_silver"])
def silver(t: Inputs):
    return t.silver()


@query("c2_zscore", f"SELECT event_id, {sql_near('temp_zscore')} AS temp_zscore, is_anomaly FROM sensor_clean", ["sensor_clean"])
def zscore(t: Inputs):
    return t.clean().select("event_id", near("temp_zscore").alias("temp_zscore"), "is_anomaly")


@query("c3_dedup", "SELECT * FROM sensor_unique", ["sensor_unique"])
def unique(t: Inputs):
    doubled = tables.union_by_name([t.silver(), t.silver(), t.silver()])
    return dedup(doubled, ["equipment_id", "event_time"], ["event_id"])


BAD = "temperature_c > 100 OR vibration_ms2 > 8"


@query("i1_quarantine", f"SELECT event_id, {BAD} AS quarantined FROM sensor_events", ["sensor_events"])
def quarantine(t: Inputs):
    good, bad, mark = (scratch_path(t.spark, n) for n in ("good", "bad", "route-mark"))
    ingest.route_quarantine(_sensor_stream(t), F.expr(BAD), good, bad, mark).awaitTermination()
    return tables.union_by_name([
        t.spark.read.parquet(p).select("event_id", F.lit(flag).alias("quarantined")) for p, flag in ((good, False), (bad, True))
    ])


@query("i1b_rescue", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) END AS reading,
       CASE WHEN event_type = 'error' THEN concat('{"reading":"E', regexp_extract(props, '([0-9]+)', 1), '"}') END AS _rescued_data
FROM events""")
def rescue(t: Inputs):
    k = F.regexp_extract("props", "([0-9]+)", 1)
    raw = t.table("events").select(
        "event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("E"), k)).otherwise(k).alias("reading")
    )
    fitted = quality.rescue(raw, StructType([StructField("reading", LongType())]))
    return fitted.withColumn("reading", F.col("reading").cast("double"))


@query("i2_expect_kept", """
SELECT event_id FROM sensor_events WHERE temperature_c BETWEEN 0 AND 150 AND vibration_ms2 BETWEEN 0 AND 20
AND event_time IS NOT NULL""", ["sensor_events"])
def expect_kept(t: Inputs):
    return quality.expect(t.view("sensor_events"))[0].select("event_id")


_RULES = [
    ("valid_equipment", "warn", "regexp_matches(equipment_id, '^EQ[0-9]{3}') AND length(equipment_id) = 5"),
    ("valid_temperature", "drop", "temperature_c BETWEEN 0 AND 150"),
    ("valid_vibration", "drop", "vibration_ms2 BETWEEN 0 AND 20"),
    ("has_time", "drop", "event_time IS NOT NULL"),
]


@query("i2_expect_metrics", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, '{a}' AS action, count(*) FILTER (WHERE {r}) AS passed, count(*) - count(*) FILTER (WHERE {r}) AS failed "
    "FROM sensor_events" for n, a, r in _RULES), ["sensor_events"])
def expect_metrics(t: Inputs):
    return quality.expect(t.view("sensor_events"))[1]


@query("i2_expect_stream", " UNION ALL ".join(
    f"SELECT '{n}' AS rule, '{a}' AS action, count(*) FILTER (WHERE {r}) AS passed, count(*) - count(*) FILTER (WHERE {r}) AS failed "
    "FROM sensor_events" for n, a, r in _RULES), ["sensor_events"])
def expect_stream(t: Inputs):
    good, metrics, mark = (scratch_path(t.spark, n) for n in ("expected", "expect-metrics", "expect-mark"))
    ingest.expect_stream(_sensor_stream(t), good, metrics, mark).awaitTermination()
    found = t.spark.read.parquet(metrics)
    return found.groupBy("rule", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query("i1c_rescue_quarantine", "SELECT event_id, event_type = 'error' AS quarantined FROM events")
def rescue_quarantine(t: Inputs):
    """Raw text readings as they land, cast to a number; those that do not fit go to quarantine."""
    landing, good, bad, mark = (scratch_path(t.spark, n) for n in ("raw-landing", "fitting", "rescued", "rescue-mark"))
    k = F.regexp_extract("props", "([0-9]+)", 1)
    raw = t.table("events").select("event_id", F.when(F.col("event_type") == "error", F.concat(F.lit("E"), k)).otherwise(k).alias("reading"))
    raw.write.parquet(landing)
    fitted = quality.rescue(ingest.file_stream(t.spark, landing), StructType([StructField("reading", LongType())]))
    ingest.route_quarantine(fitted, F.col("_rescued_data").isNotNull(), good, bad, mark).awaitTermination()
    return tables.union_by_name([
        t.spark.read.parquet(p).select("event_id", F.lit(flag).alias("quarantined")) for p, flag in ((good, False), (bad, True))
    ])


CLEAN_EVENTS = """SELECT event_id, equipment_id, CAST(CAST(event_time AS DATE) AS STRING) AS event_date FROM sensor_events
WHERE equipment_id IS NOT NULL"""


@query("i3_clean_batch", CLEAN_EVENTS, ["sensor_events"])
def clean_batch(t: Inputs):
    return day_text(quality.clean_events(t.view("sensor_events")).select("event_id", "equipment_id", "event_date"), "event_date")


@query("i3_clean_stream", CLEAN_EVENTS, ["sensor_events"])
def clean_stream(t: Inputs):
    out, mark = scratch_path(t.spark, "clean"), scratch_path(t.spark, "clean-mark")
    ingest.write_stream(quality.clean_events(_sensor_stream(t)), out, mark).awaitTermination()
    return day_text(t.spark.read.parquet(out).select("event_id", "equipment_id", "event_date"), "event_date")


@query("i4_sensor_daily", f"""
SELECT equipment_id, line_id, CAST(CAST(event_time AS DATE) AS STRING) AS event_date, {sql_near('avg(temperature_c)')} AS avg_temperature_c,
       max(vibration_ms2) AS max_vibration_ms2, count(*) AS event_count
FROM sensor_events GROUP BY 1, 2, 3""", ["sensor_events"])
def sensor_daily(t: Inputs):
    daily = medallion.sensor_daily(quality.clean_events(t.view("sensor_events")))
    return day_text(daily, "event_date").withColumn("avg_temperature_c", near("avg_temperature_c"))


@query("i4_live_view", f"""
SELECT equipment_id, line_id, CAST(CAST(event_time AS DATE) AS STRING) AS event_date, {sql_near('avg(temperature_c)')} AS avg_temperature_c,
       max(vibration_ms2) AS max_vibration_ms2, count(*) AS event_count
FROM sensor_events GROUP BY 1, 2, 3""", ["sensor_events"])
def live_view(t: Inputs):
    """The daily view brought up to date by three batches of which the second comes twice."""
    state, out = scratch_path(t.spark, "view-state"), scratch_path(t.spark, "view")
    clean = quality.clean_events(t.view("sensor_events"))
    for batch in (0, 1, 2, 1):
        part = clean.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == batch)
        evolving.merge_batch(part, batch, state, out, "event_date", medallion.daily_partials, medallion.daily_view)
    return day_text(t.spark.read.parquet(out), "event_date").withColumn("avg_temperature_c", near("avg_temperature_c"))


@query("a6_schema_log", """
SELECT event_id, equipment_id, CASE WHEN event_id % 3 >= 1 THEN temperature_c END AS temperature_c,
       CASE WHEN event_id % 3 = 2 THEN shift END AS shift FROM sensor_events""", ["sensor_events"])
def schema_log(t: Inputs):
    """Three deliveries, each with a column more, taken by one stream that goes on from its checkpoint."""
    source, out, mark, log = (scratch_path(t.spark, n) for n in ("landing", "ingested", "mark", "schemas"))
    columns = ["event_id", "equipment_id", "temperature_c", "shift"]
    for i in range(3):
        t.view("sensor_events").filter(F.col("event_id") % 3 == i).select(*columns[:2 + i]).write.mode("append").parquet(source)
        evolving.ingest_evolving(t.spark, source, out, mark, log).awaitTermination()
    return evolving.read_evolved(t.spark, out, log).select(*columns)


@query("i5_alert_stream", """
SELECT event_id, equipment_id, CASE WHEN vibration_ms2 > 5 THEN 'vibration' ELSE 'temperature' END AS alert_type,
       concat('alert-', left(md5(concat_ws('|', equipment_id, CASE WHEN vibration_ms2 > 5 THEN 'vibration' ELSE 'temperature' END,
              CAST(event_id AS STRING))), 12)) AS alert_id
FROM sensor_events WHERE vibration_ms2 > 5 OR temperature_c > 90""", ["sensor_events"])
def alert_stream(t: Inputs):
    from plantmetrics.operators.anomaly import alert_rows

    out, mark = scratch_path(t.spark, "alerts"), scratch_path(t.spark, "alerts-mark")
    ingest.alert_stream(_sensor_stream(t), out, mark, interval=None).awaitTermination()
    made = t.spark.read.parquet(out).select("alert_id", "equipment_id", "alert_type", F.col("created_at").alias("event_time"))
    ids = alert_rows(t.view("sensor_events")).select("event_id", "equipment_id", "event_time")
    return join_back(made, ids, ["equipment_id", "event_time"], "inner").drop("event_time")


@query("i7_hourly_stream", f"""
SELECT equipment_id, line_id, equipment_type, date_trunc('hour', event_time) AS window_start, count(*) AS sensor_count,
       {sql_near('avg(temperature_c)')} AS avg_temp, max(vibration_ms2) AS max_vib
FROM sensor_silver GROUP BY 1, 2, 3, 4
HAVING date_trunc('hour', event_time) + INTERVAL 1 HOUR
       <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL 1 HOUR FROM sensor_silver)""", ["sensor_silver"])
def hourly_stream(t: Inputs):
    out, mark = scratch_path(t.spark, "hourly"), scratch_path(t.spark, "hourly-mark")
    silver_stream = quality.silver_filter(_sensor_stream(t))
    # Event-time windows need an instant; back to a zone-free time for the result.
    timed = silver_stream.withColumn("event_time", F.col("event_time").cast("timestamp"))
    ingest.write_stream(ingest.hourly_stream(timed), out, mark).awaitTermination()
    found = t.spark.read.parquet(out)
    return found.select(
        "equipment_id", "line_id", "equipment_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "sensor_count", near("avg_temp").alias("avg_temp"), "max_vib",
    )
