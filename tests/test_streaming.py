from datetime import datetime, timedelta

from pyspark.sql import functions as F

from plantmetrics.operators import anomaly
from plantmetrics.plans import kpi
from plantmetrics.streaming import ingest

T0 = datetime(2024, 1, 1)


def landing(spark, tmp_path, n=300, name="landing"):
    df = spark.range(n).select(
        F.col("id").alias("event_id"), F.format_string("EQ%03d", F.col("id") % 4).alias("equipment_id"), F.lit("LINE01").alias("line_id"),
        F.lit("CNC").alias("equipment_type"), F.timestamp_seconds(1704067200 + F.col("id") * 120).alias("event_time"),
        (F.col("id") % 100).cast("double").alias("temperature_c"), (F.col("id") % 11).cast("double").alias("vibration_ms2"),
        F.lit(3.0).alias("pressure_bar"),
    )
    path = str(tmp_path / name)
    df.repartition(5).write.parquet(path)
    return df, path


def test_ingest_takes_each_file_once(spark, tmp_path):
    df, source = landing(spark, tmp_path)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for _ in range(2):
        ingest.ingest_files(spark, source, out, mark, max_files=2).awaitTermination()
        assert spark.read.parquet(out).count() == 300
    df.limit(7).write.mode("append").parquet(source)
    ingest.ingest_files(spark, source, out, mark, schema=df.schema).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 307 and got.filter("_source_file IS NULL OR _ingestion_time IS NULL").count() == 0


def test_quarantine_parts_make_up_the_input(spark, tmp_path):
    df, source = landing(spark, tmp_path)
    stream = ingest.file_stream(spark, source, max_files=2)
    bad = F.when(F.col("event_id") == 5, F.lit(None).cast("boolean")).otherwise(F.col("temperature_c") > 90)
    good_path, bad_path = str(tmp_path / "good"), str(tmp_path / "bad")
    ingest.route_quarantine(stream, bad, good_path, bad_path, str(tmp_path / "mark")).awaitTermination()
    good_ids = {r.event_id for r in spark.read.parquet(good_path).select("event_id").collect()}
    bad_ids = {r.event_id for r in spark.read.parquet(bad_path).select("event_id").collect()}
    assert not good_ids & bad_ids and len(good_ids | bad_ids) == df.count()
    assert bad_ids == {i for i in range(300) if i % 100 > 90} | {5}


def test_stream_alerts_equal_batch_alerts(spark, tmp_path):
    df, source = landing(spark, tmp_path)
    out = str(tmp_path / "alerts")
    ingest.alert_stream(ingest.file_stream(spark, source, max_files=2), out, str(tmp_path / "mark"), interval=None).awaitTermination()
    got = {r.alert_id for r in spark.read.parquet(out).collect()}
    assert got == {r.alert_id for r in anomaly.alert_records(anomaly.alert_rows(df)).collect()}


def test_closed_hours_equal_the_batch_view(spark, tmp_path):
    df, source = landing(spark, tmp_path)
    out = str(tmp_path / "hours")
    stream = ingest.hourly_stream(ingest.file_stream(spark, source), watermark="1 hour")
    ingest.write_stream(stream, out, str(tmp_path / "mark")).awaitTermination()
    got = {(r.equipment_id, r.window_start): (r.sensor_count, r.anomaly_count) for r in spark.read.parquet(out).collect()}
    last = T0 + timedelta(seconds=299 * 120)
    want = {}
    for r in kpi.equipment_hourly(df).collect():
        start = datetime.combine(r.production_date, datetime.min.time()) + timedelta(hours=r.production_hour)
        if start + timedelta(hours=1) <= last - timedelta(hours=1):
            want[r.equipment_id, start] = (r.sensor_count, r.anomaly_count)
    assert got == want and want


def test_interval_trigger_takes_what_comes_later(spark, tmp_path):
    df, source = landing(spark, tmp_path, n=40)
    out = str(tmp_path / "out")
    running = ingest.ingest_files(spark, source, out, str(tmp_path / "mark"), schema=df.schema, interval="1 second")
    try:
        running.processAllAvailable()
        assert spark.read.parquet(out).count() == 40 and running.isActive
        df.limit(3).write.mode("append").parquet(source)
        running.processAllAvailable()
        assert spark.read.parquet(out).count() == 43
    finally:
        running.stop()
