"""File ingest, quarantine routing, alerting and hourly aggregates on streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from plantmetrics.operators.anomaly import alert_records, alert_rows
from plantmetrics.operators.quality import DROP_RULES, WARN_RULES, keep_expected
from plantmetrics.sources.tables import with_lineage


def file_stream(spark: SparkSession, source: str, schema: StructType | None = None, max_files: int = 1000) -> DataFrame:
    """Parquet files under `source` as a stream with lineage columns; without a schema it is read once from the files."""
    known = schema or spark.read.parquet(source).schema
    return with_lineage(spark.readStream.schema(known).option("maxFilesPerTrigger", max_files).parquet(source))


def _trigger(interval: str | None) -> dict:
    return {"processingTime": interval} if interval else {"availableNow": True}


def ingest_files(
    spark: SparkSession, source: str, out: str, checkpoint: str, schema: StructType | None = None, max_files: int = 1000,
    interval: str | None = None,
) -> StreamingQuery:
    """Append new files to `out`. Without an interval all present files are taken and the query ends; a rerun with the
    same checkpoint adds only files that came since."""
    return (
        file_stream(spark, source, schema, max_files).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start(out)
    )


def route_quarantine(
    stream: DataFrame, is_bad: Column, good: str, bad: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Good rows to one table, bad rows to another. Each batch overwrites its own `batch_id=` folder, so a repeated
    batch changes nothing. A NULL verdict counts as bad."""
    ok = F.coalesce(~is_bad, F.lit(False))

    def route(batch: DataFrame, batch_id: int) -> None:
        batch = batch.withColumn("_ok", ok).persist()
        batch.filter("_ok").drop("_ok").write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
        batch.filter("NOT _ok").drop("_ok").write.mode("overwrite").parquet(f"{bad}/batch_id={batch_id}")
        batch.unpersist()

    return stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def expect_stream(
    stream: DataFrame, good: str, metrics: str, checkpoint: str, warn: Mapping[str, str] = WARN_RULES,
    drop: Mapping[str, str] = DROP_RULES, interval: str | None = None,
) -> StreamingQuery:
    """Rows that pass the drop rules to `good`, and per batch how many rows passed each rule to `metrics`.

    The counts are observed while the batch is written, so each batch is read once.
    """
    rules = [(name, kind, rule) for kind, held in (("warn", warn), ("drop", drop)) for name, rule in held.items()]

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        counts = [F.count_if(F.coalesce(F.expr(rule), F.lit(False))).alias(name) for name, _, rule in rules]
        keep_expected(batch.observe(seen, F.count("*").alias("_rows"), *counts), drop).write.mode("overwrite").parquet(f"{good}/batch_id={batch_id}")
        got = seen.get
        lines = [(name, kind, got[name], got["_rows"] - got[name]) for name, kind, _ in rules]
        found = batch.sparkSession.createDataFrame(lines, "rule string, action string, passed long, failed long")
        found.write.mode("overwrite").parquet(f"{metrics}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def alert_stream(
    stream: DataFrame, out: str, checkpoint: str, interval: str | None = "60 seconds", key: tuple[str, ...] = ("event_id",)
) -> StreamingQuery:
    """Alert records of each batch of new readings, at most one run per interval; all present data and stop without one."""
    def write(batch: DataFrame, batch_id: int) -> None:
        alert_records(alert_rows(batch), key).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**_trigger(interval)).start()


def hourly_stream(clean: DataFrame, ts: str = "event_time", width: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """Streaming form of the hourly equipment view; a window is final once the watermark has passed it."""
    return (
        clean.withWatermark(ts, watermark)
        .groupBy("equipment_id", "line_id", "equipment_type", F.window(ts, width).alias("w"))
        .agg(
            F.count("*").alias("sensor_count"), F.avg("temperature_c").alias("avg_temp"),
            F.max("vibration_ms2").alias("max_vib"), F.avg("pressure_bar").alias("avg_current"),
            F.count(F.when(F.col("pressure_bar") >= 2.0, 1)).alias("running_minutes_10m"),
            F.count(F.when(F.col("vibration_ms2") > 5.0, 1)).alias("anomaly_count"),
        )
        .select(
            "equipment_id", "line_id", "equipment_type", F.col("w.start").alias("window_start"), "sensor_count", "avg_temp",
            "max_vib", "avg_current", "running_minutes_10m", "anomaly_count",
        )
    )


def write_stream(stream: DataFrame, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append-mode Parquet sink."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(**_trigger(interval)).start(out)
    )
