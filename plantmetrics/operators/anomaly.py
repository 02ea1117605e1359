"""Threshold and rolling anomalies, and the alert rows made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import ratio
from plantmetrics.operators.ordered import rolling


def rolling_zscore(
    df: DataFrame, value: str = "temperature_c", key: str = "equipment_id", ts: str = "event_time",
    rows: int = 360, k: float = 3.0, tie: tuple[str, ...] = (),
) -> DataFrame:
    """Readings more than k trailing deviations from their trailing mean (frame of `rows` readings)."""
    frames = {"rolling_avg": ("avg", value, rows), "_spread": ("std", value, rows)}
    z = ratio(F.col(value) - F.col("rolling_avg"), F.col("_spread"))
    scored = rolling(df, key, ts, frames, tie).withColumn("_z", z)
    return (
        scored.filter(F.abs("_z") > k)
        .withColumns({"z_score": F.round("_z", 2), "anomaly_flag": F.lit("ANOMALY")})
        .drop("_z", "_spread")
    )


def threshold_anomalies(
    df: DataFrame, max_temperature: float = 85, max_vibration: float = 5.0, n: int = 10
) -> DataFrame:
    """Averages over out-of-range readings per equipment; the n equipments with the newest ones."""
    return (
        df.filter((F.col("temperature_c") > max_temperature) | (F.col("vibration_ms2") > max_vibration))
        .groupBy("equipment_id")
        .agg(
            F.avg("temperature_c").alias("avg_temp"), F.avg("vibration_ms2").alias("avg_vib"),
            F.avg("pressure_bar").alias("avg_curr"), F.max("event_time").alias("last_seen"),
        )
        .orderBy(F.desc("last_seen"), "equipment_id")
        .limit(n)
    )


def vibration_events(df: DataFrame, since: Column, max_vibration: float = 5.0) -> DataFrame:
    """Row form: readings with excess vibration from a moment on."""
    return df.filter((F.col("vibration_ms2") > max_vibration) & since)


def anomaly_summary(df: DataFrame, at_least: int = 5) -> DataFrame:
    """Flagged readings per equipment, for equipments with `at_least` of them."""
    return (
        df.filter("is_anomaly")
        .groupBy("equipment_id", "equipment_type", "line_id")
        .agg(
            F.avg("temperature_c").alias("avg_temp"), F.avg("vibration_ms2").alias("avg_vib"),
            F.count("*").alias("anomaly_count"),
        )
        .filter(F.col("anomaly_count") >= at_least)
    )


def alert_rows(df: DataFrame, max_vibration: float = 5.0, max_temperature: float = 90) -> DataFrame:
    """Every reading that raises an alert, typed; vibration takes precedence over temperature."""
    kind = F.when(F.col("vibration_ms2") > max_vibration, "vibration").otherwise("temperature")
    return df.filter(
        (F.col("vibration_ms2") > max_vibration) | (F.col("temperature_c") > max_temperature)
    ).withColumn("alert_type", kind)


def newest_alerts(df: DataFrame, n: int = 10, tie: tuple[str, ...] = ("event_id",), **limits: float) -> DataFrame:
    """The n newest alerts."""
    return alert_rows(df, **limits).orderBy(F.desc("event_time"), *[F.desc(c) for c in tie]).limit(n)


def alert_records(alerts: DataFrame, key: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Monitoring rows: repeatable id, message text and open status, ready to be appended with `append_evolve`."""
    message = F.concat(
        F.col("equipment_id"), F.lit(": "), F.col("alert_type"), F.lit(" alert, vibration="),
        F.format_string("%.2f", "vibration_ms2"), F.lit(", temperature="), F.format_string("%.2f", "temperature_c"),
    )
    identity = F.md5(F.concat_ws("|", "equipment_id", "alert_type", *[F.col(c).cast("string") for c in key]))
    return alerts.select(
        F.concat(F.lit("alert-"), F.left(identity, F.lit(12))).alias("alert_id"), "equipment_id", "line_id", "alert_type",
        "vibration_ms2", "temperature_c", message.alias("query"), F.lit("OPEN").alias("status"),
        F.concat_ws("-", F.lit("alert"), "equipment_id", F.left(identity, F.lit(8))).alias("thread_id"),
        F.col("event_time").alias("created_at"),
    )
