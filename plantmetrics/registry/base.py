"""Registration and the inputs that queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.plans import kpi, medallion
from plantmetrics.sources import fixtures
from plantmetrics.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


PERCENTAGES = ("oee_pct", "availability_pct", "performance_pct", "quality_pct")


class Inputs:
    """Tables and views below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    def view(self, name: str) -> DataFrame:
        return fixtures.view(self.spark, self.root, name)

    def silver(self) -> DataFrame:
        return medallion.silver_filter(self.view("sensor_events"))

    def clean(self) -> DataFrame:
        return medallion.sensor_clean(self.view("sensor_events"))

    def oee(self) -> DataFrame:
        return kpi.oee_from_sensors(kpi.equipment_hourly(self.silver()))

    def gold(self) -> DataFrame:
        gold = kpi.gold_oee(
            self.view("production_logs"), self.view("equipment_master"), self.view("quality_inspections"), digits=None
        )
        return gold.withColumns({c: near(c, 2) for c in PERCENTAGES})


def query(name: str, sql: str | None = None, views: list[str] | None = None):
    """Register a query over `Inputs`; `sql` is its DuckDB text, which may read `views` and the DERIVED ones."""
    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, root: build(Inputs(spark, root))
        if sql is not None:
            ORACLE[name] = fixtures.with_views(views or [], sql, DERIVED)
        return build

    return add


def near(column: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison; the nudge settles exact halves the same way in both engines."""
    return F.round((F.col(column) if isinstance(column, str) else column) + 1e-9, digits)


def day_text(df: DataFrame, column: str) -> DataFrame:
    """Date column as YYYY-MM-DD text, which reads the same from either engine."""
    return df.withColumn(column, F.col(column).cast("string"))


def sql_near(expression: str, digits: int = 6) -> str:
    return f"round({expression} + 1e-9, {digits})"


_HOURLY = """
    SELECT equipment_id, line_id, equipment_type, CAST(event_time AS DATE) AS production_date,
           CAST(hour(event_time) AS INTEGER) AS production_hour, count(*) AS sensor_count, avg(temperature_c) AS avg_temp,
           max(vibration_ms2) AS max_vib, avg(pressure_bar) AS avg_current,
           CAST(sum(CASE WHEN pressure_bar >= 2.0 THEN 1 ELSE 0 END) AS BIGINT) AS running_minutes_10m,
           CAST(sum(CASE WHEN vibration_ms2 > 5.0 THEN 1 ELSE 0 END) AS BIGINT) AS anomaly_count
    FROM sensor_silver GROUP BY ALL"""
_OEE = """
    SELECT *, round((availability_pct / 100.0) * (performance_pct / 100.0) * (quality_pct / 100.0) * 100, 1) AS oee_pct
    FROM (SELECT equipment_id, line_id, equipment_type, production_date,
                 round(least(CAST(sum(running_minutes_10m * 10) AS DOUBLE) / 960, 1.0) * 100, 1) AS availability_pct,
                 round((1.0 - CAST(sum(anomaly_count) AS DOUBLE) / CAST(greatest(sum(sensor_count), 1) AS DOUBLE)) * 95.0, 1)
                     AS performance_pct,
                 CAST(97.5 AS DOUBLE) AS quality_pct, CAST(sum(running_minutes_10m * 10) AS DOUBLE) / 60 AS running_hours,
                 CAST(sum(anomaly_count) AS BIGINT) AS total_anomalies
          FROM hourly GROUP BY 1, 2, 3, 4)"""
_LOG_DAY = """
    SELECT equipment_id, production_date, CAST(sum(480 - downtime_min) AS DOUBLE) AS op_min,
           CAST(count(*) * 480 AS DOUBLE) AS plan_min, CAST(sum(actual_qty) AS BIGINT) AS actual_qty,
           CAST(sum(planned_qty) AS DOUBLE) AS planned_qty
    FROM production_logs GROUP BY 1, 2"""
_INSPECTION_DAY = """
    SELECT equipment_id, CAST(inspection_time AS DATE) AS production_date,
           CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS DOUBLE) AS passed, CAST(count(*) AS DOUBLE) AS inspections
    FROM quality_inspections GROUP BY 1, 2"""
_GOLD = f"""
    SELECT *, {sql_near('availability * performance * quality * 100', 2)} AS oee_pct,
           {sql_near('availability * 100', 2)} AS availability_pct, {sql_near('performance * 100', 2)} AS performance_pct,
           {sql_near('quality * 100', 2)} AS quality_pct
    FROM (SELECT l.equipment_id, l.production_date, m.equipment_type, m.line_id, op_min / plan_min AS availability,
                 actual_qty / nullif(planned_qty, 0) AS performance, passed / inspections AS quality,
                 actual_qty AS total_actual_qty
          FROM log_day l JOIN equipment_master m ON l.equipment_id = m.equipment_id
          LEFT JOIN inspection_day q ON q.equipment_id = l.equipment_id AND q.production_date = l.production_date)"""
_SNAPSHOT = """
    SELECT event_id, equipment_id, line_id, event_time, temperature_c, vibration_ms2, quality_score, shift
    FROM sensor_silver"""
_LOG_COLUMNS = "event_id, equipment_id, line_id, event_time, {t} AS temperature_c, vibration_ms2, quality_score, shift"


def _log_part(kind: str, version: int, where: str, temperature: str = "temperature_c") -> str:
    return (
        f"SELECT {_LOG_COLUMNS.format(t=temperature)}, '{kind}' AS _change_type, CAST({version} AS BIGINT) AS _commit_version, "
        f"CAST('2024-02-0{version} 00:00:00' AS TIMESTAMP) AS _commit_timestamp FROM snapshot WHERE {where}"
    )


_NIGHT = "shift = 'NIGHT' AND quality_score <= 0.95"
_CHANGELOG = "\nUNION ALL ".join([
    _log_part("insert", 1, "TRUE"), _log_part("delete", 2, "quality_score > 0.95"),
    _log_part("update_preimage", 3, _NIGHT), _log_part("update_postimage", 3, _NIGHT, "temperature_c - 0.5"),
])
_RESTORED = "SELECT * FROM changelog UNION ALL " + "\nUNION ALL ".join([
    _log_part("insert", 4, "quality_score > 0.95"), _log_part("update_preimage", 4, _NIGHT, "temperature_c - 0.5"),
    _log_part("update_postimage", 4, _NIGHT),
])
_ROLL = "OVER (PARTITION BY equipment_id ORDER BY event_time, event_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


def roll(function: str, column: str, rows: int) -> str:
    return f"{function}({column}) {_ROLL.format(n=rows - 1)}"


_SCORE = "0.4 * (temperature_c - 50) / 50 + 0.4 * vibration_ms2 / 10 + 0.2 * (pressure_bar - 10) / 30"
_ODD = "CASE WHEN temperature_c > 90 OR vibration_ms2 > 6.0 THEN 1 ELSE 0 END"
FEATURES = {
    "temp_avg_1h": roll("avg", "temperature_c", 360), "temp_max_1h": roll("max", "temperature_c", 360),
    "temp_std_1h": roll("stddev_samp", "temperature_c", 360), "temp_avg_4h": roll("avg", "temperature_c", 1440),
    "temp_trend_4h": roll("avg", "temperature_c", 360) + " - " + roll("avg", "temperature_c", 1440),
    "vib_avg_1h": roll("avg", "vibration_ms2", 360), "vib_max_1h": roll("max", "vibration_ms2", 360),
    "vib_std_1h": roll("stddev_samp", "vibration_ms2", 360), "vib_avg_4h": roll("avg", "vibration_ms2", 1440),
    "vib_avg_24h": roll("avg", "vibration_ms2", 8640),
    "vib_trend_4h": roll("avg", "vibration_ms2", 360) + " - " + roll("avg", "vibration_ms2", 1440),
    "pressure_avg_1h": roll("avg", "pressure_bar", 360), "pressure_max_1h": roll("max", "pressure_bar", 360),
    "rpm_avg_1h": roll("avg", "rpm", 360), "rpm_std_1h": roll("stddev_samp", "rpm", 360),
    "quality_avg_1h": roll("avg", "quality_score", 360),
    "anomaly_count_1h": f"CAST({roll('sum', _ODD, 360)} AS BIGINT)",
    "anomaly_count_4h": f"CAST({roll('sum', _ODD, 1440)} AS BIGINT)",
    "composite_anomaly_score": _SCORE,
}
_FEATURE_SQL = (
    "SELECT event_id, equipment_id, event_time, shift, temperature_c, "
    + ", ".join(f"{text} AS {name}" for name, text in FEATURES.items()) + " FROM sensor_unique"
)
_LABELS = f"""
    SELECT equipment_id, event_time, CASE WHEN max({_SCORE}) OVER (PARTITION BY equipment_id
           ORDER BY CAST(floor(epoch(event_time)) AS BIGINT) RANGE BETWEEN CURRENT ROW AND 172800 FOLLOWING) > 0.9
           THEN 1 ELSE 0 END AS failure_within_48h
    FROM sensor_unique"""

DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "hourly": (("sensor_silver",), _HOURLY),
    "oee_daily": (("hourly",), _OEE),
    "log_day": (("production_logs",), _LOG_DAY),
    "inspection_day": (("quality_inspections",), _INSPECTION_DAY),
    "gold": (("log_day", "inspection_day", "equipment_master"), _GOLD),
    "snapshot": (("sensor_silver",), _SNAPSHOT),
    "changelog": (("snapshot",), _CHANGELOG),
    "restored": (("changelog",), _RESTORED),
    "sensor_unique": (("sensor_silver",), """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY equipment_id, event_time ORDER BY event_id) AS rn
                                    FROM sensor_silver) WHERE rn = 1"""),
    "features": (("sensor_unique",), _FEATURE_SQL),
    "pdm_labels": (("sensor_unique",), _LABELS),
}
