"""Raw events to clean readings to hourly partials, from which every time grain is rolled up.

A partial holds what merges exactly: row counts, sums with the number of readings behind them, peaks, flag counts. Averages are
only formed at the grain that is asked for, so one scan and one aggregate serve the hourly and the daily tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import count_where
from plantmetrics.operators.quality import silver_filter, with_zscore

HOUR = "hour_start"


def sensor_clean(events: DataFrame) -> DataFrame:
    """Range filter, then the per-equipment z-score over what is left."""
    return with_zscore(silver_filter(events))


def hourly_partials(
    readings: DataFrame, keys: Sequence[str], means: Sequence[str] = (), peaks: Sequence[str] = (),
    flags: Mapping[str, Column] | None = None, ts: str = "event_time",
) -> DataFrame:
    """Mergeable state per keys and hour: `rows`, `sum_*` and `seen_*` per mean, `peak_*`, and a count per flag."""
    state = [F.count("*").alias("rows")]
    for name in means:
        state += [F.sum(name).alias(f"sum_{name}"), F.count(name).alias(f"seen_{name}")]
    state += [F.max(name).alias(f"peak_{name}") for name in peaks]
    state += [count_where(test).alias(name) for name, test in (flags or {}).items()]
    return readings.groupBy(*keys, F.date_trunc("hour", ts).alias(HOUR)).agg(*state)


def rolled_up(partials: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """The same state for a coarser grouping: peaks of peaks, sums of everything else."""
    keys = {c for c in by if isinstance(c, str)}
    state = ("sum_", "seen_", "peak_")
    held = [c for c, kind in partials.dtypes if c not in keys and (c == "rows" or c.startswith(state) or kind == "bigint")]
    merged = [(F.max(c) if c.startswith("peak_") else F.sum(c)).alias(c) for c in held]
    return partials.groupBy(*by).agg(*merged)


def mean_of(name: str) -> Column:
    return F.col(f"sum_{name}") / F.when(F.col(f"seen_{name}") > 0, F.col(f"seen_{name}"))


def equipment_daily(clean: DataFrame) -> DataFrame:
    """Daily state of each equipment of a line. The output names are fixed values of the report."""
    partials = hourly_partials(
        clean, ["line_id", "equipment_id"], means=["temperature_c", "vibration_ms2", "quality_score"],
        peaks=["temperature_c", "vibration_ms2"], flags={"anomaly_count": F.col("is_anomaly")},
    )
    days = rolled_up(partials, ["line_id", "equipment_id", F.to_date(HOUR).alias("oee_date")])
    shown = {
        "avg_temp": mean_of("temperature_c"), "max_temp": F.col("peak_temperature_c"), "avg_vib": mean_of("vibration_ms2"),
        "max_vib": F.col("peak_vibration_ms2"), "avg_quality": mean_of("quality_score"),
    }
    return days.select("oee_date", "line_id", "equipment_id", *[c.alias(n) for n, c in shown.items()], "anomaly_count", F.col("rows").alias("record_count"))


DAILY_KEYS = ("equipment_id", "line_id", "event_date")


def daily_partials(clean: DataFrame) -> DataFrame:
    """Mergeable state of the daily view, one row per equipment, line and day."""
    return rolled_up(hourly_partials(clean, DAILY_KEYS, means=["temperature_c"], peaks=["vibration_ms2"]), DAILY_KEYS)


def daily_view(partials: DataFrame) -> DataFrame:
    """The daily view of any partials of its keys. The output names are fixed values."""
    return rolled_up(partials, DAILY_KEYS).select(
        "equipment_id", "line_id", "event_date", mean_of("temperature_c").alias("avg_temperature_c"),
        F.col("peak_vibration_ms2").alias("max_vibration_ms2"), F.col("rows").alias("event_count"),
    )


def sensor_daily(clean: DataFrame) -> DataFrame:
    """Declared gold view over the cleaned stream table, by the table's own event date."""
    return daily_view(hourly_partials(clean, DAILY_KEYS, means=["temperature_c"], peaks=["vibration_ms2"]))
