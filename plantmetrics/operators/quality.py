"""Cleaning, expectations, rescue of unparseable values, and data contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from plantmetrics.functions.expressions import count_where, on_day, ratio
from plantmetrics.functions.sizing import join_back, small_side

# Rule names, texts and bounds of the quality rules.
VALID_EQUIPMENT = "equipment_id RLIKE '^EQ[0-9]{3}' AND LENGTH(equipment_id) = 5"
WARN_RULES = {"valid_equipment": VALID_EQUIPMENT}
DROP_RULES = {
    "valid_temperature": "temperature_c BETWEEN 0 AND 150",
    "valid_vibration": "vibration_ms2 BETWEEN 0 AND 20",
    "has_time": "event_time IS NOT NULL",
}


def silver_filter(
    df: DataFrame, temperature: tuple[float, float] = (10, 150), quality: tuple[float, float] = (0, 1)
) -> DataFrame:
    """Drop physically impossible readings: temperature 10..150, quality 0..1, vibration, pressure and rpm not negative."""
    return df.filter(
        F.col("temperature_c").between(*temperature)
        & (F.col("vibration_ms2") >= 0)
        & (F.col("pressure_bar") >= 0)
        & (F.col("rpm") >= 0)
        & F.col("quality_score").between(*quality)
    )


def incremental_bounds(
    df: DataFrame, temperature: tuple[float, float] = (0, 150), vibration: tuple[float, float] = (0, 20)
) -> DataFrame:
    """Bounds of the incremental load (temperature 0..150, vibration 0..20); wider than the full clean."""
    return df.filter(F.col("temperature_c").between(*temperature) & F.col("vibration_ms2").between(*vibration))


def with_zscore(
    df: DataFrame, value: str = "temperature_c", key: str = "equipment_id", k: float = 3.0,
    out: str = "temp_zscore", flag: str = "is_anomaly",
) -> DataFrame:
    """Per-key z-score and |z| > k flag; NULL where the key has one reading or no spread.

    Mean and spread are aggregated map-side and joined back, so a key that holds a third of the table is never sorted
    into one task.
    """
    stats = df.groupBy(key).agg(F.avg(value).alias("_mean"), F.stddev(value).alias("_spread"))
    scored = join_back(df, small_side(stats), [key]).withColumn(out, ratio(F.col(value) - F.col("_mean"), F.col("_spread")))
    return scored.withColumn(flag, F.abs(F.col(out)) > k).drop("_mean", "_spread")


def _met(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def keep_expected(df: DataFrame, drop: Mapping[str, str]) -> DataFrame:
    """Rows that meet every rule; a NULL result counts as not met. Works on streams."""
    for rule in drop.values():
        df = df.filter(_met(rule))
    return df


def expectation_metrics(df: DataFrame, warn: Mapping[str, str], drop: Mapping[str, str]) -> DataFrame:
    """One row per rule: action, rows that met it and rows that failed it, in one pass."""
    rules = [(n, "warn", r) for n, r in warn.items()] + [(n, "drop", r) for n, r in drop.items()]
    counts = [count_where(_met(r)).alias(f"p{i}") for i, (_, _, r) in enumerate(rules)]
    one = df.agg(F.count("*").alias("n"), *counts)
    lines = [
        F.struct(
            F.lit(name).alias("rule"), F.lit(action).alias("action"), F.col(f"p{i}").alias("passed"),
            (F.col("n") - F.col(f"p{i}")).alias("failed"),
        )
        for i, (name, action, _) in enumerate(rules)
    ]
    return one.select(F.inline(F.array(*lines)))


def expect(
    df: DataFrame, warn: Mapping[str, str] = WARN_RULES, drop: Mapping[str, str] = DROP_RULES
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, metrics): warn rules only count, drop rules also remove rows."""
    return keep_expected(df, drop), expectation_metrics(df, warn, drop)


def rescue(df: DataFrame, schema: StructType, out: str = "_rescued_data") -> DataFrame:
    """Cast string columns to `schema`; values that do not fit are kept as JSON in `out` (NULL when all fit)."""
    raw = [c for c in schema.fieldNames() if c in df.columns]
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields if f.name in raw}
    lost = [
        F.when(F.col(c).isNotNull() & cast[c].isNull(), F.struct(F.lit(c).alias("key"), F.col(c).cast(StringType()).alias("value")))
        for c in raw
    ]
    bad = F.array_compact(F.array(*lost))
    others = [c for c in df.columns if c not in raw]
    return df.select(
        *others, *[cast[c].alias(c) for c in raw],
        F.when(F.size(bad) > 0, F.to_json(F.map_from_entries(bad))).alias(out),
    )


def clean_events(df: DataFrame) -> DataFrame:
    """Rows with an equipment, plus their calendar day; stateless, so the same for batches and streams."""
    return df.filter(F.col("equipment_id").isNotNull()).withColumn("event_date", F.col("event_time").cast("date"))


def contract_check(
    df: DataFrame, day_column: str, today: str, not_null: Sequence[str], min_rows: int = 500
) -> DataFrame:
    """Rows (check_name, status, detail): data present today, no NULL in the listed columns, enough rows. One pass."""
    today_rows = count_where(on_day(df, day_column, today)).alias("today")
    nulls = [count_where(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    one = df.agg(F.count("*").alias("total"), today_rows, *nulls)

    def line(name: str, good: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"), F.when(good, "PASS").otherwise("FAIL").alias("status"), detail.alias("detail")
        )

    lines = [line("data present", F.col("today") > 0, F.concat(F.col("today").cast("string"), F.lit(" rows today")))]
    for c in not_null:
        n = F.col(f"null_{c}")
        lines.append(line(f"no NULL in {c}", n == 0, F.concat(n.cast("string"), F.lit(" NULL values"))))
    enough = F.concat(F.col("total").cast("string"), F.lit(f" rows, at least {min_rows} wanted"))
    lines.append(line("minimum rows", F.col("total") >= min_rows, enough))
    return one.select(F.inline(F.array(*lines)))
