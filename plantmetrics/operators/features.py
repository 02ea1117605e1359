"""Rolling features, forward labels, point-in-time training sets and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import count_where, night, ratio
from plantmetrics.functions.sizing import join_back, small_side
from plantmetrics.operators.changes import merge_upsert
from plantmetrics.operators.ordered import as_of_join, forward_max, rank_cuts, rolling

KEY, TS = "equipment_id", "event_time"
# Frames are row counts: one, four and twenty-four hours of readings every ten seconds.
HOUR_ROWS, FOUR_HOUR_ROWS, DAY_ROWS = 360, 1440, 8640
MODEL_FEATURES = (
    "temp_avg_1h", "temp_trend_4h", "vib_avg_1h", "vib_trend_4h", "anomaly_count_1h", "composite_anomaly_score",
)


def composite_score() -> Column:
    """Weighted distance of temperature, vibration and pressure from their base values."""
    heat, shake, press = F.col("temperature_c"), F.col("vibration_ms2"), F.col("pressure_bar")
    return 0.4 * (heat - 50) / 50 + 0.4 * shake / 10 + 0.2 * (press - 10) / 30


def rolling_features(df: DataFrame, tie: Sequence[str] = (), chunk_rows: int | None = None) -> DataFrame:
    """The 19 rolling features over trailing row frames. Expects one row per (equipment, time), see `dedup`."""
    odd = F.when((F.col("temperature_c") > 90) | (F.col("vibration_ms2") > 6.0), 1).otherwise(0)
    h1, h4, h24 = HOUR_ROWS, FOUR_HOUR_ROWS, DAY_ROWS
    frames = {
        "temp_avg_1h": ("avg", "temperature_c", h1), "temp_max_1h": ("max", "temperature_c", h1),
        "temp_std_1h": ("std", "temperature_c", h1), "temp_avg_4h": ("avg", "temperature_c", h4),
        "vib_avg_1h": ("avg", "vibration_ms2", h1), "vib_max_1h": ("max", "vibration_ms2", h1),
        "vib_std_1h": ("std", "vibration_ms2", h1), "vib_avg_4h": ("avg", "vibration_ms2", h4),
        "vib_avg_24h": ("avg", "vibration_ms2", h24),
        "pressure_avg_1h": ("avg", "pressure_bar", h1), "pressure_max_1h": ("max", "pressure_bar", h1),
        "rpm_avg_1h": ("avg", "rpm", h1), "rpm_std_1h": ("std", "rpm", h1),
        "quality_avg_1h": ("avg", "quality_score", h1),
        "anomaly_count_1h": ("sum", odd, h1), "anomaly_count_4h": ("sum", odd, h4),
    }
    counts = {c: F.round(c).cast("long") for c in ("anomaly_count_1h", "anomaly_count_4h")}
    return rolling(df, KEY, TS, frames, tie, chunk_rows).withColumns({
        **counts,
        "temp_trend_4h": F.col("temp_avg_1h") - F.col("temp_avg_4h"),
        "vib_trend_4h": F.col("vib_avg_1h") - F.col("vib_avg_4h"),
        "composite_anomaly_score": composite_score(),
    })


def sensor_features(df: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Short (61 rows) and long (361 rows) trailing features with ratio, deviation, hour and night flag."""
    frames = {
        "temp_rolling_avg": ("avg", "temperature_c", 61), "temp_rolling_std": ("std", "temperature_c", 61),
        "temp_long_avg": ("avg", "temperature_c", 361), "vibration_rolling_avg": ("avg", "vibration_ms2", 61),
        "vibration_rolling_max": ("max", "vibration_ms2", 361),
    }
    return rolling(df, KEY, TS, frames, tie).withColumns({
        "temp_vibration_ratio": F.col("temperature_c") / F.greatest("vibration_ms2", F.lit(0.01)),
        "temp_deviation": F.col("temperature_c") - F.col("temp_long_avg"),
        "event_hour": F.hour(TS),
        "is_night_shift": F.when(night(F.col(TS)), 1).otherwise(0),
    })


def failure_labels(
    df: DataFrame, threshold: float = 0.15, hours: int = 48, score: Column | str = "composite_anomaly_score"
) -> DataFrame:
    """1 where the score exceeds the threshold now or within the next hours, else 0."""
    value = F.col(score) if isinstance(score, str) else score
    peak = forward_max(df, KEY, TS, value, hours * 3600, "_peak")
    return peak.select(KEY, TS, (F.col("_peak") > threshold).cast("int").alias("failure_within_48h"))


def upsert_features(table: DataFrame, features: DataFrame) -> DataFrame:
    """Feature table after a merge of all columns by its primary key."""
    return merge_upsert(table, features, [KEY, TS])


def training_set(labels: DataFrame, features: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Labels with the newest feature row at or before each label's time."""
    return as_of_join(labels, features, KEY, TS, columns)


def _parts(below: Column, until: Column, names: Sequence[str]) -> Column:
    return F.when(below, names[0]).when(until, names[1]).otherwise(names[2])


def time_split(
    df: DataFrame, ts: str, tie: Sequence[str], fractions: tuple[float, float] = (0.6, 0.8), out: str = "part",
    names: Sequence[str] = ("train", "val", "test"),
) -> DataFrame:
    """Split by time at ranks int(n * 0.6) and int(n * 0.8); `tie` makes the order total.

    Only the two cut keys are looked up (minute histogram, then ranking of the minute that holds the cut); rows are
    compared with them in place, without a sort or shuffle of the table.
    """
    order = [ts, *tie]
    cuts = rank_cuts(df, order, fractions, F.date_trunc("minute", ts))
    key = F.struct(*order)
    both = cuts.select(F.struct("cut_0", "cut_1").alias("cuts")).scalar()
    low, high = F.coalesce(key <= both["cut_0"], F.lit(False)), F.coalesce(key <= both["cut_1"], F.lit(False))
    return df.withColumn(out, _parts(low, high, names))


def stratified_split(
    df: DataFrame, label: str, ids: Sequence[str], fractions: tuple[float, float] = (0.6, 0.8), out: str = "part",
    spread: Column | None = None, spread_bits: int = 64, seed: int = 42, names: Sequence[str] = ("train", "val", "test"),
) -> DataFrame:
    """Repeatable split with exact class shares: rows of a class are ordered by a hash and cut at fixed ranks.

    `spread` replaces the hash (an integer of `spread_bits` bits). The cut keys come from a histogram over the hash,
    so a class of any size is never sorted as a whole.
    """
    hashed = df.withColumn("_spread", F.xxhash64(*ids, F.lit(seed)) if spread is None else spread)
    bucket = F.shiftright("_spread", max(spread_bits - 12, 0))
    cuts = rank_cuts(hashed, ["_spread", *ids], fractions, bucket, [label])
    placed = join_back(hashed, small_side(cuts), [label])
    key = F.struct("_spread", *ids)
    low, high = F.coalesce(key <= F.col("cut_0"), F.lit(False)), F.coalesce(key <= F.col("cut_1"), F.lit(False))
    return placed.withColumn(out, _parts(low, high, names)).drop("_spread", "cut_0", "cut_1")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives, positives, positive rate, and negatives / positives as weight (1.0 without positives)."""
    one = df.agg(count_where(F.col(label) == 0).alias("neg"), count_where(F.col(label) == 1).alias("pos"))
    return one.select(
        "neg", "pos", ratio(F.col("pos"), F.col("neg") + F.col("pos")).alias("pos_rate"),
        F.coalesce(ratio(F.col("neg"), F.col("pos")), F.lit(1.0)).alias("scale_pos_weight"),
    )


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per label."""
    counted = df.groupBy(label).agg(F.count("*").alias("row_count"))
    # One row per label by now.
    total = F.sum("row_count").over(Window.partitionBy())
    return counted.withColumn("share", ratio(F.col("row_count"), total))


def impute(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Missing feature values become 0."""
    return df.na.fill(0, list(columns))


def assemble(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES, out: str = "features") -> DataFrame:
    """Imputed feature columns as one vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(impute(df, columns))
