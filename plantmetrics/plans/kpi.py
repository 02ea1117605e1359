"""Overall equipment effectiveness (availability x performance x quality) and the reports built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import count_where, on_day, pct, ratio, since, tiered
from plantmetrics.functions.sizing import small_side
from plantmetrics.operators.ordered import latest_per_key
from plantmetrics.plans.medallion import HOUR, hourly_partials, mean_of

SHIFT_MINUTES = 480
PLANNED_MINUTES = 960
OEE_ALERT = 65


def _log_totals(logs: DataFrame) -> DataFrame:
    """One pass over the logs for all that availability and performance need."""
    return logs.groupBy("equipment_id", "production_date").agg(
        F.sum(SHIFT_MINUTES - F.col("downtime_min")).alias("op_min"),
        (F.count("*") * SHIFT_MINUTES).alias("plan_min"),
        F.sum("actual_qty").alias("actual_qty"), F.sum("planned_qty").alias("planned_qty"),
    )


def _inspection_totals(inspections: DataFrame, logs: DataFrame) -> DataFrame:
    """Per equipment and day; the day has the type it has in the logs, so that no cast hides the logs' column from the scan."""
    day = F.col("inspection_time").cast("date").cast(logs.schema["production_date"].dataType).alias("production_date")
    return inspections.groupBy("equipment_id", day).agg(
        count_where(F.col("passed")).alias("passed"), F.count("passed").alias("judged"), F.count("*").alias("inspections")
    )


def oee_from_logs(
    logs: DataFrame, inspections: DataFrame, as_of: str, days: int = 30, digits: int | None = 1
) -> DataFrame:
    """OEE per equipment and day with a status: >= 0.85 on target, >= 0.75 improve, else urgent."""
    made = _log_totals(logs.filter(since(logs, "production_date", as_of, days)))
    judged = _inspection_totals(inspections.filter(since(inspections, "inspection_time", as_of, days)), logs)
    share = made.join(judged, ["equipment_id", "production_date"]).select(
        "equipment_id", "production_date", ratio(F.col("op_min"), F.col("plan_min")).alias("a"),
        ratio(F.col("actual_qty"), F.col("planned_qty")).alias("p"), ratio(F.col("passed"), F.col("inspections")).alias("q"),
    )
    oee = F.col("a") * F.col("p") * F.col("q")
    return share.select(
        "equipment_id", "production_date", pct(F.col("a"), digits).alias("availability_pct"),
        pct(F.col("p"), digits).alias("performance_pct"), pct(F.col("q"), digits).alias("quality_pct"),
        pct(oee, digits).alias("oee_pct"),
        tiered(oee, [(0.85, "on target"), (0.75, "improve")], "urgent").alias("status"),
    ).orderBy(F.desc("production_date"), "oee_pct", "equipment_id")


def equipment_hourly(clean: DataFrame) -> DataFrame:
    """Hourly view; `avg_current` is the pressure reading, a slot runs at pressure >= 2, is odd at vibration > 5."""
    partials = hourly_partials(
        clean, ["equipment_id", "line_id", "equipment_type"], means=["temperature_c", "pressure_bar"], peaks=["vibration_ms2"],
        flags={"running_minutes_10m": F.col("pressure_bar") >= 2.0, "anomaly_count": F.col("vibration_ms2") > 5.0},
    )
    return partials.select(
        "equipment_id", "line_id", "equipment_type", F.to_date(HOUR).alias("production_date"), F.hour(HOUR).alias("production_hour"),
        F.col("rows").alias("sensor_count"), mean_of("temperature_c").alias("avg_temp"), F.col("peak_vibration_ms2").alias("max_vib"),
        mean_of("pressure_bar").alias("avg_current"), "running_minutes_10m", "anomaly_count",
    )


def oee_from_sensors(hourly: DataFrame) -> DataFrame:
    """Daily OEE from the hourly view. Components are rounded to one digit before they are multiplied."""
    daily = hourly.groupBy("equipment_id", "line_id", "equipment_type", "production_date").agg(
        F.sum("sensor_count").alias("records"), F.sum(F.col("running_minutes_10m") * 10).alias("running_min"),
        F.sum("anomaly_count").alias("total_anomalies"),
    )
    odd = F.col("total_anomalies").cast("double") / F.greatest(F.col("records"), F.lit(1)).cast("double")
    parts = daily.withColumns({
        "availability_pct": pct(F.least(F.col("running_min").cast("double") / PLANNED_MINUTES, F.lit(1.0)), 1),
        "performance_pct": F.round((1.0 - odd) * 95.0, 1),
        "quality_pct": F.lit(97.5),
    })
    product = (F.col("availability_pct") / 100.0) * (F.col("performance_pct") / 100.0) * (F.col("quality_pct") / 100.0)
    return parts.select(
        "equipment_id", "line_id", "equipment_type", "production_date", "availability_pct", "performance_pct",
        "quality_pct", pct(product, 1).alias("oee_pct"), (F.col("running_min").cast("double") / 60).alias("running_hours"),
        "total_anomalies",
    )


def gold_oee(
    logs: DataFrame, master: DataFrame, inspections: DataFrame, fanout: bool = False, digits: int | None = 2
) -> DataFrame:
    """Ratios and percentages per equipment and day; quality is NULL where nothing was inspected.

    Both fact sides are reduced to (equipment, day) before they meet. With `fanout` the quantity is what joining raw
    logs to raw inspections gives (each log counted once per inspection of its day), without making those pairs.
    """
    keys = ["equipment_id", "production_date"]
    known = small_side(master.select("equipment_id", "equipment_type", "line_id"))
    made = _log_totals(logs).join(known, "equipment_id")
    base = made.join(_inspection_totals(inspections, logs), keys, "left")
    times = F.greatest(F.coalesce(F.col("inspections"), F.lit(1)), F.lit(1)) if fanout else F.lit(1)
    shares = base.select(
        *keys, "equipment_type", "line_id", ratio(F.col("op_min"), F.col("plan_min")).alias("availability"),
        ratio(F.col("actual_qty"), F.col("planned_qty")).alias("performance"),
        ratio(F.col("passed"), F.col("judged")).alias("quality"), (F.col("actual_qty") * times).alias("total_actual_qty"),
    )
    return shares.select(
        "*", pct(F.col("availability") * F.col("performance") * F.col("quality"), digits).alias("oee_pct"),
        pct(F.col("availability"), digits).alias("availability_pct"),
        pct(F.col("performance"), digits).alias("performance_pct"), pct(F.col("quality"), digits).alias("quality_pct"),
    )


def loss_decomposition(oee: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Mean losses per line and which to work on first; ties favour availability, then performance."""
    a, p, q = F.col("availability_pct"), F.col("performance_pct"), F.col("quality_pct")
    lost = oee.filter(since(oee, "production_date", as_of, days)).select(
        "line_id", (100.0 - a).alias("al"), (a / 100.0 * (100.0 - p)).alias("pl"),
        (a / 100.0 * p / 100.0 * (100.0 - q)).alias("ql"),
    )
    means = lost.groupBy("line_id").agg(
        F.avg("al").alias("al"), F.avg("pl").alias("pl"), F.avg("ql").alias("ql"),
        F.avg(F.col("al") + F.col("pl") + F.col("ql")).alias("total"),
    )
    first = (
        F.when((F.col("al") >= F.col("pl")) & (F.col("al") >= F.col("ql")), "availability")
        .when(F.col("pl") >= F.col("ql"), "performance").otherwise("quality")
    )
    return means.select(
        "line_id", F.round("al", 1).alias("availability_loss"), F.round("pl", 1).alias("performance_loss"),
        F.round("ql", 1).alias("quality_loss"), F.round("total", 1).alias("total_loss"), first.alias("improve_first"),
    ).orderBy(F.desc("total_loss"), "line_id")


def oee_alerts(oee: DataFrame, day: str, limit: float = OEE_ALERT) -> DataFrame:
    """Equipments below the OEE limit on a day, worst first."""
    shown = ["oee_pct", "availability_pct", "performance_pct", "quality_pct"]
    return (
        oee.filter(on_day(oee, "production_date", day) & (F.col("oee_pct") < limit))
        .select("equipment_id", "line_id", *[F.round(c, 1).alias(c) for c in shown])
        .orderBy("oee_pct", "equipment_id")
    )


def oee_heatmap(oee: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Equipment by day cells."""
    return (
        oee.filter(since(oee, "production_date", as_of, days))
        .select("equipment_id", "production_date", F.round("oee_pct", 1).alias("oee_pct"))
        .orderBy("equipment_id", "production_date")
    )


def oee_trend(oee: DataFrame, as_of: str, lines: Sequence[str], days: int = 30) -> DataFrame:
    """Mean OEE per day for chosen lines."""
    return (
        oee.filter(since(oee, "production_date", as_of, days) & F.col("line_id").isin(*lines))
        .groupBy("production_date", "line_id").agg(F.round(F.avg("oee_pct"), 1).alias("avg_oee_pct"))
        .orderBy("production_date", "line_id")
    )


def loss_distribution(oee: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Mean loss per type: one aggregate turned into three rows."""
    names = ["availability", "performance", "quality"]
    one = oee.filter(since(oee, "production_date", as_of, days)).agg(
        *[F.round(F.avg(100 - F.col(f"{n}_pct")), 1).alias(n) for n in names]
    )
    rows = F.array(*[F.struct(F.lit(n).alias("loss_type"), F.col(n).alias("loss_pct")) for n in names])
    return one.select(F.inline(rows))


def day_counters(oee: DataFrame, day: str, limit: float = OEE_ALERT) -> DataFrame:
    """Mean and lowest OEE of a day and how many equipments are below the limit."""
    return oee.filter(on_day(oee, "production_date", day)).agg(
        F.round(F.avg("oee_pct"), 1).alias("avg_oee"), F.round(F.min("oee_pct"), 1).alias("min_oee"),
        count_where(F.col("oee_pct") < limit).alias("alert_count"),
    )


def panel_first_equipments(gold: DataFrame, as_of: str, days: int = 30, n: int = 5) -> DataFrame:
    """OEE trend of the first n equipments by name."""
    recent = gold.filter(since(gold, "production_date", as_of, days))
    first = recent.select("equipment_id").distinct().orderBy("equipment_id").limit(n)
    return recent.join(F.broadcast(first), "equipment_id", "left_semi").select("equipment_id", "production_date", "oee_pct")


def panel_equipment_mean(gold: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Mean OEE per equipment."""
    return (
        gold.filter(since(gold, "production_date", as_of, days)).groupBy("equipment_id")
        .agg(F.avg("oee_pct").alias("avg_oee_pct"))
    )


def panel_components(gold: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Daily mean of the three components."""
    return gold.filter(since(gold, "production_date", as_of, days)).groupBy("production_date").agg(
        *[F.avg(c).alias(c) for c in ("availability_pct", "performance_pct", "quality_pct")]
    )


def panel_quantity(gold: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Daily quantity."""
    return (
        gold.filter(since(gold, "production_date", as_of, days)).groupBy("production_date")
        .agg(F.sum("total_actual_qty").alias("total_actual_qty"))
    )


def day_count(df: DataFrame, ts: str, day: str) -> DataFrame:
    """Rows of one calendar day."""
    return df.filter(on_day(df, ts, day)).agg(F.count("*").alias("row_count"))


def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per category, most first."""
    return df.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), column)


def mean_oee(oee: DataFrame, by: str, as_of: str, days: int = 7, worst: int | None = None) -> DataFrame:
    """Mean OEE per line or equipment, lowest first, optionally only the worst few."""
    means = (
        oee.filter(since(oee, "production_date", as_of, days)).groupBy(by)
        .agg(F.round(F.avg("oee_pct"), 1).alias("avg_oee")).orderBy("avg_oee", by)
    )
    return means.limit(worst) if worst else means


def defect_ranking(logs: DataFrame, as_of: str, days: int = 7, n: int = 5) -> DataFrame:
    """Quantity and defects per equipment, most defects first."""
    return (
        logs.filter(since(logs, "production_date", as_of, days)).groupBy("equipment_id")
        .agg(F.sum("actual_qty").alias("total_qty"), F.sum("defect_qty").alias("total_defects"))
        .orderBy(F.desc("total_defects"), "equipment_id").limit(n)
    )


def line_summary(oee: DataFrame, as_of: str, days: int = 30, line: str | None = None) -> DataFrame:
    """Mean of the four percentages per line."""
    recent = oee.filter(since(oee, "production_date", as_of, days))
    if line:
        recent = recent.filter(F.col("line_id") == line)
    named = {"oee_pct": "avg_oee_pct", "availability_pct": "avail_pct", "performance_pct": "perf_pct", "quality_pct": "qual_pct"}
    return (
        recent.groupBy("line_id").agg(*[F.round(F.avg(c), 1).alias(n) for c, n in named.items()])
        .orderBy("avg_oee_pct", "line_id")
    )


def recent_anomalies(
    clean: DataFrame, as_of: str, hours: int = 24, equipment: str | None = None, n: int = 10
) -> DataFrame:
    """Flagged readings per equipment in the last hours, most first."""
    found = clean.filter(F.col("is_anomaly") & since(clean, "event_time", as_of, hours=hours))
    if equipment:
        found = found.filter(F.col("equipment_id") == equipment)
    return (
        found.groupBy("equipment_id", "equipment_type", "line_id")
        .agg(
            F.count("*").alias("anomaly_count"), F.round(F.avg("temperature_c"), 1).alias("avg_temp"),
            F.round(F.avg("vibration_ms2"), 3).alias("avg_vib"),
        )
        .orderBy(F.desc("anomaly_count"), "equipment_id").limit(n)
    )


def daily_report(
    oee: DataFrame, clean: DataFrame, as_of: str, days: int = 30, hours: int = 24, line: str | None = None
) -> DataFrame:
    """Mean OEE and days tracked per line next to the plant's recent anomalies and affected equipments."""
    recent = oee.filter(since(oee, "production_date", as_of, days))
    if line:
        recent = recent.filter(F.col("line_id") == line)
    per_line = recent.groupBy("line_id").agg(
        F.round(F.avg("oee_pct"), 1).alias("avg_oee"), F.count("*").alias("days_tracked")
    )
    flagged = clean.filter(F.col("is_anomaly") & since(clean, "event_time", as_of, hours=hours))
    per_equipment = flagged.groupBy("equipment_id").agg(F.count("*").alias("n"))
    plant = per_equipment.agg(
        F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("equipment_id").alias("affected")).alias("plant")
    ).scalar()
    counts = {"total_anomalies": plant["total"], "affected_equipment": plant["affected"]}
    return per_line.withColumns(counts).orderBy("avg_oee", "line_id")


def affected_equipment_estimate(clean: DataFrame, error: float = 0.01) -> DataFrame:
    """Approximate number of equipments with a flagged reading (sketch whose size follows from the relative error)."""
    return clean.filter("is_anomaly").agg(F.approx_count_distinct("equipment_id", error).alias("affected_equipment"))


def latest_reading(clean: DataFrame, anomalies_only: bool = False, tie: Sequence[str] = ("event_id",)) -> DataFrame:
    """Newest reading of every equipment, or its newest flagged one."""
    rows = clean.filter("is_anomaly") if anomalies_only else clean
    return latest_per_key(rows, ["equipment_id"], "event_time", tie)


def table_health(df: DataFrame, ts: str, as_of: str, checks: dict[str, Column]) -> DataFrame:
    """One row: newest row, its lag in hours, row count, and how many rows meet each named (bad) condition."""
    lag = F.unix_seconds(F.lit(f"{as_of} 00:00:00").cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    one = df.agg(F.max(ts).alias("newest"), F.count("*").alias("row_count"), *[count_where(c).alias(n) for n, c in checks.items()])
    return one.withColumn("lag_hours", F.round(lag / 3600, 2))


def rows_per_day(df: DataFrame, ts: str, as_of: str, days: int = 7) -> DataFrame:
    """Daily row counts of the last days."""
    return (
        df.filter(since(df, ts, as_of, days)).groupBy(F.to_date(ts).alias("day"))
        .agg(F.count("*").alias("row_count")).orderBy("day")
    )
