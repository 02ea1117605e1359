"""KPI, anomaly and governance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.operators import anomaly, governance, quality
from plantmetrics.plans import kpi, medallion
from plantmetrics.registry.base import PERCENTAGES, Inputs, day_text, near, query, sql_near
from plantmetrics.sources.fixtures import AS_OF, AS_OF_PRODUCTION
from plantmetrics.streaming import evolving

PREVIOUS_DAY = "2024-01-30"
LAST_30 = "production_date >= DATE '2024-01-01'"
LAST_30_PRODUCTION = "production_date >= DATE '1998-12-01'"
LAST_7_PRODUCTION = "production_date >= DATE '1998-12-24'"


@query("k1_daily_equipment", f"""
SELECT CAST(CAST(event_time AS DATE) AS STRING) AS oee_date, line_id, equipment_id, {sql_near('avg(temperature_c)')} AS avg_temp,
       max(temperature_c) AS max_temp, {sql_near('avg(vibration_ms2)')} AS avg_vib, max(vibration_ms2) AS max_vib,
       {sql_near('avg(quality_score)')} AS avg_quality, count(CASE WHEN is_anomaly THEN 1 END) AS anomaly_count,
       count(*) AS record_count
FROM sensor_clean GROUP BY 1, 2, 3""", ["sensor_clean"])
def daily_equipment(t: Inputs):
    daily = day_text(medallion.equipment_daily(t.clean()), "oee_date")
    return daily.withColumns({c: near(c) for c in ("avg_temp", "avg_vib", "avg_quality")})


@query("k2_oee_from_logs", f"""
SELECT equipment_id, CAST(production_date AS STRING) AS production_date, {sql_near('a * 100', 1)} AS availability_pct, {sql_near('p * 100', 1)} AS performance_pct,
       {sql_near('q * 100', 1)} AS quality_pct, {sql_near('a * p * q * 100', 1)} AS oee_pct,
       CASE WHEN a * p * q >= 0.85 THEN 'on target' WHEN a * p * q >= 0.75 THEN 'improve' ELSE 'urgent' END AS status
FROM (SELECT l.equipment_id, l.production_date, op_min / plan_min AS a, actual_qty / planned_qty AS p, passed / inspections AS q
      FROM log_day l JOIN inspection_day i ON l.equipment_id = i.equipment_id AND l.production_date = i.production_date
      WHERE l.production_date >= DATE '1998-12-01')""", ["log_day", "inspection_day"])
def oee_from_logs(t: Inputs):
    made = kpi.oee_from_logs(t.view("production_logs"), t.view("quality_inspections"), AS_OF_PRODUCTION, digits=None)
    return day_text(made, "production_date").withColumns({c: near(c, 1) for c in PERCENTAGES})


@query("k3_hourly", f"""
SELECT * REPLACE ({sql_near('avg_temp')} AS avg_temp, {sql_near('avg_current')} AS avg_current,
                  CAST(production_date AS STRING) AS production_date) FROM hourly""", ["hourly"])
def hourly(t: Inputs):
    view = day_text(kpi.equipment_hourly(t.silver()), "production_date")
    return view.withColumns({c: near(c) for c in ("avg_temp", "avg_current")})


@query("k4_oee_from_sensors", f"""
SELECT * REPLACE ({sql_near('running_hours')} AS running_hours, CAST(production_date AS STRING) AS production_date) FROM oee_daily""",
       ["oee_daily"])
def oee_from_sensors(t: Inputs):
    return day_text(t.oee(), "production_date").withColumn("running_hours", near("running_hours"))


@query("k5_loss_decomposition", f"""
SELECT line_id, round(avg(al), 1) AS availability_loss, round(avg(pl), 1) AS performance_loss, round(avg(ql), 1) AS quality_loss,
       round(avg(al + pl + ql), 1) AS total_loss,
       CASE WHEN avg(al) >= avg(pl) AND avg(al) >= avg(ql) THEN 'availability' WHEN avg(pl) >= avg(ql) THEN 'performance'
            ELSE 'quality' END AS improve_first
FROM (SELECT line_id, 100.0 - availability_pct AS al, availability_pct / 100.0 * (100.0 - performance_pct) AS pl,
             availability_pct / 100.0 * performance_pct / 100.0 * (100.0 - quality_pct) AS ql
      FROM oee_daily WHERE {LAST_30}) GROUP BY line_id""", ["oee_daily"])
def loss_decomposition(t: Inputs):
    return kpi.loss_decomposition(t.oee(), AS_OF)


@query("k6_oee_alerts", """
SELECT equipment_id, line_id, oee_pct, availability_pct, performance_pct, quality_pct FROM oee_daily
WHERE production_date = DATE '2024-01-30' AND oee_pct < 65""", ["oee_daily"])
def oee_alerts(t: Inputs):
    return kpi.oee_alerts(t.oee(), PREVIOUS_DAY)


@query("k7_heatmap", f"""
SELECT equipment_id, CAST(production_date AS STRING) AS production_date, oee_pct FROM oee_daily WHERE {LAST_30}""", ["oee_daily"])
def heatmap(t: Inputs):
    return day_text(kpi.oee_heatmap(t.oee(), AS_OF), "production_date")


@query("k8_line_trend", f"""
SELECT CAST(production_date AS STRING) AS production_date, line_id, round(avg(oee_pct), 1) AS avg_oee_pct FROM oee_daily
WHERE {LAST_30} AND line_id IN ('LINE01', 'LINE02', 'LINE03') GROUP BY 1, 2""", ["oee_daily"])
def line_trend(t: Inputs):
    return day_text(kpi.oee_trend(t.oee(), AS_OF, ["LINE01", "LINE02", "LINE03"]), "production_date")


@query("k9_loss_distribution", " UNION ALL ".join(
    f"SELECT '{n}' AS loss_type, round(avg(100 - {n}_pct), 1) AS loss_pct FROM oee_daily WHERE {LAST_30}"
    for n in ("availability", "performance", "quality")), ["oee_daily"])
def loss_distribution(t: Inputs):
    return kpi.loss_distribution(t.oee(), AS_OF)


@query("k10_day_counters", """
SELECT round(avg(oee_pct), 1) AS avg_oee, round(min(oee_pct), 1) AS min_oee, count(CASE WHEN oee_pct < 65 THEN 1 END) AS alert_count
FROM oee_daily WHERE production_date = DATE '2024-01-30'""", ["oee_daily"])
def day_counters(t: Inputs):
    return kpi.day_counters(t.oee(), PREVIOUS_DAY)


@query("k11a_gold_fanout", f"""
SELECT p.equipment_id, CAST(p.production_date AS STRING) AS production_date, e.equipment_type, e.line_id,
       {sql_near('CAST(sum(480 - p.downtime_min) AS DOUBLE) / CAST(count(*) * 480 AS DOUBLE)')} AS availability,
       {sql_near('CAST(sum(p.actual_qty) AS DOUBLE) / nullif(CAST(sum(p.planned_qty) AS DOUBLE), 0)')} AS performance,
       {sql_near('CAST(sum(CASE WHEN q.passed THEN 1 ELSE 0 END) AS DOUBLE) / nullif(CAST(count(q.passed) AS DOUBLE), 0)')} AS quality,
       CAST(sum(p.actual_qty) AS BIGINT) AS total_actual_qty
FROM production_logs p JOIN equipment_master e ON p.equipment_id = e.equipment_id
LEFT JOIN quality_inspections q ON p.equipment_id = q.equipment_id AND CAST(q.inspection_time AS DATE) = p.production_date
GROUP BY 1, 2, 3, 4""", ["production_logs", "equipment_master", "quality_inspections"])
def gold_fanout(t: Inputs):
    gold = kpi.gold_oee(
        t.view("production_logs"), t.view("equipment_master"), t.view("quality_inspections"), fanout=True
    )
    shares = [near(c).alias(c) for c in ("availability", "performance", "quality")]
    return day_text(gold, "production_date").select(
        "equipment_id", "production_date", "equipment_type", "line_id", *shares, "total_actual_qty"
    )


@query("k11b_gold", f"""
SELECT * REPLACE ({sql_near('availability')} AS availability, {sql_near('performance')} AS performance,
                  {sql_near('quality')} AS quality, CAST(production_date AS STRING) AS production_date) FROM gold""", ["gold"])
def gold(t: Inputs):
    return day_text(t.gold(), "production_date").withColumns({c: near(c) for c in ("availability", "performance", "quality")})


@query("k12_panel_trend", f"""
SELECT equipment_id, CAST(production_date AS STRING) AS production_date, oee_pct FROM gold WHERE {LAST_30_PRODUCTION} AND equipment_id IN (
    SELECT DISTINCT equipment_id FROM gold WHERE {LAST_30_PRODUCTION} ORDER BY 1 LIMIT 5)""", ["gold"])
def panel_trend(t: Inputs):
    return day_text(kpi.panel_first_equipments(t.gold(), AS_OF_PRODUCTION), "production_date")


@query("k12_panel_mean", f"""
SELECT equipment_id, {sql_near('avg(oee_pct)')} AS avg_oee_pct FROM gold WHERE {LAST_30_PRODUCTION} GROUP BY 1""", ["gold"])
def panel_mean(t: Inputs):
    return kpi.panel_equipment_mean(t.gold(), AS_OF_PRODUCTION).withColumn("avg_oee_pct", near("avg_oee_pct"))


@query("k12_panel_components", f"""
SELECT CAST(production_date AS STRING) AS production_date, {sql_near('avg(availability_pct)')} AS availability_pct, {sql_near('avg(performance_pct)')} AS performance_pct,
       {sql_near('avg(quality_pct)')} AS quality_pct FROM gold WHERE {LAST_30_PRODUCTION} GROUP BY 1""", ["gold"])
def panel_components(t: Inputs):
    panel = day_text(kpi.panel_components(t.gold(), AS_OF_PRODUCTION), "production_date")
    return panel.withColumns({c: near(c) for c in ("availability_pct", "performance_pct", "quality_pct")})


@query("k12_panel_quantity", f"""
SELECT CAST(production_date AS STRING) AS production_date, CAST(sum(total_actual_qty) AS BIGINT) AS total_actual_qty FROM gold WHERE {LAST_30_PRODUCTION} GROUP BY 1""",
       ["gold"])
def panel_quantity(t: Inputs):
    return day_text(kpi.panel_quantity(t.gold(), AS_OF_PRODUCTION), "production_date")


@query("k14_day_count", "SELECT count(*) AS row_count FROM sensor_events WHERE CAST(event_time AS DATE) = DATE '2024-01-30'",
       ["sensor_events"])
def day_count(t: Inputs):
    return kpi.day_count(t.view("sensor_events"), "event_time", PREVIOUS_DAY)


@query("k15_category_counts", "SELECT failure_category, count(*) AS row_count FROM maintenance_clean GROUP BY 1", ["maintenance_clean"])
def category_counts(t: Inputs):
    return kpi.category_counts(t.view("maintenance_clean"), "failure_category")


@query("k16_line_mean", f"SELECT line_id, round(avg(oee_pct), 1) AS avg_oee FROM gold WHERE {LAST_7_PRODUCTION} GROUP BY 1", ["gold"])
def line_mean(t: Inputs):
    return kpi.mean_oee(t.gold(), "line_id", AS_OF_PRODUCTION)


@query("k16_worst_equipment", """
SELECT equipment_id, round(avg(oee_pct), 1) AS avg_oee FROM oee_daily WHERE production_date >= DATE '2024-01-24'
GROUP BY 1 ORDER BY avg_oee, equipment_id LIMIT 5""", ["oee_daily"])
def worst_equipment(t: Inputs):
    return kpi.mean_oee(t.oee(), "equipment_id", AS_OF, worst=5)


@query("k17_defect_ranking", f"""
SELECT equipment_id, CAST(sum(actual_qty) AS BIGINT) AS total_qty, CAST(sum(defect_qty) AS BIGINT) AS total_defects
FROM production_logs WHERE {LAST_7_PRODUCTION} GROUP BY 1 ORDER BY total_defects DESC, equipment_id LIMIT 5""", ["production_logs"])
def defect_ranking(t: Inputs):
    return kpi.defect_ranking(t.view("production_logs"), AS_OF_PRODUCTION)


@query("k18_line_summary", f"""
SELECT line_id, round(avg(oee_pct), 1) AS avg_oee_pct, round(avg(availability_pct), 1) AS avail_pct,
       round(avg(performance_pct), 1) AS perf_pct, round(avg(quality_pct), 1) AS qual_pct
FROM oee_daily WHERE {LAST_30} GROUP BY 1""", ["oee_daily"])
def line_summary(t: Inputs):
    return kpi.line_summary(t.oee(), AS_OF)


RECENT = "is_anomaly AND event_time >= TIMESTAMP '2024-01-01 00:00:00'"


@query("k19_recent_anomalies", f"""
SELECT equipment_id, equipment_type, line_id, count(*) AS anomaly_count, round(avg(temperature_c), 1) AS avg_temp,
       round(avg(vibration_ms2), 3) AS avg_vib
FROM sensor_clean WHERE {RECENT} GROUP BY 1, 2, 3 ORDER BY anomaly_count DESC, equipment_id LIMIT 10""", ["sensor_clean"])
def recent_anomalies(t: Inputs):
    return kpi.recent_anomalies(t.clean(), AS_OF, hours=720)


@query("k20_daily_report", f"""
SELECT line_id, round(avg(oee_pct), 1) AS avg_oee, count(*) AS days_tracked,
       (SELECT count(*) FROM sensor_clean WHERE {RECENT}) AS total_anomalies,
       (SELECT count(DISTINCT equipment_id) FROM sensor_clean WHERE {RECENT}) AS affected_equipment
FROM oee_daily WHERE {LAST_30} GROUP BY 1""", ["oee_daily", "sensor_clean"])
def daily_report(t: Inputs):
    return kpi.daily_report(t.oee(), t.clean(), AS_OF, hours=720)


@query("k20_affected_estimate", """
SELECT count(DISTINCT equipment_id) AS affected_exact, TRUE AS estimate_within_5_pct FROM sensor_clean WHERE is_anomaly""", ["sensor_clean"])
def affected_estimate(t: Inputs):
    """The sketch's estimate held against the exact count."""
    clean = t.clean()
    exact = clean.filter("is_anomaly").agg(F.countDistinct("equipment_id").alias("affected_exact"))
    both = exact.withColumn("estimate", kpi.affected_equipment_estimate(clean).select("affected_equipment").scalar())
    return both.select("affected_exact", (F.abs(F.col("estimate") - F.col("affected_exact")) * 20 <= F.col("affected_exact")).alias("estimate_within_5_pct"))


_WINDOWS = {7: "2024-01-24", 14: "2024-01-17", 30: "2024-01-01"}


@query("k20_affected_by_sketch", " UNION ALL ".join(f"""
SELECT {days} AS days, count(DISTINCT equipment_id) AS affected_exact, TRUE AS estimate_within_5_pct
FROM sensor_clean WHERE is_anomaly AND CAST(event_time AS DATE) BETWEEN DATE '{first}' AND DATE '2024-01-31'""" for days, first in _WINDOWS.items()),
       ["sensor_clean"])
def affected_by_sketch(t: Inputs):
    """Equipments with a flagged reading in several windows, from one stored sketch per day, held against exact counts."""
    flagged = stored(t.clean().filter("is_anomaly").select("equipment_id", "event_time"), "flagged")
    sketches = stored(evolving.day_sketches(flagged, "event_time", "equipment_id"), "sketches")
    out = None
    for days, first in _WINDOWS.items():
        exact = flagged.filter(F.to_date("event_time").between(F.lit(first).cast("date"), F.lit("2024-01-31").cast("date")))
        both = exact.agg(F.countDistinct("equipment_id").alias("affected_exact")).crossJoin(evolving.distinct_in(sketches, first, "2024-01-31"))  # One row each.
        fits = F.abs(F.col("estimate") - F.col("affected_exact")) * 20 <= F.col("affected_exact")
        row = both.select(F.lit(days).alias("days"), "affected_exact", fits.alias("estimate_within_5_pct"))
        out = row if out is None else out.unionByName(row)
    return out


_LATEST = """SELECT event_id, equipment_id, equipment_type, event_time, temperature_c FROM (
    SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY event_time DESC, event_id DESC) AS rn
    FROM sensor_clean {where}) WHERE rn = 1"""


@query("k21_latest_reading", _LATEST.format(where=""), ["sensor_clean"])
def latest_reading(t: Inputs):
    return kpi.latest_reading(t.clean()).select("event_id", "equipment_id", "equipment_type", "event_time", "temperature_c")


@query("k21_latest_anomaly", _LATEST.format(where="WHERE is_anomaly"), ["sensor_clean"])
def latest_anomaly(t: Inputs):
    found = kpi.latest_reading(t.clean(), anomalies_only=True)
    return found.select("event_id", "equipment_id", "equipment_type", "event_time", "temperature_c")


@query("k22_table_health", """
SELECT max(event_time) AS newest, count(*) AS row_count,
       round(CAST(epoch(TIMESTAMP '2024-01-31') - floor(epoch(max(event_time))) AS DOUBLE) / 3600, 2) AS lag_hours,
       count(*) FILTER (WHERE temperature_c IS NULL) AS null_temperature,
       count(*) FILTER (WHERE NOT temperature_c BETWEEN 10 AND 150) AS odd_temperature
FROM sensor_events""", ["sensor_events"])
def table_health(t: Inputs):
    checks = {"null_temperature": F.col("temperature_c").isNull(), "odd_temperature": ~F.col("temperature_c").between(10, 150)}
    return kpi.table_health(t.view("sensor_events"), "event_time", AS_OF, checks)


@query("k22_rows_per_day", """
SELECT CAST(CAST(event_time AS DATE) AS STRING) AS day, count(*) AS row_count FROM sensor_events
WHERE event_time >= TIMESTAMP '2024-01-24' GROUP BY 1""", ["sensor_events"])
def rows_per_day(t: Inputs):
    return day_text(kpi.rows_per_day(t.view("sensor_events"), "event_time", AS_OF), "day")


@query("n1_rolling_zscore", f"""
SELECT event_id, equipment_id, event_time, temperature_c, {sql_near('m')} AS rolling_avg, round(z, 2) AS z_score,
       'ANOMALY' AS anomaly_flag
FROM (SELECT *, (temperature_c - m) / nullif(s, 0) AS z FROM (
        SELECT *, avg(temperature_c) OVER w AS m, stddev_samp(temperature_c) OVER w AS s FROM sensor_silver
        WINDOW w AS (PARTITION BY equipment_id ORDER BY event_time, event_id ROWS BETWEEN 359 PRECEDING AND CURRENT ROW)))
WHERE abs(z) > 3""", ["sensor_silver"])
def rolling_zscore(t: Inputs):
    found = anomaly.rolling_zscore(t.silver(), tie=("event_id",))
    return found.select(
        "event_id", "equipment_id", "event_time", "temperature_c", near("rolling_avg").alias("rolling_avg"), "z_score",
        "anomaly_flag",
    )


@query("n2_threshold_anomalies", f"""
SELECT equipment_id, {sql_near('avg(temperature_c)')} AS avg_temp, {sql_near('avg(vibration_ms2)')} AS avg_vib,
       {sql_near('avg(pressure_bar)')} AS avg_curr, max(event_time) AS last_seen
FROM sensor_silver WHERE temperature_c > 85 OR vibration_ms2 > 5 GROUP BY 1 ORDER BY last_seen DESC, equipment_id LIMIT 10""",
       ["sensor_silver"])
def threshold_anomalies(t: Inputs):
    found = anomaly.threshold_anomalies(t.silver())
    return found.withColumns({c: near(c) for c in ("avg_temp", "avg_vib", "avg_curr")})


@query("n2_vibration_events", """
SELECT event_id, equipment_id, event_time, vibration_ms2 FROM sensor_silver
WHERE vibration_ms2 > 5 AND event_time >= TIMESTAMP '2024-01-24'""", ["sensor_silver"])
def vibration_events(t: Inputs):
    from plantmetrics.functions.expressions import since

    silver = t.silver()
    found = anomaly.vibration_events(silver, since(silver, "event_time", AS_OF, days=7))
    return found.select("event_id", "equipment_id", "event_time", "vibration_ms2")


@query("n3_anomaly_summary", f"""
SELECT equipment_id, equipment_type, line_id, {sql_near('avg(temperature_c)')} AS avg_temp, {sql_near('avg(vibration_ms2)')} AS avg_vib,
       count(*) AS anomaly_count FROM sensor_clean WHERE is_anomaly GROUP BY 1, 2, 3 HAVING count(*) >= 1""", ["sensor_clean"])
def anomaly_summary(t: Inputs):
    found = anomaly.anomaly_summary(t.clean(), at_least=1)
    return found.withColumns({c: near(c) for c in ("avg_temp", "avg_vib")})


@query("n3_at_least_five", f"""
SELECT equipment_id, equipment_type, line_id, {sql_near('avg(temperature_c)')} AS avg_temp, {sql_near('avg(vibration_ms2)')} AS avg_vib,
       count(*) AS anomaly_count FROM sensor_clean WHERE is_anomaly GROUP BY 1, 2, 3 HAVING count(*) >= 5""", ["sensor_clean"])
def anomalies_at_least_five(t: Inputs):
    """With the default bound."""
    return anomaly.anomaly_summary(t.clean()).withColumns({c: near(c) for c in ("avg_temp", "avg_vib")})


_ALERT = "CASE WHEN vibration_ms2 > 5 THEN 'vibration' ELSE 'temperature' END"


@query("n4_newest_alerts", f"""
SELECT event_id, equipment_id, event_time, {_ALERT} AS alert_type FROM sensor_silver
WHERE vibration_ms2 > 5 OR temperature_c > 90 ORDER BY event_time DESC, event_id DESC LIMIT 10""", ["sensor_silver"])
def newest_alerts(t: Inputs):
    return anomaly.newest_alerts(t.silver()).select("event_id", "equipment_id", "event_time", "alert_type")


@query("n5_alert_records", f"""
SELECT concat('alert-', left(h, 12)) AS alert_id, equipment_id, line_id, alert_type, vibration_ms2, temperature_c,
       concat(equipment_id, ': ', alert_type, ' alert, vibration=', printf('%.2f', vibration_ms2), ', temperature=',
              printf('%.2f', temperature_c)) AS query,
       'OPEN' AS status, concat_ws('-', 'alert', equipment_id, left(h, 8)) AS thread_id
FROM (SELECT *, md5(concat_ws('|', equipment_id, alert_type, CAST(event_id AS STRING))) AS h FROM (
        SELECT *, {_ALERT} AS alert_type FROM sensor_silver WHERE vibration_ms2 > 5 OR temperature_c > 90))""", ["sensor_silver"])
def alert_records(t: Inputs):
    return anomaly.alert_records(anomaly.alert_rows(t.silver())).drop("created_at")


_MASKED = "concat(left(user_email, 2), '***')"


@query("g1_mask", f"SELECT event_id, {_MASKED} AS user_email FROM audit_log", ["audit_log"])
def mask(t: Inputs):
    return governance.mask(t.view("audit_log"), "user_email", ["analyst"]).select("event_id", "user_email")


@query("g1_mask_by_row", f"""
SELECT event_id, CASE WHEN action_name = 'getTable' THEN user_email ELSE {_MASKED} END AS user_email FROM audit_log""", ["audit_log"])
def mask_by_row(t: Inputs):
    roles = F.when(F.col("action_name") == "getTable", F.array(F.lit("admin"))).otherwise(F.array(F.lit("analyst")))
    return governance.mask_by_row(t.view("audit_log").withColumn("roles", roles), "user_email", "roles").select("event_id", "user_email")


@query("u1_sql_mask", f"SELECT event_id, {_MASKED} AS user_email FROM audit_log", ["audit_log"])
def sql_mask(t: Inputs):
    governance.register_mask(t.spark, "mask_email", ["analyst"])
    return t.view("audit_log").selectExpr("event_id", "mask_email(user_email) AS user_email")


@query("g2_recent_access", """
SELECT event_time, user_email, action_name, table_name, status FROM audit_log
WHERE event_date >= DATE '2024-01-30' AND action_name IN ('getTable', 'executeQuery', 'updateTable', 'deleteTable')
ORDER BY event_time DESC, user_email LIMIT 100""", ["audit_log"])
def recent_access(t: Inputs):
    return governance.recent_access(t.view("audit_log"), AS_OF)


@query("g3_night_access", """
SELECT user_email, count(*) AS access_count, min(event_time) AS first_access, max(event_time) AS last_access FROM audit_log
WHERE (hour(event_time) >= 22 OR hour(event_time) <= 6) AND event_date >= DATE '2024-01-01' AND action_name = 'executeQuery'
GROUP BY 1 HAVING count(*) > 2""", ["audit_log"])
def night_access(t: Inputs):
    return governance.night_access(t.view("audit_log"), AS_OF, days=30, more_than=2)


@query("g3_night_access_week", """
SELECT user_email, count(*) AS access_count, min(event_time) AS first_access, max(event_time) AS last_access FROM audit_log
WHERE (hour(event_time) >= 22 OR hour(event_time) <= 6) AND event_date >= DATE '2024-01-24' AND action_name = 'executeQuery'
GROUP BY 1 HAVING count(*) > 10""", ["audit_log"])
def night_access_week(t: Inputs):
    """With the default week and bound."""
    return governance.night_access(t.view("audit_log"), AS_OF)


@query("g4_table_access", """
SELECT CAST(CAST(event_time AS DATE) AS STRING) AS access_date, user_email, count(*) AS query_count FROM audit_log
WHERE table_name = 'ml.t1' AND event_date >= DATE '2024-01-01' GROUP BY 1, 2""", ["audit_log"])
def table_access(t: Inputs):
    return day_text(governance.table_access(t.view("audit_log"), "ml.t1", AS_OF), "access_date")


@query("g5_contract", """
WITH c AS (SELECT count(*) AS total, count(*) FILTER (WHERE production_date = DATE '1998-12-31') AS today,
                  count(*) FILTER (WHERE quality IS NULL) AS nulls FROM gold)
SELECT 'data present' AS check_name, CASE WHEN today > 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       concat(CAST(today AS STRING), ' rows today') AS detail FROM c
UNION ALL SELECT 'no NULL in quality', CASE WHEN nulls = 0 THEN 'PASS' ELSE 'FAIL' END, concat(CAST(nulls AS STRING), ' NULL values') FROM c
UNION ALL SELECT 'minimum rows', CASE WHEN total >= 500 THEN 'PASS' ELSE 'FAIL' END,
       concat(CAST(total AS STRING), ' rows, at least 500 wanted') FROM c""", ["gold"])
def contract(t: Inputs):
    return quality.contract_check(t.gold(), "production_date", AS_OF_PRODUCTION, ["quality"])
