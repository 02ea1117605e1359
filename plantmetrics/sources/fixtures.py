"""Plant-shaped views over the given tables, as one SQL text per view that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plantmetrics.sources.tables import read_table

AS_OF = "2024-01-31"
AS_OF_PRODUCTION = "1998-12-31"


def _equipment(n: str) -> str:
    return f"concat('EQ', lpad(CAST({n} % 50 + 1 AS STRING), 3, '0'))"


def _line(n: str) -> str:
    return f"concat('LINE', lpad(CAST({n} % 10 + 1 AS STRING), 2, '0'))"


def _kind(n: str) -> str:
    return (
        f"CASE {n} % 5 WHEN 0 THEN 'CNC' WHEN 1 THEN 'AOI' WHEN 2 THEN 'ROBOT' WHEN 3 THEN 'PRESS' ELSE 'CONVEYOR' END"
    )


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "sensor_events": (("events",), f"""
        SELECT event_id, {_equipment('user_id')} AS equipment_id, {_line('user_id')} AS line_id,
               {_kind('user_id')} AS equipment_type, ts AS event_time, value AS temperature_c,
               {_K} / 10 AS vibration_ms2, (event_id % 280) / 10 - 1 AS pressure_bar,
               CAST((event_id * 37) % 3200 AS DOUBLE) AS rpm, {_K} / 95 AS quality_score,
               CASE WHEN hour(ts) < 8 THEN 'DAY' WHEN hour(ts) < 16 THEN 'EVENING' ELSE 'NIGHT' END AS shift
        FROM events"""),
    "equipment_master": (("supplier",), f"""
        SELECT {_equipment('s_suppkey')} AS equipment_id, {_kind('s_suppkey')} AS equipment_type,
               {_line('s_suppkey')} AS line_id, CAST(min(80 + s_suppkey % 41) AS BIGINT) AS rated_capacity
        FROM supplier GROUP BY 1, 2, 3"""),
    "production_logs": (("lineitem",), f"""
        SELECT concat_ws('_', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                         CAST(l_suppkey AS STRING)) AS log_id,
               {_equipment('l_suppkey')} AS equipment_id, {_line('l_suppkey')} AS line_id,
               CASE l_linenumber % 3 WHEN 0 THEN 'DAY' WHEN 1 THEN 'EVENING' ELSE 'NIGHT' END AS shift,
               CAST(l_quantity + 10 AS BIGINT) AS planned_qty, CAST(l_quantity AS BIGINT) AS actual_qty,
               CAST(round(l_tax * 100) AS BIGINT) AS defect_qty, CAST(round(l_discount * 100) * 6 AS BIGINT) AS downtime_min,
               CAST(l_shipdate AS DATE) AS production_date
        FROM lineitem"""),
    "quality_inspections": (("lineitem",), f"""
        SELECT concat_ws('_', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING),
                         CAST(l_suppkey AS STRING)) AS inspection_id,
               {_equipment('l_suppkey')} AS equipment_id, {_line('l_suppkey')} AS line_id,
               l_shipdate + l_linenumber * INTERVAL '1' DAY AS inspection_time,
               CASE WHEN l_returnflag = 'R' THEN CASE l_partkey % 4 WHEN 0 THEN 'SCRATCH' WHEN 1 THEN 'DIMENSION'
                    WHEN 2 THEN 'ASSEMBLY' ELSE 'MATERIAL' END END AS defect_type,
               CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_quantity < 17 THEN 'LOW' WHEN l_quantity < 34 THEN 'MEDIUM'
                    ELSE 'HIGH' END END AS severity,
               l_returnflag <> 'R' AS passed
        FROM lineitem"""),
    "maintenance_records": (("orders",), f"""
        SELECT o_orderkey AS maintenance_id, {_equipment('o_custkey')} AS equipment_id, {_line('o_custkey')} AS line_id,
               CAST(o_orderdate AS DATE) AS maintenance_date, o_orderpriority AS failure_type,
               o_totalprice / 100 AS cost_usd
        FROM orders"""),
    "maintenance_clean": (("part",), f"""
        SELECT p_partkey AS maintenance_id, {_equipment('p_partkey')} AS equipment_id,
               {_kind('p_partkey')} AS equipment_type,
               concat({_equipment('p_partkey')}, ' ', CASE p_partkey % 5 WHEN 0 THEN 'breaker tripped, fuse and relay tested'
                      WHEN 1 THEN 'bearing worn, belt replaced' WHEN 2 THEN 'oil leak cleaned at seal'
                      WHEN 3 THEN 'controller error, sensor reset' ELSE 'scheduled inspection and greasing' END,
                      '. part: ', p_name, ', minutes: ', CAST(p_size AS STRING), ', technician: T',
                      CAST(p_partkey % 7 AS STRING)) AS work_description,
               CASE p_partkey % 5 WHEN 0 THEN 'electrical' WHEN 1 THEN 'mechanical' WHEN 2 THEN 'contamination'
                    WHEN 3 THEN 'control' ELSE 'preventive' END AS failure_category
        FROM part"""),
    "audit_log": (("events",), """
        SELECT event_id, ts AS event_time, CAST(ts AS DATE) AS event_date,
               concat('user', CAST(user_id AS STRING), '@plant') AS user_email,
               CASE event_type WHEN 'view' THEN 'getTable' WHEN 'purchase' THEN 'updateTable'
                    WHEN 'signup' THEN 'deleteTable' ELSE 'executeQuery' END AS action_name,
               concat('ml.t', CAST(user_id % 4 AS STRING)) AS table_name,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status
        FROM events"""),
    "predictions": (("labels",), """
        SELECT doc_id, quality AS y, ((doc_id * 7919) % 1000) / 1000 AS champ,
               CAST(0.6 AS DOUBLE) * quality + CAST(0.4 AS DOUBLE) * (((doc_id * 7919) % 1000) / 1000) AS chall
        FROM labels"""),
    "inference_log": (("events",), """
        SELECT event_id, ts AS requested_at, value AS execution_duration_ms,
               CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code
        FROM events"""),
    "runs": (("part",), """
        SELECT p_partkey AS run_id, CAST(0.5 AS DOUBLE) + ((p_partkey * 7919) % 5000) / 10000 AS test_auc FROM part"""),
    "versions": (("part",), """
        SELECT p_partkey AS run_id, p_size AS version FROM part WHERE p_type = 'PROMO'"""),
}

_CLEAN_FILTER = (
    "temperature_c BETWEEN 10 AND 150 AND vibration_ms2 >= 0 AND pressure_bar >= 0 AND rpm >= 0 "
    "AND quality_score BETWEEN 0 AND 1"
)

# Views that only the DuckDB side reads: on the Spark side operators produce them.
DERIVED_SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "sensor_silver": (("sensor_events",), f"SELECT * FROM sensor_events WHERE {_CLEAN_FILTER}"),
    "sensor_clean": (("sensor_silver",), """
        SELECT *, abs(temp_zscore) > 3 AS is_anomaly FROM (
            SELECT *, (temperature_c - avg(temperature_c) OVER (PARTITION BY equipment_id))
                      / nullif(stddev_samp(temperature_c) OVER (PARTITION BY equipment_id), 0) AS temp_zscore
            FROM sensor_silver)"""),
}


def view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A plant-shaped view as a DataFrame over the tables in `root`."""
    tables, text = VIEWS[name]
    for table in tables:
        text = text.replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(text, **{table: read_table(spark, root, table) for table in tables})


def with_views(names: list[str], body: str, extra: dict[str, tuple[tuple[str, ...], str]] | None = None) -> str:
    """Query text for DuckDB with the named views, and all they read, in front as CTEs."""
    known = {**VIEWS, **DERIVED_SQL, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in known and name not in order:
            for parent in known[name][0]:
                visit(parent)
            order.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{n} AS ({known[n][1]})" for n in order)
    if not ctes:
        return body
    more = body.strip()
    return f"WITH {ctes},\n{more[5:]}" if more.startswith("WITH ") else f"WITH {ctes}\n{body}"
