"""Day filters of the production queries reach the scan, whatever type a table's day column has."""

import datetime as dt
import re

import pytest

from plantmetrics.plans import kpi
from plantmetrics.registry.load import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "day"), [
    ("k2_oee_from_logs", "1998-12-01"), ("k12_panel_trend", "1998-12-01"), ("k12_panel_mean", "1998-12-01"), ("k12_panel_components", "1998-12-01"),
    ("k12_panel_quantity", "1998-12-01"), ("k16_line_mean", "1998-12-24"), ("k17_defect_ranking", "1998-12-24"),
])
def test_registered_days_are_pushed(spark, name, day):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(QUERIES[name](spark, SF)))
    assert any(f"GreaterThanOrEqual(l_shipdate,{day}" in p for p in pushed), pushed


@pytest.mark.parametrize("kind", ["date", "string"])
def test_days_of_either_type_join(spark, kind):
    day = dt.date(2024, 1, 30)
    logs = spark.createDataFrame(
        [("E1", str(day), 100, 90, 10), ("E1", "2023-01-01", 100, 90, 10), ("E2", None, 1, 1, 1)],
        "equipment_id string, production_date string, planned_qty long, actual_qty long, downtime_min long",
    ).selectExpr("equipment_id", f"CAST(production_date AS {kind}) AS production_date", "planned_qty", "actual_qty", "downtime_min")
    seen = spark.createDataFrame(
        [("E1", dt.datetime(2024, 1, 30, 23), True), ("E1", dt.datetime(2024, 1, 30, 1), False), ("E1", None, True)],
        "equipment_id string, inspection_time timestamp, passed boolean",
    )
    (row,) = kpi.oee_from_logs(logs, seen, "2024-01-31").collect()
    assert str(row.production_date) == str(day) and row.quality_pct == 50.0
    assert kpi.oee_from_logs(logs, seen, "2024-01-31").schema["production_date"].dataType.typeName() == kind
