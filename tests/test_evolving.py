import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from plantmetrics.plans import medallion
from plantmetrics.streaming import evolving as E

READINGS = "equipment_id string, line_id string, event_date date, event_time timestamp_ntz, temperature_c double, vibration_ms2 double"


def test_columns_that_come_later_widen_the_schema_and_the_stream_goes_on(spark, tmp_path):
    source, out, mark, log = (f"{tmp_path}/{n}" for n in ("in", "out", "mark", "log"))
    deliveries = [
        spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2, 2.5, "b")], "k int, w double, v string"),
        spark.createDataFrame([(3, "c")], "k int, v string"), spark.createDataFrame([(4, True)], "k int, x boolean"),
    ]
    for df in deliveries:
        df.write.mode("append").parquet(source)
        E.ingest_evolving(spark, source, out, mark, log).awaitTermination()
    E.ingest_evolving(spark, source, out, mark, log).awaitTermination()
    got = E.read_evolved(spark, out, log)
    assert sorted(tuple(r) for r in got.select("k", "v", "w", "x").collect()) == [(1, "a", None, None), (2, "b", 2.5, None), (3, "c", None, None), (4, None, None, True)]
    assert [v.names for v in E.schema_versions(spark, log)] == [["k", "v"], ["k", "v", "w"], ["k", "v", "w", "x"]]


def test_a_column_of_another_type_is_an_error(spark, tmp_path):
    source, log = f"{tmp_path}/in", f"{tmp_path}/log"
    spark.range(1).write.parquet(source)
    E.evolve(spark, source, log)
    spark.createDataFrame([("x",)], "id string").write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError, match="id was bigint and comes as string"):
        E.evolve(spark, f"{tmp_path}/other", log)


def readings(n, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        at = datetime(2024, 1, 1) + timedelta(hours=r.randint(0, 100))
        rows.append((f"E{r.randint(1, 4)}", r.choice(["L1", None]), r.choice([at.date(), at.date(), None]), at, r.choice([None, 1.5, 2.0, 7.25]), r.random()))
    return rows


def view_of(df):
    return sorted((str(r.equipment_id), str(r.line_id), str(r.event_date), str(r.avg_temperature_c), r.max_vibration_ms2, r.event_count) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_into_batches_with_repeats_gives_the_full_view(spark, tmp_path, seed):
    rows = readings(200, seed)
    r = random.Random(seed)
    cut = [[] for _ in range(4)]
    for row in rows:
        r.choice(cut).append(row)
    state, out = f"{tmp_path}/state", f"{tmp_path}/view"
    for batch in (0, 1, 1, 2, 0, 3):
        E.merge_batch(spark.createDataFrame(cut[batch], READINGS), batch, state, out, "event_date", medallion.daily_partials, medallion.daily_view)
    E.merge_batch(spark.createDataFrame([], READINGS), 9, state, out, "event_date", medallion.daily_partials, medallion.daily_view)
    full = medallion.sensor_daily(spark.createDataFrame(rows, READINGS))
    assert view_of(spark.read.parquet(out)) == view_of(full)


def test_a_batch_writes_its_own_days_only(spark, tmp_path):
    import os

    state, out = f"{tmp_path}/state", f"{tmp_path}/view"
    row = lambda d: ("E1", "L1", date(2024, 1, d), datetime(2024, 1, d), 1.0, 1.0)
    merge = lambda rows, n: E.merge_batch(spark.createDataFrame(rows, READINGS), n, state, out, "event_date", medallion.daily_partials, medallion.daily_view)
    merge([row(1), row(2)], 0)
    before = set(os.listdir(f"{out}/event_date=2024-01-01"))
    merge([row(2), row(3)], 1)
    assert set(os.listdir(f"{out}/event_date=2024-01-01")) == before
    assert {str(r.event_date): r.event_count for r in spark.read.parquet(out).collect()} == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1}


def test_a_stream_keeps_the_view_up_to_date(spark, tmp_path):
    rows = readings(120, 5)
    state, out, mark, source = (f"{tmp_path}/{n}" for n in ("state", "view", "mark", "in"))
    for part in (rows[:50], rows[50:]):
        spark.createDataFrame(part, READINGS).write.mode("append").parquet(source)
        stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 3).parquet(source)
        E.view_stream(stream, state, out, mark, "event_date", medallion.daily_partials, medallion.daily_view).awaitTermination()
    assert view_of(spark.read.parquet(out)) == view_of(medallion.sensor_daily(spark.createDataFrame(rows, READINGS)))


def test_whole_number_keys_are_not_summed(spark):
    df = spark.createDataFrame([(7, datetime(2024, 1, 1), 1.0), (7, datetime(2024, 1, 2), 3.0)], "k long, event_time timestamp_ntz, x double")
    rolled = medallion.rolled_up(medallion.hourly_partials(df, ["k"], means=["x"]), ["k"])
    assert rolled.columns.count("k") == 1 and rolled.first().k == 7


def test_distinct_values_of_any_window_come_from_day_sketches(spark, tmp_path):
    rows = spark.range(60_000).select((F.col("id") % 7000).alias("who"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 30 AS INT))").alias("at"))
    E.day_sketches(rows, "at", "who").write.parquet(f"{tmp_path}/sketches")
    sketches = spark.read.parquet(f"{tmp_path}/sketches")
    assert sketches.count() == 30
    for first, last in (("2024-01-01", "2024-01-30"), ("2024-01-05", "2024-01-06"), ("2024-01-30", "2024-01-30")):
        exact = rows.filter(F.to_date("at").between(first, last)).select("who").distinct().count()
        assert abs(E.distinct_in(sketches, first, last).first().estimate - exact) <= 0.04 * exact
    assert E.distinct_in(sketches, "2030-01-01", "2030-01-02").first().estimate == 0
