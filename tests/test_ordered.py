import math
import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantmetrics.operators import ordered

T0 = datetime(2024, 1, 1)


def readings(spark, n=400, keys=("a", "b"), hot=0.8, seed=1, step=37):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = keys[0] if rng.random() < hot else rng.choice(keys[1:])
        value = None if rng.random() < 0.05 else round(rng.gauss(50, 9), 2)
        rows.append((i, key, T0 + timedelta(seconds=rng.randrange(n * step)), value))
    return spark.createDataFrame(rows, "id long, key string, ts timestamp_ntz, v double")


@pytest.mark.parametrize("chunk_rows,bucket_seconds", [(7, 60), (40, 60), (1000, 60), (13, 4000)])
def test_rolling_equals_plain_row_frames(spark, chunk_rows, bucket_seconds):
    df = readings(spark)
    got = ordered.rolling(
        df, "key", "ts",
        {"a5": ("avg", "v", 5), "s5": ("std", "v", 5), "m7": ("max", "v", 7), "c7": ("sum", (F.col("v") > 55).cast("int"), 7)},
        tie=["id"], chunk_rows=chunk_rows, bucket_seconds=bucket_seconds,
    ).toPandas().sort_values("id").reset_index(drop=True)
    w = Window.partitionBy("key").orderBy("ts", "id")
    want = df.select(
        "id", F.avg("v").over(w.rowsBetween(-4, 0)).alias("a5"), F.stddev("v").over(w.rowsBetween(-4, 0)).alias("s5"),
        F.max("v").over(w.rowsBetween(-6, 0)).alias("m7"),
        F.sum((F.col("v") > 55).cast("int")).over(w.rowsBetween(-6, 0)).alias("c7"),
    ).toPandas().sort_values("id").reset_index(drop=True)
    assert len(got) == len(want) == 400
    for c in ("a5", "s5", "m7", "c7"):
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9)


def test_rolling_splits_a_hot_bucket(spark):
    df = readings(spark, n=300).withColumn("ts", F.when(F.col("id") % 2 == 0, F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    frames = {"a": ("avg", "v", 6), "m": ("max", "v", 11), "n": ("sum", F.lit(1), 11)}
    got = ordered.rolling(df, "key", "ts", frames, ["id"], chunk_rows=20, hot_rows=25)
    w = Window.partitionBy("key").orderBy("ts", "id")
    want = df.select(
        "id", F.avg("v").over(w.rowsBetween(-5, 0)).alias("a"), F.max("v").over(w.rowsBetween(-10, 0)).alias("m"),
        F.sum(F.lit(1)).over(w.rowsBetween(-10, 0)).alias("n"),
    )
    got, want = (x.select("id", "a", "m", "n").orderBy("id").toPandas().astype(float) for x in (got, want))
    np.testing.assert_allclose(got, want, atol=1e-9)
    chunked = ordered.in_chunks(df, "key", ["ts", "id"], 10, 20, hot_rows=25)
    assert chunked.groupBy("key", "_chunk").count().agg(F.max("count")).first()[0] <= 20 + 25 + 2 * 10


def test_rolling_without_tie_handles_copies(spark):
    df = spark.range(90).select(F.lit("k").alias("key"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ts"), F.lit(2.0).alias("v"))
    got = ordered.rolling(df, "key", "ts", {"n": ("sum", F.lit(1), 7)}, chunk_rows=10, hot_rows=10)
    assert got.columns == ["key", "ts", "v", "n"]
    assert sorted(r.n for r in got.collect()) == [1, 2, 3, 4, 5, 6] + [7] * 84


def test_as_of_join_with_a_hot_time(spark):
    right = readings(spark, n=200, seed=2).dropDuplicates(["key", "ts"])
    left = readings(spark, n=150, seed=3).select("key", "ts", F.col("id").alias("row"))
    left = left.withColumn("ts", F.when(F.col("row") % 2 == 0, F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    plain = ordered.as_of_join(left, right, "key", "ts", ["id", "v"])
    split = ordered.as_of_join(left, right, "key", "ts", ["id", "v"], whole_rows=10, hot_rows=20)
    assert plain.exceptAll(split).count() == 0 and split.count() == 150


def test_rolling_constant_series_has_zero_spread(spark):
    df = spark.range(50).select(
        F.col("id"), F.lit("k").alias("key"), F.timestamp_seconds(F.col("id") * 10).alias("ts"), F.lit(0.1).alias("v")
    )
    got = ordered.rolling(df, "key", "ts", {"s": ("std", "v", 9)}, tie=["id"], chunk_rows=11)
    values = [r.s for r in got.orderBy("id").collect()]
    assert values[0] is None and max(values[1:]) < 1e-7


def test_rolling_has_one_wide_shuffle(spark):
    df = readings(spark)
    plan = ordered.rolling(df, "key", "ts", {"a": ("avg", "v", 5), "m": ("max", "v", 5)}, tie=["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(key") == 1
    assert "SinglePartition" not in text


def test_forward_max_equals_range_frame(spark):
    df = readings(spark, n=300, step=11)
    w = Window.partitionBy("key").orderBy(F.unix_seconds(F.col("ts").cast("timestamp"))).rangeBetween(0, 200)
    both = ordered.forward_max(df, "key", "ts", F.col("v"), 200, "got").withColumn("want", F.max("v").over(w))
    assert both.filter(~F.col("got").eqNullSafe(F.col("want"))).count() == 0
    assert both.count() == 300


@pytest.mark.parametrize("whole_rows", [100_000, 150, 0])
def test_as_of_join_equals_merge_asof(spark, whole_rows):
    right = readings(spark, n=200, seed=2).dropDuplicates(["key", "ts"])
    left = readings(spark, n=150, keys=("a", "b", "c"), seed=3).select("key", "ts", F.col("id").alias("row"))
    got = ordered.as_of_join(left, right, "key", "ts", ["id", "v"], whole_rows=whole_rows).toPandas().sort_values("row").reset_index(drop=True)
    want = pd.merge_asof(
        left.toPandas().sort_values("ts"), right.toPandas().sort_values("ts"), on="ts", by="key"
    ).sort_values("row").reset_index(drop=True)
    assert len(got) == 150
    pd.testing.assert_series_equal(got["id"].astype(float), want["id"].astype(float))


def test_global_prefix_counts_earlier_rows(spark):
    df = spark.range(1000).select(F.pmod(F.col("id") * 7919, F.lit(1009)).alias("v"))
    ranks = ordered.global_prefix(df, ["v"], partitions=5).orderBy("v").collect()
    assert [r.before for r in ranks] == list(range(1000))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=501), np.round(rng.exponential(size=300), 1)
    df = spark.createDataFrame([("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("b", None)], "g string, v double")
    probs = [i / 10 for i in range(11)]
    got = {r.g: r.quantiles for r in ordered.exact_quantiles(df, "g", "v", probs).collect()}
    np.testing.assert_allclose(got["a"], np.percentile(a, np.array(probs) * 100), atol=1e-12)
    np.testing.assert_allclose(got["b"], np.percentile(b, np.array(probs) * 100), atol=1e-12)


def test_rank_cuts_with_one_hot_timestamp(spark):
    rows = [(i, T0 if i % 3 else T0 + timedelta(seconds=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz")
    cuts = ordered.rank_cuts(df, ["ts", "id"], [0.6, 0.8], F.date_trunc("minute", "ts")).first()
    ordered_rows = sorted((ts, i) for i, ts in rows)
    assert tuple(cuts.cut_0) == ordered_rows[59] and tuple(cuts.cut_1) == ordered_rows[79]


def test_latest_and_dedup_keep_one_row_per_key(spark):
    rows = [("a", T0, 1), ("a", T0 + timedelta(1), 2), ("a", T0 + timedelta(1), 3), ("b", T0, 4), (None, T0, 5)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, id int")
    assert sorted(r.id for r in ordered.latest_per_key(df, ["key"], "ts", ["id"]).collect()) == [3, 4, 5]
    kept = ordered.dedup(df, ["key", "ts"], ["id"])
    assert sorted(r.id for r in kept.collect()) == [1, 2, 4, 5]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_empty_input(spark):
    df = readings(spark, n=5).filter("id < 0")
    assert ordered.rolling(df, "key", "ts", {"a": ("avg", "v", 3)}).count() == 0
    assert ordered.forward_max(df, "key", "ts", F.col("v"), 10, "m").count() == 0
    assert ordered.as_of_join(df.select("key", "ts", "id"), df, "key", "ts", ["v"]).count() == 0
    assert math.isclose(ordered.exact_quantiles(df, "key", "v", [0.5]).count(), 0)


@pytest.mark.parametrize("odd", [1e9, -1e12, float("inf")])
@pytest.mark.parametrize("chunk_rows", [None, 40, 97])
def test_rolling_frames_hold_only_their_own_rows(spark, odd, chunk_rows):
    """A spike or an infinity shows in the frames that contain it and in no other, however the key is cut."""
    values = [float(20 + (k * 7919) % 13) for k in range(400)]
    values[150], values[151] = odd, None
    rows = [("a", k, k, v) for k, v in enumerate(values)] + [("b", k, k, 5.0) for k in range(60)]
    df = spark.createDataFrame(rows, "key string, sec long, id long, v double").withColumn("ts", F.timestamp_seconds("sec"))
    frames = {"mean": ("avg", "v", 36), "dev": ("std", "v", 36), "top": ("max", "v", 23), "total": ("sum", "v", 7)}
    got = ordered.rolling(df, "key", "ts", frames, ["id"], chunk_rows=chunk_rows, bucket_seconds=10)
    w = lambda n: Window.partitionBy("key").orderBy("ts", "id").rowsBetween(1 - n, 0)
    want = df.withColumns({
        "mean": F.avg("v").over(w(36)), "dev": F.stddev_samp("v").over(w(36)), "top": F.max("v").over(w(23)), "total": F.sum("v").over(w(7))
    })
    a, b = ({(r.key, r.id): r for r in x.collect()} for x in (got, want))
    assert a.keys() == b.keys()
    for at in a:
        for name in frames:
            if b[at][name] is None:
                assert a[at][name] is None, (at, name)
            else:
                assert a[at][name] == pytest.approx(b[at][name], rel=1e-9, abs=1e-9, nan_ok=True), (at, name)


@pytest.mark.parametrize("limits", [{}, {"whole_rows": 5}, {"whole_rows": 5, "hot_rows": 5}])
def test_as_of_ties_do_not_depend_on_size(spark, limits):
    left = spark.createDataFrame([("a", k, k) for k in range(40)], "key string, sec long, id int").withColumn("ts", F.timestamp_seconds("sec"))
    right = spark.createDataFrame([("a", k, x, 9 - x) for k in range(0, 40, 2) for x in (1, 9, 4)], "key string, sec long, x int, rank int").withColumn("ts", F.timestamp_seconds("sec"))
    found = ordered.as_of_join(left, right, "key", "ts", ["x"], tie=["rank"], **limits).collect()
    assert len(found) == 40 and {r.x for r in found} == {1}
    found = ordered.as_of_join(left, right, "key", "ts", ["x"], **limits).collect()
    assert len(found) == 40 and {r.x for r in found} == {9}


@pytest.mark.parametrize("n,accuracy", [(1, 10_000), (2, 10_000), (11, 10_000), (997, 10_000), (5000, 100), (5000, 40)])
def test_bracketed_quantiles_are_exact(spark, n, accuracy):
    rng = np.random.default_rng(n)
    groups = {"a": rng.normal(size=n), "b": np.round(rng.exponential(size=n) * 3), None: rng.integers(0, 2, n).astype(float)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("a", None)]
    probs = [i / 10 for i in range(11)] + [0.123, 0.999]
    got = ordered.bracketed_quantiles(spark.createDataFrame(rows, "g string, v double").repartition(6), "g", "v", probs, accuracy)
    found = {r.g: (r.n, r.quantiles) for r in got.collect()}
    assert found.keys() == groups.keys()
    for g, values in groups.items():
        assert found[g][0] == n and np.allclose(found[g][1], np.quantile(values, probs), rtol=1e-12, atol=1e-12)


def test_bracketed_quantiles_rank_few_values_and_store_none(spark, tmp_path):
    spark.range(200_000).selectExpr("'x' AS g", "CAST(hash(id) AS DOUBLE) AS v").write.parquet(f"{tmp_path}/v")
    made = ordered.bracketed_quantiles(spark.read.parquet(f"{tmp_path}/v"), "g", "v", [0.1, 0.5, 0.9])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "ranges" not in plan  # Values are neither sorted as a whole nor stored.
    assert made.count() == 1


def test_bracketed_quantiles_evaluate_their_sketch_once(spark):
    # Which brackets a sketch gives depends on the order its parts arrive in, so both uses have to read one stored result.
    df = spark.range(0, 20_000, 1, 4).selectExpr("'x' AS g", "CAST(hash(id) AS DOUBLE) AS v")
    made = ordered.bracketed_quantiles(df, "g", "v", [0.1, 0.5, 0.9])
    assert "percentile_approx" not in made._jdf.queryExecution().executedPlan().toString()


def test_rolling_sorts_a_chunk_once(spark):
    frames = {"a": ("avg", "v", 360), "s": ("std", "v", 1440), "m": ("max", "v", 8640)}
    plan = ordered.rolling(readings(spark), "key", "ts", frames, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1 and plan.count("Exchange hashpartitioning") == 1
