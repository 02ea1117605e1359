from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.operators import features, models

T0 = datetime(2024, 1, 1)


def sensors(spark, n=600, equipments=3, seed=7):
    rng = np.random.default_rng(seed)
    rows = [
        (i, f"EQ00{1 + (i % equipments if i % 4 else 0)}", T0 + timedelta(minutes=7 * i), float(round(rng.normal(60, 15), 2)),
         float(round(rng.exponential(3), 1)), float(round(rng.uniform(0, 20), 1)), float(rng.integers(0, 3000)),
         float(round(rng.uniform(), 2)))
        for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "event_id long, equipment_id string, event_time timestamp_ntz, temperature_c double, vibration_ms2 double, "
              "pressure_bar double, rpm double, quality_score double"
    )


def test_rolling_features_across_chunks_equal_plain_frames(spark, monkeypatch):
    monkeypatch.setattr(features, "HOUR_ROWS", 9)
    monkeypatch.setattr(features, "FOUR_HOUR_ROWS", 23)
    monkeypatch.setattr(features, "DAY_ROWS", 61)
    df = sensors(spark)
    got = features.rolling_features(df, ["event_id"], chunk_rows=80).orderBy("event_id").toPandas()
    w = Window.partitionBy("equipment_id").orderBy("event_time", "event_id")
    odd = F.when((F.col("temperature_c") > 90) | (F.col("vibration_ms2") > 6.0), 1)
    want = df.select(
        "event_id", F.stddev("rpm").over(w.rowsBetween(-8, 0)).alias("rpm_std_1h"),
        F.avg("vibration_ms2").over(w.rowsBetween(-60, 0)).alias("vib_avg_24h"),
        F.max("pressure_bar").over(w.rowsBetween(-8, 0)).alias("pressure_max_1h"),
        F.count(odd).over(w.rowsBetween(-22, 0)).alias("anomaly_count_4h"),
        (F.avg("temperature_c").over(w.rowsBetween(-8, 0)) - F.avg("temperature_c").over(w.rowsBetween(-22, 0))).alias("temp_trend_4h"),
    ).orderBy("event_id").toPandas()
    for c in want.columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9, err_msg=c)
    assert len([c for c in got.columns if c not in df.columns]) == 19


def test_labels_look_forward_only(spark):
    rows = [("a", T0 + timedelta(hours=h), s) for h, s in [(0, 0.0), (10, 0.0), (60, 0.5), (109, 0.0), (200, None)]]
    df = spark.createDataFrame(rows, "equipment_id string, event_time timestamp_ntz, composite_anomaly_score double")
    got = [r.failure_within_48h for r in features.failure_labels(df).orderBy("event_time").collect()]
    assert got == [0, 0, 1, 0, None]
    near = [r.failure_within_48h for r in features.failure_labels(df, hours=50).orderBy("event_time").collect()]
    assert near == [0, 1, 1, 0, None]


def test_training_set_never_uses_a_later_feature(spark):
    right = spark.createDataFrame([("a", T0 + timedelta(hours=h), float(h)) for h in (1, 5, 9)], "equipment_id string, event_time timestamp_ntz, f double")
    left = spark.createDataFrame([("a", T0 + timedelta(hours=h), h) for h in (0, 1, 4, 9, 30)] + [("b", T0, 99)], "equipment_id string, event_time timestamp_ntz, y int")
    got = {r.y: r.f for r in features.training_set(left, right, ["f"]).collect()}
    assert got == {0: None, 1: 1.0, 4: 1.0, 9: 9.0, 30: 9.0, 99: None}


def test_splits_are_complete_disjoint_and_exact(spark):
    df = sensors(spark, 503).withColumn("y", (F.col("event_id") % 7 == 0).cast("int"))
    parts = features.time_split(df, "event_time", ["event_id"])
    sizes = {r.part: r["count"] for r in parts.groupBy("part").count().collect()}
    assert sizes == {"train": int(503 * 0.6), "val": int(503 * 0.8) - int(503 * 0.6), "test": 503 - int(503 * 0.8)}
    edge = {r.part: (r.lo, r.hi) for r in parts.groupBy("part").agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).collect()}
    assert edge["train"][1] < edge["val"][0] and edge["val"][1] < edge["test"][0]
    strat = features.stratified_split(df, "y", ["event_id"])
    per = {(r.y, r.part): r["count"] for r in strat.groupBy("y", "part").count().collect()}
    for y, n in ((0, 431), (1, 72)):
        assert per[y, "train"] == int(n * 0.6) and per[y, "train"] + per[y, "val"] == int(n * 0.8)
    again = features.stratified_split(df, "y", ["event_id"])
    assert strat.select("event_id", "part").exceptAll(again.select("event_id", "part")).count() == 0


def test_time_split_of_few_rows(spark):
    one = sensors(spark, 1)
    assert [r.part for r in features.time_split(one, "event_time", ["event_id"]).collect()] == ["test"]


def test_time_split_does_not_shuffle_the_rows(spark):
    plan = features.time_split(sensors(spark, 50), "event_time", ["event_id"])._jdf.queryExecution().executedPlan().toString()
    body = "\n".join(line for line in plan.splitlines() if not line.lstrip().startswith(":"))
    assert "Exchange" not in body.split("== Subqueries")[0].split("Subquery")[0]


def test_class_weight_without_positives_is_one(spark):
    df = spark.createDataFrame([(0,), (0,), (1,)], "y int")
    assert features.class_weight(df, "y").first().scale_pos_weight == 2.0
    assert features.class_weight(df.filter("y = 0"), "y").first().scale_pos_weight == 1.0
    assert {r.y: round(r.share, 4) for r in features.label_distribution(df, "y").collect()} == {0: 0.6667, 1: 0.3333}


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return float(np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]))


def test_metrics_match_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 300)
    s = np.round(np.clip(0.3 * y + rng.uniform(size=300) * 0.7, 0, 1), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    got = models.classification_metrics(df, "y", "s", 0.4).first()
    called = s >= 0.4
    assert got.auc == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert got.recall == pytest.approx((called & (y == 1)).sum() / y.sum())
    assert got.precision == pytest.approx((called & (y == 1)).sum() / called.sum())


def test_promotion_needs_every_floor(spark):
    rows = [(1, 0.5, 0.9), (0, 0.5, 0.1), (1, 0.6, 0.8), (0, 0.4, 0.2)]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    assert models.promotion_verdict(df, "y", "a", "b").first().verdict == "promote"
    assert models.promotion_verdict(df, "y", "b", "b").first().verdict == "keep champion"


def test_psi_is_zero_on_itself_and_matches_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400), rng.normal(0.5, 1.2, size=300)
    left = spark.createDataFrame([(float(x),) for x in a], "x double")
    right = spark.createDataFrame([(float(x),) for x in b], "x double")
    assert abs(models.psi_report(left, left, ["x"]).first().psi) < 1e-12
    edges = np.percentile(a, np.linspace(0, 100, 11))
    open_edges = np.concatenate([[-np.inf], edges[1:-1], [np.inf]])
    r = np.histogram(a, open_edges)[0] / 400 + 1e-10
    c = np.histogram(b, open_edges)[0] / 300 + 1e-10
    assert models.psi_report(left, right, ["x"]).first().psi == pytest.approx(float(np.sum((c - r) * np.log(c / r))), rel=1e-9)
    edges[0] -= 1e-6
    edges[-1] += 1e-6
    r = np.histogram(a, edges)[0] / 400
    c = np.histogram(b, edges)[0] / 300
    r, c = np.where(r == 0, 1e-6, r), np.where(c == 0, 1e-6, c)
    closed = models.psi_report(left, right, ["x"], closed=True).first()
    assert closed.psi == pytest.approx(float(np.sum((c - r) * np.log(c / r))), rel=1e-9)
    few = models.psi_report(left.limit(50), right, ["x"], closed=True).first()
    assert few.psi is None and few.status == "too few rows"


def test_model_learns_a_separable_target(spark):
    df = sensors(spark, 400).withColumn("y", (F.col("temperature_c") > 70).cast("int"))
    columns = ["temperature_c", "vibration_ms2"]
    model = models.train_failure_model(df, "y", columns, trees=5, depth=3)
    scored = models.score(model, df, columns)
    assert models.classification_metrics(scored, "y", "failure_probability").first().auc > 0.95
    tiers = models.with_risk(scored, "failure_probability")
    assert set(r.risk_level for r in tiers.select("risk_level").distinct().collect()) <= {"HIGH", "MEDIUM", "LOW"}


def test_risk_bounds(spark):
    df = spark.createDataFrame([(0.7,), (0.4,), (0.39,)], "p double")
    assert [r.risk_level for r in models.with_risk(df, "p").collect()] == ["HIGH", "MEDIUM", "LOW"]


def test_best_run_needs_a_version(spark):
    runs = spark.createDataFrame([(1, 0.9), (2, 0.95), (3, 0.95)], "run_id int, test_auc double")
    versions = spark.createDataFrame([(1, 1), (3, 2)], "run_id int, version int")
    assert models.best_registered_run(runs, versions).first().run_id == 3


def test_training_set_works_out_its_features_once(spark, monkeypatch):
    from plantmetrics.registry import learning
    from plantmetrics.registry.load import QUERIES

    kept = []
    monkeypatch.setattr(learning, "stored", lambda df, label="side": kept.append(label) or stored(df, label))
    plan = QUERIES["f5_training_set"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "features" in kept and "FlatMapGroups" not in plan  # The join reads its right side more than once.


def test_a_training_set_makes_the_unique_readings_once(spark, monkeypatch):
    from plantmetrics.registry import learning
    from plantmetrics.registry.base import Inputs

    made, unique = [], learning._unique
    monkeypatch.setattr(learning, "_unique", lambda t: made.append(1) or unique(t))
    learning._training(Inputs(spark, "/root/testdata/sf0.001"))
    assert made == [1]
