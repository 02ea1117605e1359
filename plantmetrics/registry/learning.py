"""Feature, label, split, model and drift queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.operators import boosted, features, models
from plantmetrics.operators.ordered import dedup
from plantmetrics.registry.base import DERIVED, FEATURES, Inputs, day_text, near, query, sql_near
from plantmetrics.session import scratch_path
from plantmetrics.sources.fixtures import AS_OF

TIE = ["event_id"]
WHOLE = {"anomaly_count_1h", "anomaly_count_4h"}
THRESHOLD = 0.9
RAW = ["temperature_c", "vibration_ms2", "pressure_bar", "rpm", "quality_score"]


def digits(name: str) -> int:
    return 4 if "std" in name else 6


def _unique(t: Inputs) -> DataFrame:
    return dedup(t.silver(), ["equipment_id", "event_time"], TIE)


def _features(t: Inputs, unique: DataFrame | None = None) -> DataFrame:
    return features.rolling_features(_unique(t) if unique is None else unique, TIE)


def _labels(t: Inputs, unique: DataFrame | None = None) -> DataFrame:
    scored = (_unique(t) if unique is None else unique).withColumn("composite_anomaly_score", features.composite_score())
    return features.failure_labels(scored, THRESHOLD)


def _training(t: Inputs) -> DataFrame:
    # Labels and features read the unique readings several times: parsed, filtered and shuffled once.
    unique = stored(_unique(t).select(*TIE, "equipment_id", "event_time", *RAW), "unique")
    made = _features(t, unique).select("equipment_id", "event_time", *features.MODEL_FEATURES)
    return features.training_set(stored(_labels(t, unique), "labels"), stored(made, "features"))


def _shown(names) -> list:
    return [F.col(n).cast("double").alias(n) if n in WHOLE else near(n, digits(n)).alias(n) for n in names]


def _shown_sql(names, prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{n} AS DOUBLE) AS {n}" if n in WHOLE else f"{sql_near(prefix + n, digits(n))} AS {n}" for n in names)


@query("f1_rolling_features", f"SELECT event_id, {_shown_sql(FEATURES)} FROM features", ["features"])
def rolling_features(t: Inputs):
    return _features(t).select("event_id", *_shown(FEATURES))


def _w(n: int) -> str:
    return f"OVER (PARTITION BY equipment_id ORDER BY event_time, event_id ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


SHORT_LONG = ["temp_rolling_avg", "temp_rolling_std", "temp_long_avg", "vibration_rolling_avg", "vibration_rolling_max",
              "temp_vibration_ratio", "temp_deviation"]


@query("f2_sensor_features", f"""
SELECT event_id, {_shown_sql(SHORT_LONG)}, event_hour, is_night_shift FROM (
    SELECT *, temperature_c / greatest(vibration_ms2, CAST(0.01 AS DOUBLE)) AS temp_vibration_ratio,
           temperature_c - temp_long_avg AS temp_deviation FROM (
        SELECT event_id, temperature_c, vibration_ms2, avg(temperature_c) {_w(60)} AS temp_rolling_avg,
               stddev_samp(temperature_c) {_w(60)} AS temp_rolling_std, avg(temperature_c) {_w(360)} AS temp_long_avg,
               avg(vibration_ms2) {_w(60)} AS vibration_rolling_avg, max(vibration_ms2) {_w(360)} AS vibration_rolling_max,
               CAST(hour(event_time) AS INTEGER) AS event_hour,
               CAST(CASE WHEN hour(event_time) >= 22 OR hour(event_time) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS is_night_shift
        FROM sensor_silver))""", ["sensor_silver"])
def sensor_features(t: Inputs):
    made = features.sensor_features(t.silver(), TIE)
    return made.select("event_id", *_shown(SHORT_LONG), "event_hour", "is_night_shift")


@query("f3_failure_labels", "SELECT equipment_id, event_time, CAST(failure_within_48h AS INTEGER) AS failure_within_48h FROM pdm_labels",
       ["pdm_labels"])
def failure_labels(t: Inputs):
    return _labels(t)


UPSERTED = ["temp_avg_1h", "vib_avg_1h", "composite_anomaly_score"]


@query("f4_upsert_features", f"SELECT equipment_id, event_time, {_shown_sql(UPSERTED)} FROM features", ["features"])
def upsert_features(t: Inputs):
    fresh = stored(_features(t).select("equipment_id", "event_time", *UPSERTED), "features")
    stale = fresh.filter("event_time < TIMESTAMP_NTZ '2024-01-16'").withColumn("temp_avg_1h", F.lit(0.0))
    return features.upsert_features(stale, fresh).select("equipment_id", "event_time", *_shown(UPSERTED))


@query("f5_training_set", f"""
SELECT l.equipment_id, l.event_time, CAST(failure_within_48h AS INTEGER) AS failure_within_48h,
       {_shown_sql(features.MODEL_FEATURES, 'f.')}
FROM pdm_labels l ASOF LEFT JOIN features f
ON l.equipment_id = f.equipment_id AND l.event_time >= f.event_time""", ["pdm_labels", "features"])
def training_set(t: Inputs):
    return _training(t).select("equipment_id", "event_time", "failure_within_48h", *_shown(features.MODEL_FEATURES))


@query("f6_time_split", """
SELECT event_id, CASE WHEN rn <= CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT) THEN 'train'
                      WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS part
FROM (SELECT event_id, row_number() OVER (ORDER BY event_time, event_id) AS rn, count(*) OVER () AS n FROM sensor_silver)""",
       ["sensor_silver"])
def time_split(t: Inputs):
    return features.time_split(t.silver(), "event_time", TIE).select("event_id", "part")


@query("f7_stratified_split", """
SELECT doc_id, y, CASE WHEN rn <= CAST(floor(n * CAST(0.6 AS DOUBLE)) AS BIGINT) THEN 'train'
                       WHEN rn <= CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS part
FROM (SELECT doc_id, y, row_number() OVER (PARTITION BY y ORDER BY (doc_id * 7919 + 42) % 1000003, doc_id) AS rn,
             count(*) OVER (PARTITION BY y) AS n FROM predictions)""", ["predictions"])
def stratified_split(t: Inputs):
    spread = (F.col("doc_id") * 7919 + 42) % 1000003
    parts = features.stratified_split(t.view("predictions"), "y", ["doc_id"], spread=spread, spread_bits=20)
    return parts.select("doc_id", "y", "part")


@query("f8_class_weight", f"""
SELECT neg, pos, {sql_near('CAST(pos AS DOUBLE) / (neg + pos)')} AS pos_rate,
       {sql_near('coalesce(CAST(neg AS DOUBLE) / nullif(pos, 0), 1.0)')} AS scale_pos_weight
FROM (SELECT count(*) FILTER (WHERE failure_within_48h = 0) AS neg, count(*) FILTER (WHERE failure_within_48h = 1) AS pos
      FROM pdm_labels)""", ["pdm_labels"])
def class_weight(t: Inputs):
    found = features.class_weight(_labels(t), "failure_within_48h")
    return found.withColumns({c: near(c) for c in ("pos_rate", "scale_pos_weight")})


@query("f9_label_distribution", f"""
SELECT CAST(failure_within_48h AS INTEGER) AS failure_within_48h, count(*) AS row_count,
       {sql_near('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM pdm_labels)')} AS share
FROM pdm_labels GROUP BY 1""", ["pdm_labels"])
def label_distribution(t: Inputs):
    return features.label_distribution(_labels(t), "failure_within_48h").withColumn("share", near("share"))


GAPPED = ["temp_std_1h", "vib_std_1h", "rpm_std_1h"]


@query("f10_impute", "SELECT event_id, " + ", ".join(
    f"{sql_near(f'coalesce({c}, 0)', 4)} AS {c}" for c in GAPPED) + " FROM features", ["features"])
def impute(t: Inputs):
    return features.impute(_features(t), GAPPED).select("event_id", *_shown(GAPPED))


AUC_FLOOR = 0.6  # Above chance; with the 20 positives of the smallest test part an AUC is uncertain by some 0.07.
_SPLIT = ["equipment_id", "event_time"]


def _fitted(t: Inputs, rounds: int = boosted.ROUNDS) -> tuple[DataFrame, boosted.Fit]:
    """The whole training set with its stratified parts, and a model of the train part stopped by the val part."""
    ready = stored(features.stratified_split(_training(t), "failure_within_48h", _SPLIT), "split")
    return ready, boosted.fit_with_patience(ready.filter("part = 'train'"), ready.filter("part = 'val'"), "failure_within_48h", rounds=rounds)


@query("f11_train_and_score", """
SELECT CAST(sum(n - CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT)) AS BIGINT) AS n,
       CAST(sum(failure_within_48h * (n - CAST(floor(n * CAST(0.8 AS DOUBLE)) AS BIGINT))) AS BIGINT) AS positives,
       TRUE AS auc_reached, TRUE AS stopped_in_time, TRUE AS best_is_least
FROM (SELECT CAST(failure_within_48h AS BIGINT) AS failure_within_48h, count(*) AS n FROM pdm_labels GROUP BY 1)""", ["pdm_labels"])
def train_and_score(t: Inputs):
    """Test part of the stratified split, scored by a model that stopped after 30 rounds without gain on the val part."""
    ready, fit = _fitted(t)
    scored = boosted.score_rows(fit.model, ready.filter("part = 'test'"))
    found = models.classification_metrics(scored, "failure_within_48h", "failure_probability")
    in_time = fit.best_round <= len(fit.losses) <= min(fit.best_round + boosted.PATIENCE, boosted.ROUNDS)
    return found.select(
        "n", "positives", (F.col("auc") >= AUC_FLOOR).alias("auc_reached"), F.lit(in_time).alias("stopped_in_time"),
        F.lit(fit.losses[fit.best_round - 1] == min(fit.losses)).alias("best_is_least"),
    )


@query("f17_score", """
SELECT equipment_id, event_time, CAST(failure_within_48h AS INTEGER) AS failure_within_48h, TRUE AS scored, TRUE AS tier_fits FROM pdm_labels""",
       ["pdm_labels"])
def score_all(t: Inputs):
    """Every row of the training set scored by a model that was stored and read back, with its risk tier.

    SQL cannot state the trees: the row's probability is held against 0 and 1, its tier and advice against the probability.
    """
    ready, fit = _fitted(t, 40)
    path = scratch_path(t.spark, "model")
    boosted.save_model(fit.model, t.spark, path)
    scored = boosted.score_rows(boosted.load_model(t.spark, path), ready).withColumn("p", F.col("failure_probability"))
    tiers = models.with_risk(scored, "failure_probability")
    tier = F.concat_ws(" / ", "risk_level", "recommendation")
    fits = F.when(F.col("p") >= 0.7, tier == "HIGH / inspect now").when(F.col("p") >= 0.4, tier == "MEDIUM / inspect within 48 hours")
    return tiers.select(
        "equipment_id", "event_time", "failure_within_48h", F.coalesce((F.col("p") > 0) & (F.col("p") < 1), F.lit(False)).alias("scored"),
        fits.otherwise(tier == "LOW / keep monitoring").alias("tier_fits"),
    )


def _metrics_sql(score: str, threshold: float, table: str = "predictions") -> str:
    return f"""
    SELECT count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
           {sql_near('(sum(CASE WHEN y = 1 THEN mid END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))')} AS auc,
           {sql_near('coalesce(CAST(sum(y * c) AS DOUBLE) / nullif(sum(c), 0), 0)')} AS precision,
           {sql_near('CAST(sum(y * c) AS DOUBLE) / sum(y)')} AS recall,
           {sql_near('CAST(2 * sum(y * c) AS DOUBLE) / (sum(c) + sum(y))')} AS f1
    FROM (SELECT y, CASE WHEN {score} >= {threshold} THEN 1 ELSE 0 END AS c,
                 rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2 AS mid FROM {table})"""


METRICS = ["auc", "precision", "recall", "f1"]


@query("f12_metrics", _metrics_sql("chall", 0.4), ["predictions"])
def metrics(t: Inputs):
    found = models.classification_metrics(t.view("predictions"), "y", "chall", 0.4)
    return found.withColumns({c: near(c) for c in METRICS})


@query("f12_metrics_low_threshold", _metrics_sql("champ", 0.3), ["predictions"])
def metrics_low(t: Inputs):
    found = models.classification_metrics(t.view("predictions"), "y", "champ", 0.3)
    return found.withColumns({c: near(c) for c in METRICS})


@query("f13_promotion", f"""
WITH a AS ({_metrics_sql('champ', 0.4)}), b AS ({_metrics_sql('chall', 0.4)})
SELECT a.auc AS champion_auc, b.auc AS challenger_auc, b.recall AS challenger_recall, round(b.auc - a.auc, 5) AS auc_gain,
       CASE WHEN b.auc >= 0.9 AND b.recall >= 0.8 AND b.auc - a.auc >= 0.01 THEN 'promote' ELSE 'keep champion' END AS verdict
FROM a, b""", ["predictions"])
def promotion(t: Inputs):
    found = models.promotion_verdict(t.view("predictions"), "y", "champ", "chall")
    shown = {c: near(c) for c in ("champion_auc", "challenger_auc", "challenger_recall")}
    return found.withColumns({**shown, "auc_gain": F.round("auc_gain", 5)})


def _long_sql(table: str, columns, where: str, side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, '{side}' AS side FROM {table} WHERE {where} AND {c} IS NOT NULL"
        for c in columns
    )


def _psi_sql(table: str, columns, ref: str, cur: str, closed: bool) -> str:
    probs = ", ".join(str(i / 10) for i in range(11))
    share = "CASE WHEN x = 0 THEN 1e-6 ELSE x END" if closed else "x + 1e-10"
    inside = "AND value BETWEEN q[1] - 1e-6 AND q[11] + 1e-6" if closed else ""
    psi = sql_near("sum((c - r) * ln(c / r))")
    if closed:
        psi = f"CASE WHEN n_ref >= 100 AND n_cur >= 100 THEN {psi} END"
    limit = 0.25 if closed else 0.2
    return f"""
WITH long_rows AS ({_long_sql(table, columns, ref, 'ref')} UNION ALL {_long_sql(table, columns, cur, 'cur')}),
edges AS (SELECT feature, quantile_cont(value, [{probs}]) AS q FROM long_rows WHERE side = 'ref' GROUP BY 1),
sizes AS (SELECT feature, count(*) FILTER (WHERE side = 'ref') AS n_ref, count(*) FILTER (WHERE side = 'cur') AS n_cur
          FROM long_rows GROUP BY 1),
binned AS (SELECT l.feature, side, len(list_filter(q[2:10], lambda e: e <= value)) AS bin FROM long_rows l JOIN edges e
           ON l.feature = e.feature WHERE TRUE {inside}),
cells AS (SELECT s.feature, s.n_ref, s.n_cur, b.bin,
                 (SELECT count(*) FROM binned x WHERE x.feature = s.feature AND x.bin = b.bin AND side = 'ref') / s.n_ref AS ref_share,
                 (SELECT count(*) FROM binned x WHERE x.feature = s.feature AND x.bin = b.bin AND side = 'cur') / s.n_cur AS cur_share
          FROM sizes s CROSS JOIN (SELECT unnest(range(10)) AS bin) b),
shares AS (SELECT feature, n_ref, n_cur, {share.replace('x', 'ref_share')} AS r, {share.replace('x', 'cur_share')} AS c FROM cells),
psis AS (SELECT feature, n_ref, n_cur, {psi} AS psi FROM shares GROUP BY feature, n_ref, n_cur)
SELECT *, CASE WHEN psi IS NULL THEN 'too few rows' WHEN psi < 0.1 THEN 'stable' WHEN psi < {limit} THEN 'warning' ELSE 'drift' END AS status
FROM psis"""


REF = "event_time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-17'"
CUR = "event_time >= TIMESTAMP '2024-01-24'"


@query("f14_psi_closed", _psi_sql("sensor_silver", RAW, REF, CUR, True), ["sensor_silver"])
def psi_closed(t: Inputs):
    reference, current = models.drift_windows(t.silver(), "event_time", AS_OF)
    return models.psi_report(reference, current, RAW, closed=True).withColumn("psi", near("psi"))


@query("f14_psi_open", _psi_sql("sensor_silver", RAW, REF, CUR, False), ["sensor_silver"])
def psi_open(t: Inputs):
    reference, current = models.drift_windows(t.silver(), "event_time", AS_OF)
    return models.psi_report(reference, current, RAW).withColumn("psi", near("psi"))


BEFORE, AFTER = "event_time < TIMESTAMP '2024-01-16'", "event_time >= TIMESTAMP '2024-01-16'"
DERIVED["shown_features"] = (("features",), f"SELECT event_time, {_shown_sql(features.MODEL_FEATURES)} FROM features")


@query("f15_drift_report", _psi_sql("shown_features", features.MODEL_FEATURES, BEFORE, AFTER, False), ["shown_features"])
def drift_report(t: Inputs):
    """On rounded features: a mean that equals a bin edge has to fall on the same side in both engines."""
    made = stored(_features(t).select("event_time", *_shown(features.MODEL_FEATURES)), "features")
    old = made.filter("event_time < TIMESTAMP_NTZ '2024-01-16'")
    new = made.filter("event_time >= TIMESTAMP_NTZ '2024-01-16'")
    return models.psi_report(old, new, features.MODEL_FEATURES).withColumn("psi", near("psi"))


@query("f15_drift_count", f"""
SELECT count(*) FILTER (WHERE status = 'drift') AS drifted,
       CASE WHEN count(*) FILTER (WHERE status = 'drift') > 0 THEN 'retrain' ELSE 'no action' END AS advice
FROM ({_psi_sql("sensor_silver", RAW, REF, CUR, False)})""", ["sensor_silver"])
def drift_count(t: Inputs):
    reference, current = models.drift_windows(t.silver(), "event_time", AS_OF)
    return models.drift_count(models.psi_report(reference, current, RAW))


@query("f16_best_run", """
SELECT r.run_id, test_auc, version FROM runs r JOIN versions v ON r.run_id = v.run_id ORDER BY test_auc DESC, r.run_id LIMIT 1""",
       ["runs", "versions"])
def best_run(t: Inputs):
    return models.best_registered_run(t.view("runs"), t.view("versions"))


@query("f17_risk", """
SELECT doc_id, round(chall, 4) AS failure_probability,
       CASE WHEN chall >= 0.7 THEN 'HIGH' WHEN chall >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       CASE WHEN chall >= 0.7 THEN 'inspect now' WHEN chall >= 0.4 THEN 'inspect within 48 hours' ELSE 'keep monitoring' END AS recommendation
FROM predictions""", ["predictions"])
def risk(t: Inputs):
    tiers = models.with_risk(t.view("predictions"), "chall")
    return tiers.select("doc_id", "failure_probability", "risk_level", "recommendation")


@query("f18_inference_stats", f"""
SELECT CAST(CAST(requested_at AS DATE) AS STRING) AS day, count(*) AS request_count, {sql_near('avg(execution_duration_ms)')} AS avg_latency_ms,
       count(*) FILTER (WHERE status_code <> 200) AS error_count,
       {sql_near('CAST(count(*) FILTER (WHERE status_code <> 200) AS DOUBLE) / count(*)')} AS error_rate,
       CAST(count(*) FILTER (WHERE status_code <> 200) AS DOUBLE) / count(*) > 0.05 AS error_alarm,
       avg(execution_duration_ms) > 500 AS latency_alarm
FROM inference_log WHERE requested_at >= TIMESTAMP '2024-01-24' GROUP BY 1""", ["inference_log"])
def inference_stats(t: Inputs):
    log = t.view("inference_log").withColumn("timestamp_ms", F.unix_millis(F.col("requested_at").cast("timestamp")))
    found = day_text(models.inference_stats(log, AS_OF), "day")
    return found.withColumns({c: near(c) for c in ("avg_latency_ms", "error_rate")})
