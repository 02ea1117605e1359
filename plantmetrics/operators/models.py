"""Training, exact metrics, promotion, drift, run choice, scoring and serving-log reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.expressions import count_where, ratio, tiered
from plantmetrics.functions.sizing import join_back, small_side
from plantmetrics.operators.features import MODEL_FEATURES, assemble, class_weight
from plantmetrics.operators.ordered import bracketed_quantiles, global_prefix

MIN_AUC, MIN_RECALL, MIN_GAIN = 0.90, 0.80, 0.01


def train_failure_model(
    train: DataFrame, label: str, columns: Sequence[str] = MODEL_FEATURES, trees: int = 30, depth: int = 5,
    step: float = 0.1, seed: int = 42, validation: str | None = None,
) -> GBTClassificationModel:
    """Gradient-boosted trees with the positive class weighted by negatives / positives.

    `validation` names a boolean column: its rows teach nothing, boosting stops when they gain no more.
    """
    weight = class_weight(train, label).select("scale_pos_weight").scalar()
    ready = assemble(train, columns).withColumn("_weight", F.when(F.col(label) == 1, weight).otherwise(1.0))
    gbt = GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed
    )
    return (gbt.setValidationIndicatorCol(validation) if validation else gbt).fit(ready)


def score(model: GBTClassificationModel, df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Failure probability per row."""
    scored = model.transform(assemble(df, columns))
    probability = vector_to_array("probability")[1].alias("failure_probability")
    return scored.select(*df.columns, probability)


def with_risk(df: DataFrame, probability: str, medium: float = 0.4, high: float = 0.7) -> DataFrame:
    """Probability rounded to 4 digits with its risk level and advice."""
    p = F.col(probability)
    return df.withColumns({
        "risk_level": tiered(p, [(high, "HIGH"), (medium, "MEDIUM")], "LOW"),
        "recommendation": tiered(
            p, [(high, "inspect now"), (medium, "inspect within 48 hours")], "keep monitoring"
        ),
        "failure_probability": F.round(p, 4),
    })


def classification_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.4, group: str | None = None
) -> DataFrame:
    """AUC (exact, ties by mid-rank), precision, recall and F1 at a threshold, per group.

    Rows are reduced to distinct scores first; ranks come from a distributed prefix count.
    """
    by = group or "_all"
    named = df if group else df.withColumn("_all", F.lit(0))
    counted = named.groupBy(by, F.col(score).alias("_score")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"), F.count("*").alias("_n")
    )
    ranked = global_prefix(counted, ["_score"], F.col("_n"), groups=[by])
    mid = F.col("before") + (F.col("_n") + 1) / 2
    hit = F.col("_score") >= threshold
    sums = ranked.groupBy(by).agg(
        F.sum(F.col("_pos") * mid).alias("rank_sum"), F.sum("_pos").alias("p"), F.sum("_n").alias("n"),
        F.coalesce(F.sum(F.when(hit, F.col("_pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("called"),
    )
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    out = sums.select(
        by, F.col("n"), F.col("p").alias("positives"),
        ratio(F.col("rank_sum") - p * (p + 1) / 2, p * (n - p)).alias("auc"),
        F.coalesce(ratio(F.col("tp"), F.col("called")), F.lit(0.0)).alias("precision"),
        ratio(F.col("tp"), F.col("p")).alias("recall"),
        F.coalesce(ratio(2 * F.col("tp"), F.col("called") + F.col("p")), F.lit(0.0)).alias("f1"),
    )
    return out if group else out.drop("_all")


def promotion_verdict(
    df: DataFrame, label: str, champion: str, challenger: str, threshold: float = 0.4, min_auc: float = MIN_AUC,
    min_recall: float = MIN_RECALL, min_gain: float = MIN_GAIN,
) -> DataFrame:
    """Whether the challenger replaces the champion: AUC, recall and AUC gain all have to reach their floor."""
    long = df.select(
        label, F.inline(F.array(*[
            F.struct(F.lit(role).alias("model"), F.col(c).alias("score"))
            for role, c in (("champion", champion), ("challenger", challenger))
        ]))
    )
    per_model = classification_metrics(long, label, "score", threshold, "model")

    def of(role: str, metric: str) -> Column:
        return F.max(F.when(F.col("model") == role, F.col(metric)))

    one = per_model.agg(
        of("champion", "auc").alias("champion_auc"), of("challenger", "auc").alias("challenger_auc"),
        of("challenger", "recall").alias("challenger_recall"),
    ).withColumn("auc_gain", F.col("challenger_auc") - F.col("champion_auc"))
    good = (
        (F.col("challenger_auc") >= min_auc) & (F.col("challenger_recall") >= min_recall) & (F.col("auc_gain") >= min_gain)
    )
    return one.withColumn("verdict", F.when(good, "promote").otherwise("keep champion"))


def _long(df: DataFrame, columns: Sequence[str], side: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(cells)).filter(F.col("value").isNotNull()).withColumn("side", F.lit(side))


def psi_report(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], closed: bool = False, bins: int = 10,
    warning: float = 0.10, drift: float | None = None, min_rows: int = 100,
) -> DataFrame:
    """Population stability index per feature over percentile bins of the reference, most drifted first.

    Open form: outer bins reach to infinity, 1e-10 is added to every share, drift from 0.20. Closed form: outer edges
    move by 1e-6, empty shares become 1e-6, drift from 0.25, and a side under `min_rows` gives no index. All features
    share one plan; bin edges are exact percentiles, found between the bounds of a sketch.
    """
    limit = drift if drift is not None else (0.25 if closed else 0.20)
    ref = _long(reference, columns, "ref")
    edges = small_side(
        bracketed_quantiles(ref, "feature", "value", [i / bins for i in range(bins + 1)]).select("feature", "quantiles")
    )
    both = join_back(ref.unionByName(_long(current, columns, "cur")), edges, ["feature"], "inner")
    inner = F.slice("quantiles", 2, bins - 1)
    place = F.size(F.filter(inner, lambda e: e <= F.col("value")))
    if closed:
        low, high = F.element_at("quantiles", 1) - 1e-6, F.element_at("quantiles", bins + 1) + 1e-6
        place = F.when(F.col("value").between(low, high), place)
    tallies = [
        count_where((F.col("bin") == i) & (F.col("side") == s)).alias(f"{s}{i}") for s in ("ref", "cur") for i in range(bins)
    ]
    sizes = [count_where(F.col("side") == s).alias(f"n_{s}") for s in ("ref", "cur")]
    counted = both.withColumn("bin", place).groupBy("feature").agg(*sizes, *tallies)

    def shares(side: str) -> Column:
        counts = F.array(*[F.col(f"{side}{i}") for i in range(bins)])
        raw = F.transform(counts, lambda n: ratio(n, F.col(f"n_{side}")))
        return F.transform(raw, lambda x: F.when(x == 0, 1e-6).otherwise(x) if closed else x + 1e-10)

    terms = F.zip_with("ref_shares", "cur_shares", lambda r, c: (c - r) * F.log(c / r))
    psi = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    if closed:
        psi = F.when((F.col("n_ref") >= min_rows) & (F.col("n_cur") >= min_rows), psi)
    status = (
        F.when(F.col("psi").isNull(), "too few rows").when(F.col("psi") < warning, "stable")
        .when(F.col("psi") < limit, "warning").otherwise("drift")
    )
    shared = counted.select("feature", "n_ref", "n_cur", shares("ref").alias("ref_shares"), shares("cur").alias("cur_shares"))
    return (
        shared.select("feature", "n_ref", "n_cur", psi.alias("psi")).withColumn("status", status)
        .orderBy(F.desc_nulls_last("psi"), "feature")
    )


def drift_count(report: DataFrame) -> DataFrame:
    """How many features drifted and whether to retrain."""
    return report.agg(count_where(F.col("status") == "drift").alias("drifted")).withColumn(
        "advice", F.when(F.col("drifted") > 0, "retrain").otherwise("no action")
    )


def drift_windows(df: DataFrame, ts: str, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(reference, current) of the serving monitor: 21 to 14 days back, and the last 7 days."""
    end = date.fromisoformat(as_of)
    kind = df.schema[ts].dataType

    def day(back: int) -> Column:
        return F.lit(f"{end - timedelta(days=back)} 00:00:00").cast(kind)

    return df.filter(F.col(ts).between(day(21), day(14))), df.filter(F.col(ts) >= day(7))


def best_registered_run(runs: DataFrame, versions: DataFrame, n: int = 1) -> DataFrame:
    """Runs that have a registered version, best AUC first."""
    return runs.join(versions, "run_id").orderBy(F.desc("test_auc"), "run_id").limit(n)


def inference_stats(
    log: DataFrame, as_of: str, days: int = 7, max_error_rate: float = 0.05, max_latency_ms: float = 500
) -> DataFrame:
    """Daily requests, mean latency and errors of the serving log, with alarm flags."""
    start = F.unix_millis(F.lit(f"{date.fromisoformat(as_of) - timedelta(days=days)} 00:00:00").cast("timestamp"))
    daily = (
        log.filter(F.col("timestamp_ms") >= start)
        .groupBy(F.to_date(F.timestamp_millis("timestamp_ms")).alias("day"))
        .agg(
            F.count("*").alias("request_count"), F.avg("execution_duration_ms").alias("avg_latency_ms"),
            count_where(F.col("status_code") != 200).alias("error_count"),
        )
    )
    rate = ratio(F.col("error_count"), F.col("request_count"))
    return daily.withColumns({
        "error_rate": rate, "error_alarm": rate > max_error_rate, "latency_alarm": F.col("avg_latency_ms") > max_latency_ms,
    }).orderBy("day")
