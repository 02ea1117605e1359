import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array

from plantmetrics.functions.sizing import stored
from plantmetrics.operators import boosted, features, models

COLUMNS = ["a", "b", "c"]


def rows(spark, n, seed, noise=0.25):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 3)
    y = ((x[:, 0] + x[:, 1] ** 2 > 1) ^ (rng.uniform(size=n) < noise)).astype(int)
    data = [(int(k), *(None if rng.uniform() < 0.03 else float(v) for v in r)) for k, r in zip(y, x)]
    return spark.createDataFrame(data, "y int, a double, b double, c double").repartition(2, "a", "b", "c").sortWithinPartitions("a", "b", "c")


@pytest.fixture(scope="module")
def fit(spark):
    return boosted.fit_with_patience(rows(spark, 500, 1), rows(spark, 300, 2), "y", COLUMNS, rounds=60, patience=6, depth=4, step=0.3, first=16)


def test_expression_scores_are_those_of_the_fitted_model(spark):
    train = rows(spark, 400, 3)
    model = GBTClassifier(featuresCol="features", labelCol="y", maxIter=8, maxDepth=4, seed=1).fit(features.assemble(train, COLUMNS))
    plain = boosted.from_spark(model, COLUMNS)
    both = boosted.score_rows(plain, features.assemble(train, COLUMNS), "p")
    compared = model.transform(both).select("p", vector_to_array("probability")[1].alias("q")).collect()
    assert len(compared) == 400 and all(r.p == pytest.approx(r.q, abs=1e-12) for r in compared)


def test_rounds_stop_where_the_curve_turns_and_are_cut_back(fit):
    assert len(fit.model.trees) == fit.best_round == 1 + int(np.argmin(fit.losses))
    assert len(fit.losses) == fit.best_round + 6 < 60  # The curve turned before the last round.
    assert min(fit.losses[fit.best_round:]) >= fit.losses[fit.best_round - 1]


def test_a_second_fit_gives_the_same_model(spark, fit):
    again = boosted.fit_with_patience(rows(spark, 500, 1), rows(spark, 300, 2), "y", COLUMNS, rounds=60, patience=6, depth=4, step=0.3, first=60)
    assert again.model == fit.model and again.losses == fit.losses


def test_patience_rule():
    assert boosted.stop_after([5, 4, 3, 3.5, 3.2, 3.1, 1], 3) == (3, True)
    assert boosted.stop_after([5, 4, 3, 3.5, 3.2, 1], 4) == (6, False)
    assert boosted.stop_after([2, 2, 2], 2) == (1, True) and boosted.stop_after([1.0], 5) == (1, False)


def test_stored_model_comes_back(spark, fit, tmp_path):
    boosted.save_model(fit.model, spark, f"{tmp_path}/model")
    assert boosted.load_model(spark, f"{tmp_path}/model") == fit.model
    empty = boosted.BoostedModel(("a",), (), ())
    boosted.save_model(empty, spark, f"{tmp_path}/empty")
    assert boosted.load_model(spark, f"{tmp_path}/empty") == empty


def test_scores_stay_in_the_scan_and_rank_well(spark, fit):
    scored = boosted.score_rows(fit.model, stored(rows(spark, 400, 4)))
    assert models.classification_metrics(scored, "y", "failure_probability").first().auc > 0.6
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1
    assert scored.columns == ["y", "a", "b", "c", "failure_probability"]


def test_a_curve_that_does_not_turn_costs_two_fits(spark, monkeypatch):
    asked = []

    def counted(**settings):
        asked.append(settings["maxIter"])
        return GBTClassifier(**settings)

    monkeypatch.setattr(boosted, "GBTClassifier", counted)
    train = rows(spark, 300, 5, noise=0.0)
    found = boosted.fit_with_patience(train, train, "y", COLUMNS, rounds=12, patience=5, depth=2, step=0.1, first=2)
    assert asked == [2, 12] and len(found.losses) == 12
    assert spark.sparkContext.getCheckpointDir() is not None


def test_many_trees_are_not_one_huge_method(spark):
    """40 trees of depth 5: one method of them is left to the interpreter, 50 microseconds a row."""
    def tree(level, at):
        if level == 5:
            return boosted.Node(float(at))
        return boosted.Node(0.0, COLUMNS[at % 3], at / 16 - 1.0, tree(level + 1, 2 * at), tree(level + 1, 2 * at + 1))

    def value(node, row):
        while node.feature is not None:
            node = node.left if row[node.feature] <= node.threshold else node.right
        return node.value

    model = boosted.BoostedModel(tuple(COLUMNS), (1e-3,) * 40, tuple(tree(0, 1 + k) for k in range(40)))
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    scored = boosted.score_rows(model, stored(rows(spark, 100, 7).na.fill(0)), "p")
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    for r in scored.collect():
        margin = sum(1e-3 * value(t, r) for t in model.trees)
        assert r.p == pytest.approx(1 / (1 + np.exp(-2 * margin)), rel=1e-9)


def test_the_plan_does_not_grow_with_the_trees(spark):
    """An expression of 300 trees took all memory of a driver; the trees are no part of the plan."""
    split = boosted.Node(0.0, "a", 0.5, boosted.Node(-1.0), boosted.Node(0.0, "b", -0.25, boosted.Node(2.0), boosted.Node(0.5)))
    data = stored(rows(spark, 50, 8))

    def plan(n):
        scored = boosted.score_rows(boosted.BoostedModel(tuple(COLUMNS), (0.1,) * n, (split,) * n), data)
        return scored._jdf.queryExecution().optimizedPlan().toString()

    assert len(plan(80)) < 1.1 * len(plan(1))


def test_scores_of_gaps_and_of_far_margins(spark):
    """Missing values count as 0; a margin of -30 is a chance above 0, as 1 / (1 + exp(60)) is."""
    root = boosted.Node(0.0, "b", 0.0, boosted.Node(-30.0), boosted.Node(0.0, "a", -1.0, boosted.Node(1.0), boosted.Node(2.0)))
    data = spark.createDataFrame([(1, None, None), (2, float("nan"), 1.0), (3, -1.0, 0.5), (4, 5.0, -0.0)], "y int, a double, b double")
    found = {r.y: r.p for r in boosted.score_rows(boosted.BoostedModel(("b", "a"), (1.0,), (root,)), data, "p").collect()}
    for y, margin in {1: -30, 2: 2, 3: 1, 4: -30}.items():
        assert found[y] == pytest.approx(1 / (1 + np.exp(-2 * margin)), rel=1e-12)
    empty = boosted.score_rows(boosted.BoostedModel(("a",), (), ()), data, "p")
    assert [r.p for r in empty.collect()] == [0.5] * 4 and empty.columns == ["y", "a", "b", "p"]
