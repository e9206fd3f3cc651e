"""Search spaces, failure tolerance, evaluators and registry rules."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import advisors, learn


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(240).select("id", (F.col("id") % 2).cast("int").alias("label"),
                                 F.array((F.col("id") % 2 + (F.col("id") % 5) / 10).cast("double"), (F.col("id") % 7).cast("double")).alias("v"))
    return learn.as_vectors(df, "v")


def test_grid_and_draws():
    assert len(learn.grid({"a": [1, 2], "b": ["x", "y", "z"]})) == 6
    space = {"trees": [50, 100, 200, 300], "rate": [0.01, 0.1], "kind": ["a", "b"]}
    draws = learn.random_draws(space, 50, seed=1)
    assert draws == learn.random_draws(space, 50, seed=1)
    assert all(50 <= d["trees"] <= 300 and 0.01 <= d["rate"] <= 0.1 and d["kind"] in "ab" for d in draws)
    assert len({d["trees"] for d in draws}) > 10


def test_unknown_names_are_errors(spark):
    with pytest.raises(ValueError, match="unsupported algorithm"):
        learn.make("quantum_forest")
    with pytest.raises(ValueError, match="no parameter"):
        learn.make("ridge", colour="red")


def test_settings_are_the_callers(spark):
    assert learn.make("random_forest").getMaxDepth() == 5
    assert learn.make("random_forest", maxDepth=3).getMaxDepth() == 3


def test_search_survives_a_bad_candidate(data):
    board = learn.search(data, "id", "label", "decision_tree", [{"maxDepth": 2}, {"maxDepth": -1}], folds=2).collect()
    good, bad = board
    assert good.mean_score == 1.0 and good.rank == 1 and good.error is None
    assert bad.mean_score is None and bad.error


def test_macro_evaluator(data):
    model = learn.make("decision_tree", maxDepth=2).fit(data)
    assert learn.MacroEvaluator("f1").evaluate(model.transform(data)) == 1.0


def test_predictions_sum_to_one(data):
    model = learn.make("logistic_regression", maxIter=10).fit(data)
    rows = learn.batch_predict(model, data, ["id"], ["no", "yes"]).collect()
    assert all(abs(sum(r.probs) - 1) < 1e-9 and r.top[0].probability >= r.top[1].probability for r in rows)
    assert {r.predicted_label for r in rows} == {"no", "yes"}


def test_importance_order(data, spark):
    model = learn.make("random_forest", numTrees=3, maxDepth=3).fit(data)
    rows = learn.feature_importance(model, ["a", "b"], spark).collect()
    assert [r.place for r in rows] == [1, 2] and rows[0].importance >= rows[1].importance


def test_topk_ties_prefer_the_lower_class(spark):
    got = spark.createDataFrame([([0.2, 0.4, 0.4, 0.0],)], "p array<double>").select(learn.topk_classes(F.col("p"), 3)).first()[0]
    assert [r["class"] for r in got] == [1, 2, 0]


@pytest.mark.parametrize("task,acc,f1,r2,sil,want", [
    ("classification", 1.0, 0.96, None, None, 95.0), ("classification", 0.0, None, None, None, 0.0), ("classification", 0.5, 0.2, None, None, 0.0),
    ("regression", None, None, 0.95, None, 92.0), ("regression", None, None, -0.5, None, 1.5), ("regression", None, None, None, None, 20.0),
    ("clustering", None, None, None, 0.5, 65.0), ("clustering", None, None, None, -0.9, 0.0)])
def test_absolute_score(spark, task, acc, f1, r2, sil, want):
    df = spark.createDataFrame([(task, acc, f1, r2, sil)], "t string, a double, f double, r double, s double")
    assert df.select(advisors.absolute_score(*[F.col(c) for c in "tafrs"])).first()[0] == want


def test_overfit_falls_back_to_cross_validation(spark):
    df = spark.createDataFrame([(0.9, 0.9, False, 0.97), (0.9, 0.9, False, None), (None, 0.8, True, 0.99), (0.99, 0.7, True, None)],
                               "train double, test double, sep boolean, cv double")
    c = F.col
    got = [r[0] for r in df.select(advisors.overfit_severity(F.lit("classification"), c("train"), c("test"), c("sep"), c("cv"))).collect()]
    assert got == ["medium", "none", "critical", "critical"]


def test_every_class_has_a_weight(spark):
    rows = spark.range(12000).select((F.col("id") % 6000).cast("string").alias("y"))
    assert learn.weighted(rows, "y").filter("weight IS NULL").count() == 0


def test_search_returns_every_candidate(spark, data):
    board = learn.search(data, "id", "label", "decision_tree", [{"maxDepth": 1, "minInstancesPerNode": i + 1} for i in range(22)], folds=2)
    assert board.count() == 22
