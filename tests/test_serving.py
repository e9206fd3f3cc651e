"""Saved prediction pipelines: the whole chain, written, read again and compared with plain Python."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import learn, serving

ROWS = [(1.0, 10.0, "a", "u", "yes"), (2.0, None, "b", "u", "no"), (3.0, 30.0, "b", None, "yes"), (None, 40.0, None, "v", "no"),
        (5.0, float("nan"), "a", "v", "maybe"), (6.0, 60.0, "c", "w", None)]
SCHEMA = "x double, y double, kind string, tone string, target string"
LATER = [(1, 2.0, None, "b", "w"), (2, None, 7.0, "unseen", None), (3, float("inf"), float("nan"), None, "u")]
COEFFICIENTS, CUTS = [[0.5, -0.2, 0.3, 0.1], [-0.4, 0.6, 0.0, 0.2], [0.1, 0.1, -0.7, 0.9]], [0.1, -0.3, 0.2]


def table(spark, rows=ROWS, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def known(values):
    return [v for v in values if v is not None and not (isinstance(v, float) and not math.isfinite(v))]


class Plain:
    """The chain in plain Python."""

    def __init__(self, rows):
        columns = list(zip(*rows))
        self.fill, self.classes = [], []
        for i in range(4):
            v = known(columns[i])
            self.classes.append(sorted(set(v)) if i > 1 else None)
            self.fill.append(sum(v) / len(v) if i < 2 else min(v, key=lambda c: (-Counter(v)[c], c)))
        coded = list(zip(*[self.code(r[:4]) for r in rows]))
        self.mean = [sum(c) / len(c) for c in coded]
        self.scale = [math.sqrt(sum((x - m) ** 2 for x in c) / len(c)) or 1.0 for c, m in zip(coded, self.mean)]

    def code(self, row):
        out = []
        for i, v in enumerate(row):
            v = v if known([v]) else self.fill[i]
            out.append(v if i < 2 else float(self.classes[i].index(v) if v in self.classes[i] else 0))
        return out

    def scaled(self, row):
        return [(x - m) / s for x, m, s in zip(self.code(row), self.mean, self.scale)]

    def probabilities(self, row):
        x = self.scaled(row)
        z = [c + sum(w * v for w, v in zip(r, x)) for r, c in zip(COEFFICIENTS, CUTS)]
        e = [math.exp(v - max(z)) for v in z]
        return [v / sum(e) for v in e]


def linear():
    return serving.LinearScorer(coefficients=[w for r in COEFFICIENTS for w in r], intercepts=CUTS)


@pytest.fixture(scope="module")
def saved(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("model"))
    model = serving.fit_tabular(table(spark), ["x", "y"], ["kind", "tone"], "target", linear())
    serving.save(model, path, spark)
    return path


def test_a_loaded_pipeline_scores_gaps_and_unseen_categories(spark, saved):
    plain = Plain(ROWS)
    # columns in another order and case, more of them, and kept ones named like those of the stages
    later = table(spark.newSession(), LATER, "id long, x double, y double, kind string, tone string").select(
        "tone", F.col("x").alias("X"), F.lit(9).alias("extra"), "id", "kind", "y", F.lit("mine").alias("features"), F.lit(1).alias("label"))
    got = serving.predict(serving.load(saved), later, ["id", "features", "label", "kind"]).orderBy("id").collect()
    for r, row in zip(got, LATER):
        want = plain.probabilities(row[1:])
        assert r["probs"] == pytest.approx(want)
        names = ["maybe", "no", "yes"]
        best = sorted(range(3), key=lambda i: (-want[i], i))
        assert r["predicted_label"] == names[best[0]] and r["features"] == "mine" and r["label"] == 1 and r["kind"] == row[3]
        assert [(t["class"], t["probability"]) for t in r["top"]] == [(names[i], pytest.approx(round(want[i], 4))) for i in best]
        assert r["confidence"] == pytest.approx(round(max(want), 4))


def test_missing_columns_are_named(spark, saved):
    later = table(spark, LATER, "id long, x double, y double, kind string, tone string").drop("y", "tone")
    with pytest.raises(ValueError, match=r"missing feature columns: \['y', 'tone'\]"):
        serving.predict(serving.load(saved), later, ["id"])


def test_facts_are_a_table(spark, saved):
    facts = spark.read.parquet(f"{saved}/facts")
    assert {(r["kind"], r["place"], r["name"]) for r in facts.collect()} == {
        ("number", 0, "x"), ("number", 1, "y"), ("category", 2, "kind"), ("category", 3, "tone"),
        ("class", 0, "maybe"), ("class", 1, "no"), ("class", 2, "yes")}
    plain = Plain(ROWS)
    for r in facts.where("kind <> 'class'").collect():
        assert r["mean"] == pytest.approx(plain.mean[r["place"]]) and r["scale"] == pytest.approx(plain.scale[r["place"]])
        assert r["fill"] == str(plain.fill[r["place"]])


def test_empty_tables_and_columns_without_values(spark, saved):
    empty = table(spark, [], "id long, x double, y double, kind string, tone string")
    assert serving.predict(serving.load(saved), empty, ["id"]).count() == 0
    rows = table(spark, [(None, 1.0, None, "u", "a"), (None, 1.0, None, "v", "b")])
    model = serving.fit_tabular(rows, ["x", "y"], ["kind", "tone"], "target", serving.LinearScorer(
        coefficients=[1.0] * 8, intercepts=[0.0, 1.0]))
    assert {r["predicted_label"] for r in serving.predict(model, rows, []).collect()} == {"b"}


def test_a_regression_is_fitted_saved_and_loaded(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (7.0, None)], "x double, y double")
    model = serving.fit_tabular(rows, ["x"], [], "y", learn.make("linear_regression"), task="regression")
    serving.save(model, str(tmp_path), spark)
    asked = spark.createDataFrame([(4.0,), (None,)], "x double")
    got = serving.predict(serving.load(str(tmp_path)), asked, ["x"]).collect()
    assert [r["prediction"] for r in got] == [8.0, 6.5]  # the mean of x is 3.25
    assert all(r["predicted_label"] is None and r["top"] is None for r in got)
    report = serving.evaluate(model, rows, "y", True).first()
    assert report["r2"] == pytest.approx(1.0) and report["num_samples"] == 3 and report["independent"]


@pytest.mark.parametrize("name, params", [("random_forest", {"numTrees": 5}), ("logistic_regression", {"maxIter": 20}), ("svm", {"maxIter": 10})])
def test_fitted_classifiers_survive_saving(spark, tmp_path, name, params):
    rows = spark.range(200).select((F.col("id") % 10).cast("double").alias("x"), F.when(F.col("id") % 2 == 0, "p").otherwise("q").alias("kind"),
                                   F.when(F.col("id") % 10 < 5, "low").otherwise("high").alias("target"), "id")
    model = serving.fit_tabular(rows, ["x"], ["kind"], "target", learn.make(name, **params))
    serving.save(model, str(tmp_path), spark)
    before = serving.predict(model, rows, ["id"]).orderBy("id").collect()
    after = serving.predict(serving.load(str(tmp_path)), rows, ["id"]).orderBy("id").collect()
    assert before == after
    report = serving.evaluate(model, rows, "target", False).first()
    assert report["accuracy"] > 0.95 and report["num_samples"] == 200 and not report["independent"]
    # margins alone give no probabilities
    assert all((r["probs"] is None) == (name == "svm") for r in after)


def test_text_pipelines_have_a_bounded_vocabulary(spark, tmp_path):
    texts = [("good good fine", "up"), ("fine good day", "up"), ("bad bad awful", "down"), ("awful day bad", "down"), (None, "up"), ("", "down")] * 5
    rows = spark.createDataFrame(texts, "said string, mood string")
    model = serving.fit_text(rows, "said", "mood", learn.make("logistic_regression", maxIter=30, regParam=0.01), max_features=4)
    assert len(model.stages[1].vocabulary) == 4
    serving.save(model, str(tmp_path), spark)
    loaded = serving.load(str(tmp_path))
    asked = spark.createDataFrame([(1, "a good one"), (2, "such a bad one"), (3, None), (4, "unknown words")], "id int, said string")
    got = serving.predict(loaded, asked, ["id"]).orderBy("id").collect()
    assert [r["predicted_label"] for r in got[:2]] == ["up", "down"]
    assert got[2]["probs"] == got[3]["probs"]  # nothing known in either
    # weights ln((1 + n) / (1 + texts)) + 1, rows of length one
    row = model.stages[3].transform(model.stages[2].transform(model.stages[1].transform(model.stages[0].transform(rows)))).first()
    vocabulary = model.stages[1].vocabulary
    weight = {w: math.log(31 / 11) + 1 for w in ("good", "fine")}
    size = math.sqrt((2 * weight["good"]) ** 2 + ("fine" in vocabulary) * weight["fine"] ** 2)
    assert row["features"][vocabulary.index("good")] == pytest.approx(2 * weight["good"] / size)


def test_too_many_classes_are_an_error(spark):
    rows = spark.range(50).select(F.col("id").cast("string").alias("kind"), F.lit(1.0).alias("x"))
    with pytest.raises(ValueError, match="more than 20 values"):
        serving.fit_preparer(rows, ["x"], ["kind"], max_classes=20)
