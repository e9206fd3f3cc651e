"""MLlib estimators behind names, training, search and batch inference."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import (ClusteringEvaluator, Evaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators import sampling, stats
from tallyloom.session import cut_lineage
from tallyloom.sources.readers import union_all

CLASSIFIERS: dict[str, Callable[..., Estimator]] = {
    "random_forest": RandomForestClassifier, "logistic_regression": LogisticRegression,
    "gradient_boosting": GBTClassifier, "decision_tree": DecisionTreeClassifier, "svm": LinearSVC,
}
REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "linear_regression": LinearRegression, "ridge": LinearRegression,
    "random_forest_regressor": RandomForestRegressor, "gradient_boosting_regressor": GBTRegressor,
}
CLUSTERERS: dict[str, Callable[..., Estimator]] = {
    "kmeans": KMeans, "minibatch_kmeans": KMeans, "agglomerative": BisectingKMeans,
}
BINARY_ONLY = ("gradient_boosting", "svm")

def make(name: str, classes: int = 2, seed: int = 42, **params) -> Estimator:
    """Estimator by name; what is not given keeps MLlib's default, and binary-only
    learners are wrapped for more classes. A caller registers more by adding to the tables above."""
    table = {**CLASSIFIERS, **REGRESSORS, **CLUSTERERS}
    if name not in table:
        raise ValueError(f"unsupported algorithm {name!r}; known: {sorted(table)}")
    settings = {k: v for k, v in params.items() if v is not None}
    est = table[name]()
    if est.hasParam("seed"):
        settings.setdefault("seed", seed)
    for k, v in settings.items():
        if not est.hasParam(k):
            raise ValueError(f"{name} has no parameter {k!r}")
        est.set(est.getParam(k), v)
    if name in BINARY_ONLY and classes > 2:
        return OneVsRest(classifier=est)
    return est


def as_vectors(df: DataFrame, vec: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(vec, lambda x: x.cast("double"))))


def weighted(df: DataFrame, label: str, alias: str = "weight") -> DataFrame:
    """Balanced class weights n/(k·count) joined on the class; every row keeps its weight."""
    w = stats.inverse_frequency_weights(df, label, threshold=0.0).select(
        F.col(label).alias("__l"), F.col("weight").alias(alias))
    return df.join(w, F.col(label).eqNullSafe(F.col("__l")), "left").drop("__l")


def tabular_pipeline(numeric: Sequence[str], categorical: Sequence[str], model: Estimator | None = None) -> Pipeline:
    """Impute means, index categories alphabetically (unseen kept apart), scale,
    and fit a model if given. Every statistic comes from the rows the pipeline is fitted on."""
    stages: list = [Imputer(inputCols=list(numeric), outputCols=[f"{c}__f" for c in numeric])]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=[f"{c}__f" for c in categorical],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    stages += [VectorAssembler(inputCols=[f"{c}__f" for c in [*numeric, *categorical]], outputCol="raw_features"),
               StandardScaler(inputCol="raw_features", outputCol="features", withMean=True)]
    return Pipeline(stages=stages + ([model] if model is not None else []))


class MacroEvaluator(Evaluator):
    """Macro-averaged precision, recall or F1."""

    def __init__(self, metric: str = "f1", label: str = "label", prediction: str = "prediction"):
        super().__init__()
        self.metric, self.label, self.prediction = metric, label, prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        m = stats.confusion_matrix(dataset.select(F.col(self.label).cast("int").alias("a"),
                                                  F.col(self.prediction).cast("int").alias("p")), "a", "p")
        return stats.classification_metrics(m).first()[f"{self.metric}_macro"]

    def isLargerBetter(self) -> bool:
        return True


def scorer(task: str, label: str = "label") -> Evaluator:
    if task == "regression":
        return RegressionEvaluator(labelCol=label, metricName="r2")
    if task == "clustering":
        return ClusteringEvaluator()
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


# -------------------------------------------------------------------- search

def grid(space: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the value lists."""
    names = list(space)
    return [dict(zip(names, values, strict=True)) for values in itertools.product(*space.values())]


def random_draws(space: Mapping[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """n draws: more than three whole numbers give a range, positive fractions a
    log-uniform range, anything else a choice."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        row = {}
        for name, values in space.items():
            kinds = {type(v) for v in values}
            if kinds == {int} and len(values) > 3:
                row[name] = int(rng.integers(min(values), max(values) + 1))
            elif kinds <= {int, float} and float in kinds and min(values) > 0:
                row[name] = float(math.exp(rng.uniform(math.log(min(values)), math.log(max(values)))))
            else:
                row[name] = values[int(rng.integers(len(values)))]
        out.append(row)
    return out


def search(df: DataFrame, key: str, label: str, algorithm: str, candidates: Sequence[dict], task: str = "classification",
           folds: int = 5, seed: int = 42, classes: int = 2, parallelism: int = 2) -> DataFrame:
    """Fit every candidate on every stratified fold and rank the mean scores.

    Rows: algorithm, params, mean, deviation, folds, rank, error, one for every
    candidate. A failing candidate is reported with its error instead of stopping
    the search. The folds are written once; candidates are fitted side by side,
    each fit an ordinary distributed MLlib job.
    """
    split_on = label if task == "classification" else "__one"
    base = df.withColumn("__one", F.lit(1))
    with_folds = cut_lineage(sampling.stratified_kfold(base, key, split_on, folds, seed).select(
        "features", F.col(label).cast("double").alias("label"), "fold"), "folds")
    k = with_folds.agg(F.max("fold")).first()[0] + 1
    judge = scorer(task)

    def judged(params: dict) -> tuple:
        scores, error = [], None
        try:
            for f in range(k):
                model = make(algorithm, classes, seed, **params).fit(with_folds.filter(F.col("fold") != f))
                scores.append(float(judge.evaluate(model.transform(with_folds.filter(F.col("fold") == f)))))
        except Exception as exc:  # one bad candidate must not end the search
            error = f"{type(exc).__name__}: {str(exc)[:200]}"
        good = scores and not error
        return (algorithm, str(sorted(params.items())), float(np.mean(scores)) if good else None,
                float(np.std(scores)) if good else None, len(scores), error)

    with ThreadPoolExecutor(parallelism) as pool:
        results = list(pool.map(inheritable_thread_target(df.sparkSession)(judged), candidates))
    found = df.sparkSession.createDataFrame(
        results, "algorithm STRING, params STRING, mean_score DOUBLE, std_score DOUBLE, folds INT, error STRING")
    return found.withColumn("rank", F.rank().over(W.orderBy(F.desc_nulls_last("mean_score"))))


def auto_select(df: DataFrame, key: str, label: str, algorithms: Sequence[str], spaces: Mapping[str, Mapping[str, Sequence]],
                draws: int = 15, task: str = "classification", seed: int = 42, classes: int = 2, folds: int = 5) -> DataFrame:
    """Quick random search per algorithm; the best of each, best first."""
    boards = [search(df, key, label, a, random_draws(spaces[a], draws, seed), task, folds, seed, classes=classes)
              .orderBy("rank", "params").limit(1).drop("rank") for a in algorithms]
    return union_all(boards).withColumn("rank", F.rank().over(W.orderBy(F.desc_nulls_last("mean_score"))))


def cluster_search(df: DataFrame, candidates: Sequence[dict], algorithm: str = "kmeans", seed: int = 42) -> DataFrame:
    """Fit each candidate and score its silhouette, both on all rows: the
    evaluator's squared-distance silhouette is linear in the rows."""
    judge = ClusteringEvaluator()
    out = []
    for params in candidates:
        scored = make(algorithm, seed=seed, **params).fit(df).transform(df)
        out.append((str(sorted(params.items())), float(judge.evaluate(scored.select("features", "prediction")))))
    return df.sparkSession.createDataFrame(out, "params STRING, silhouette DOUBLE") \
        .withColumn("rank", F.rank().over(W.orderBy(F.desc("silhouette"))))


# ----------------------------------------------------------------- inference

def topk_classes(probabilities: Column, k: int = 3) -> Column:
    """The k most probable (class, probability) structs, lower class on ties."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("m"), i.alias("class"), p.alias("probability")))
    return F.slice(F.array_sort(pairs), 1, k)


def with_probabilities(scored: DataFrame, out: str = "probs") -> DataFrame:
    """Probability vector as an array; margin-only models give none."""
    if "probability" in scored.columns:
        return scored.withColumn(out, vector_to_array("probability"))
    return scored.withColumn(out, F.lit(None).cast("array<double>"))


def batch_predict(model: Transformer, df: DataFrame, keep: Sequence[str], classes: Sequence[str] | None = None,
                  top: int = 3) -> DataFrame:
    """Kept columns, prediction, its label, and the top classes as structs."""
    scored = with_probabilities(model.transform(df))
    names = F.array(*[F.lit(str(c)) for c in classes]) if classes else None
    label = F.get(names, F.col("prediction").cast("int")) if classes else F.col("prediction").cast("string")

    def entry(t):
        name = F.get(names, t["class"]) if classes else t["class"].cast("string")
        return F.struct(name.alias("class"), F.round(t["probability"], 4).alias("probability"))

    return scored.select(*keep, "prediction", label.alias("predicted_label"),
                         F.transform(topk_classes(F.col("probs"), top), entry).alias("top"), "probs")


def feature_importance(model: Model, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance, place): tree importances, or coefficients by size."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(model, "coefficients"):
        values = np.abs(model.coefficients.toArray())
    else:
        raise ValueError(f"{type(model).__name__} has no importances")
    order = sorted(zip(names, values, strict=True), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(n, float(v), i + 1) for i, (n, v) in enumerate(order)],
                                 "feature STRING, importance DOUBLE, place INT")


def train_mlp(df: DataFrame, hidden: Sequence[int], n_features: int, classes: int, max_iter: int = 100, seed: int = 42) -> Model:
    return MultilayerPerceptronClassifier(layers=[n_features, *hidden, classes], maxIter=max_iter, seed=seed).fit(df)
