"""Saved prediction pipelines: fit, write, load and apply the whole chain to a table.

A pipeline is an MLlib `PipelineModel`: align, impute, encode and scale (`TabularPreparer`), or tokens and
TF-IDF rows for text, then a model, then the decoding of classes (`ClassDecoder`). Everything
that scoring needs is inside, so a table is scored by expressions alone, without a pass over the batch
for its own statistics. `save` writes the pipeline and, beside it, its facts as a table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import IDF, CountVectorizer, ElementwiseProduct, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import stats
from tallyloom.operators.learn import topk_classes


def number(name: str) -> Column:
    """A numeric column as double; NaN and infinities count as missing."""
    x = F.col(name).try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


class TabularPreparer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Feature columns to one scaled vector.

    Each feature's fact holds its kind, the value that fills gaps, the known classes of a category, and
    its mean and scale. Extra columns are ignored, missing ones are an error that names them; an unseen
    category counts as the first known one."""

    facts = Param(Params._dummy(), "facts", "one JSON object per feature, in the model's order", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, facts=None, outputCol="features"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def features(self) -> list[dict]:
        return [json.loads(x) for x in self.getOrDefault(self.facts)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        facts = self.features()
        known = {c.lower() for c in dataset.columns}
        missing = [f["name"] for f in facts if f["name"].lower() not in known]
        if missing:
            raise ValueError(f"missing feature columns: {missing}")
        scaled = [(encoded(f) - F.lit(f["mean"])) / F.lit(f["scale"]) for f in facts]
        return dataset.withColumn(self.getOrDefault(self.outputCol), array_to_vector(F.array(*scaled)))


def encoded(fact: dict) -> Column:
    """The filled feature as a number: a category is its place among the known classes."""
    if fact["kind"] == "number":
        return F.coalesce(number(fact["name"]), F.lit(fact["fill"]))
    value = F.coalesce(F.col(fact["name"]).cast("string"), F.lit(fact["fill"]))
    classes = F.array(*[F.lit(c) for c in fact["classes"]])
    return F.greatest(F.array_position(classes, value) - 1, F.lit(0)).cast("double")


def distinct_classes(df: DataFrame, column: str, limit: int) -> list[str]:
    """The ascending values of a column as text; more than `limit` of them are an error."""
    found = df.select(F.col(column).cast("string").alias("c")).where("c IS NOT NULL").distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column!r} has more than {limit} values")
    return sorted(r["c"] for r in found)


def fit_preparer(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], max_classes: int = 1000) -> TabularPreparer:
    """Means, most frequent categories (the lowest of ties), classes and scales of the training rows; a column
    without any value is filled with 0 or 'unknown'."""
    facts = [{"name": c, "kind": "number"} for c in numeric]
    facts += [{"name": c, "kind": "category", "classes": distinct_classes(df, c, max_classes) or ["unknown"]} for c in categorical]
    fills = df.agg(*[F.avg(number(f["name"])) if f["kind"] == "number" else F.mode(F.col(f["name"]).cast("string"), True)
                     for f in facts]).first()
    for f, fill in zip(facts, fills):
        f["fill"] = fill if fill is not None else (0.0 if f["kind"] == "number" else f["classes"][0])
    spread = df.agg(*[x for f in facts for x in (F.avg(encoded(f)), F.stddev_pop(encoded(f)))]).first()
    for i, f in enumerate(facts):
        f["mean"], f["scale"] = spread[2 * i] or 0.0, spread[2 * i + 1] or 1.0
    return TabularPreparer(facts=[json.dumps(f, ensure_ascii=False) for f in facts])


class LinearScorer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A linear model with stated coefficients: one row of them gives a regression, several give a
    softmax over classes (the lowest class on ties)."""

    coefficients = Param(Params._dummy(), "coefficients", "all rows, one after the other", TypeConverters.toListFloat)
    intercepts = Param(Params._dummy(), "intercepts", "one per row", TypeConverters.toListFloat)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, coefficients=None, intercepts=None, featuresCol="features"):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        flat, cuts = self.getOrDefault(self.coefficients), self.getOrDefault(self.intercepts)
        width = len(flat) // len(cuts)
        out = dataset.withColumn("__x", vector_to_array(self.getOrDefault(self.featuresCol)))
        margins = [F.lit(cut) + sum((F.get("__x", j) * F.lit(flat[i * width + j]) for j in range(width)), F.lit(0.0))
                   for i, cut in enumerate(cuts)]
        if len(cuts) == 1:
            return out.withColumn("prediction", margins[0]).drop("__x")
        out = out.withColumn("__z", F.array(*margins)).withColumn("__top", F.array_max("__z"))
        out = out.withColumn("__e", F.transform("__z", lambda z: F.exp(z - F.col("__top"))))
        total = F.aggregate("__e", F.lit(0.0), lambda a, e: a + e)
        return out.withColumn("probability", array_to_vector(F.transform("__e", lambda e: e / total))) \
            .withColumn("prediction", (F.array_position("__z", F.col("__top")) - 1).cast("double")).drop("__x", "__z", "__top", "__e")


class ClassDecoder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`predicted_label`, `confidence`, `top` (class, probability) and `probs` from a model's prediction; without
    classes the prediction is a number, rounded, and the others are null."""

    classes = Param(Params._dummy(), "classes", "class names in the order of their codes", TypeConverters.toListString)
    top = Param(Params._dummy(), "top", "how many classes to list", TypeConverters.toInt)
    decimals = Param(Params._dummy(), "decimals", "digits of probabilities and numbers", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, classes=None, top=3, decimals=4):
        super().__init__()
        self._setDefault(classes=[], top=3, decimals=4)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, digits = self.getOrDefault(self.classes), self.getOrDefault(self.decimals)
        pair = "array<struct<class:string,probability:double>>"
        if not names:
            return dataset.withColumn("prediction", F.round("prediction", digits)).withColumns({
                "predicted_label": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double"),
                "top": F.lit(None).cast(pair), "probs": F.lit(None).cast("array<double>")})
        listed = F.array(*[F.lit(c) for c in names])
        out = dataset.withColumn("predicted_label", F.get(listed, F.col("prediction").cast("int")))
        if "probability" not in dataset.columns:  # models that give margins only
            return out.withColumns({"confidence": F.lit(None).cast("double"), "top": F.lit(None).cast(pair),
                                    "probs": F.lit(None).cast("array<double>")})
        out = out.withColumn("probs", vector_to_array("probability"))
        best = F.transform(topk_classes(F.col("probs"), self.getOrDefault(self.top)), lambda t: F.struct(
            F.get(listed, t["class"]).alias("class"), F.round(t["probability"], digits).alias("probability")))
        return out.withColumn("confidence", F.round(F.array_max("probs"), digits)).withColumn("top", best)


class MixedTokens(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Words, and CJK characters, of a text column (null: none)."""

    inputCol = Param(Params._dummy(), "inputCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "array of tokens", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol="tokens"):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="tokens")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        text = self.getOrDefault(self.inputCol)
        if text.lower() not in {c.lower() for c in dataset.columns}:
            raise ValueError(f"missing feature columns: [{text!r}]")
        return dataset.withColumn(self.getOrDefault(self.outputCol), tx.mixed_tokens(F.coalesce(F.col(text), F.lit(""))))


def _as_label(df: DataFrame, target: str, classes: Sequence[str]) -> DataFrame:
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(target).cast("string")) - 1
    return df.where(F.col(target).isNotNull()).withColumn("label", code.cast("double"))


def fit_tabular(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, model: Estimator | Transformer,
                task: str = "classification", max_classes: int = 1000) -> PipelineModel:
    """The whole chain for feature columns: `model` is an estimator (fitted here on the prepared rows whose
    target is known) or a given transformer such as `LinearScorer`."""
    prepare = fit_preparer(df, numeric, categorical, max_classes)
    classes = distinct_classes(df, target, max_classes) if task == "classification" else []
    return PipelineModel([prepare, _fitted(prepare.transform(df), target, model, task, classes), ClassDecoder(classes=classes)])


def _fitted(ready: DataFrame, target: str, model, task: str, classes: Sequence[str]) -> Transformer:
    if not isinstance(model, Estimator):
        return model
    if task == "classification":
        return model.fit(_as_label(ready, target, classes))
    return model.fit(ready.withColumn("label", number(target)).where(F.col("label").isNotNull()))


def fit_text(df: DataFrame, text: str, target: str, model: Estimator, max_features: int, min_texts: int = 1,
             max_classes: int = 1000, weight: str | None = None) -> PipelineModel:
    """The whole chain for a text column: the `max_features` most frequent tokens (found in `min_texts` texts or more)
    make L2-normalised TF-IDF rows with weights ln((1 + n) / (1 + texts)) + 1. With `weight`, the model also sees
    a column of that name with balanced class weights."""
    classes = distinct_classes(df, target, max_classes)
    tokens = MixedTokens(inputCol=text)
    rows = tokens.transform(_as_label(df, target, classes))
    counts = CountVectorizer(inputCol="tokens", outputCol="counts", vocabSize=max_features, minDF=float(min_texts)).fit(rows)
    idf = IDF(inputCol="counts").fit(counts.transform(rows)).idf.toArray() + 1.0
    weigh = ElementwiseProduct(inputCol="counts", outputCol="weighed", scalingVec=DenseVector(idf))
    unit = Normalizer(inputCol="weighed", outputCol="features", p=2.0)
    ready = unit.transform(weigh.transform(counts.transform(rows)))
    if weight:
        from tallyloom.operators.learn import weighted

        ready = weighted(ready, "label", weight)
    return PipelineModel([tokens, counts, weigh, unit, model.fit(ready), ClassDecoder(classes=classes)])


def inputs(model: PipelineModel) -> list[str]:
    """The columns a pipeline reads, in its order."""
    first = model.stages[0]
    return [f["name"] for f in first.features()] if isinstance(first, TabularPreparer) else [first.getOrDefault(first.inputCol)]


def facts(model: PipelineModel, spark) -> DataFrame:
    """(kind, place, name, fill, mean, scale, classes): the inputs of a pipeline and the classes it predicts."""
    rows = []
    if isinstance(model.stages[0], TabularPreparer):
        rows = [(f["kind"], i, f["name"], str(f["fill"]), f["mean"], f["scale"], f.get("classes"))
                for i, f in enumerate(model.stages[0].features())]
    else:
        rows = [("text", 0, inputs(model)[0], None, None, None, None)]
        rows += [("token", i, t, None, None, float(w), None)
                 for i, (t, w) in enumerate(zip(model.stages[1].vocabulary, model.stages[2].getScalingVec()))]
    rows += [("class", i, c, None, None, None, None) for i, c in enumerate(model.stages[-1].getOrDefault("classes"))]
    return spark.createDataFrame(rows, "kind STRING, place INT, name STRING, fill STRING, mean DOUBLE, scale DOUBLE, classes ARRAY<STRING>")


def save(model: PipelineModel, path: str, spark) -> None:
    """Write the pipeline below `path`/model and its facts as a table below `path`/facts."""
    model.write().overwrite().save(f"{path}/model")
    facts(model, spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/facts")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The kept columns (of any name), prediction, predicted_label, confidence, top and probs of every row."""
    needed = inputs(model)
    known = {c.lower() for c in df.columns}
    missing = [c for c in needed if c.lower() not in known]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    # kept columns travel apart, so their names cannot meet those of the stages
    rows = df.select(F.struct(*keep).alias("__kept"), *needed)
    return model.transform(rows).select("__kept.*", "prediction", "predicted_label", "confidence", "top", "probs")


def evaluate(model: PipelineModel, df: DataFrame, target: str, independent: bool) -> DataFrame:
    """One row of metrics of a pipeline on labelled rows (those with a target): of classes, or of numbers when the
    pipeline predicts numbers; `independent` says whether the rows were kept from training."""
    names = model.stages[-1].getOrDefault("classes")
    if names:
        scored = predict(model, df.where(F.col(target).isNotNull()).withColumn("__y", F.col(target).cast("string")), ["__y"])
        matrix = stats.confusion_matrix(scored, "__y", "predicted_label")
        found = stats.classification_metrics(matrix)
        return found.join(matrix.agg(F.sum("n").alias("num_samples"))).withColumn("independent", F.lit(independent))
    rows = df.withColumn("__y", number(target)).where(F.col("__y").isNotNull())
    scored = predict(model, rows, ["__y"])
    return stats.regression_metrics(scored, "__y", "prediction").join(scored.agg(F.count("*").alias("num_samples"))) \
        .withColumn("independent", F.lit(independent))
