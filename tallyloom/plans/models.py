"""Bindings for training, search and inference (rows-only: iterative fits)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import learn as op, sampling, serving, stats
from tallyloom.plans.registry import query, run_key, table
from tallyloom.session import cut_lineage, scratch_path
from tallyloom.sources import writers
from tallyloom.sources.readers import union_all


def vectors(spark, sf, classes: int | None = None):
    """Embeddings with a label and a stratified split."""
    v = table(spark, sf, "embeddings")
    label = F.col("label") % classes if classes else F.col("label")
    v = op.as_vectors(v.select("vec_id", "embedding", label.cast("int").alias("label")), "embedding")
    # every pass of a fit reads these rows again: write them once
    return cut_lineage(sampling.stratified_split(v, "vec_id", "label", 0.2), "train")


def halves(df):
    return df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")


@query("M01_train_classifier")
def train_classifier(spark, sf):
    out = []
    cuts = {k: halves(vectors(spark, sf, k)) for k in (2, 10)}
    for name, classes, params in (("random_forest", 10, {"numTrees": 10, "maxDepth": 6}), ("logistic_regression", 10, {"maxIter": 30}),
                                  ("decision_tree", 10, {"maxDepth": 5}), ("gradient_boosting", 2, {"maxIter": 5, "maxDepth": 3}),
                                  ("svm", 2, {"maxIter": 20, "regParam": 0.1})):
        train, test = cuts[classes]
        model = op.make(name, classes, **params).fit(train)
        out.append(model.transform(test).select(F.lit(name).alias("algorithm"), "vec_id", F.col("label").cast("string").alias("actual"),
                                                F.col("prediction").cast("int").cast("string").alias("predicted")))
    return union_all(out).groupBy("algorithm", "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))


@query("M02_train_regressor")
def train_regressor(spark, sf):
    li = table(spark, sf, "lineitem").select(
        run_key().alias("row_key"),
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice")
    train, test = halves(sampling.random_split(li, "row_key", 0.2))
    # one fitted preparation feeds all four learners
    prepare = op.tabular_pipeline(["l_quantity", "l_discount", "l_tax"], ["l_returnflag"]).fit(train)
    ready = lambda df: cut_lineage(prepare.transform(df).select("features", F.col("l_extendedprice").alias("label")), "features")
    train, test = ready(train), ready(test)
    out = []
    for name, params in (("linear_regression", {}), ("ridge", {}), ("random_forest_regressor", {"numTrees": 5, "maxDepth": 5}),
                         ("gradient_boosting_regressor", {"maxIter": 3, "maxDepth": 3})):
        scored = op.make(name, **params).fit(train).transform(test)
        out.append(stats.regression_metrics(scored, "label", "prediction").withColumn("algorithm", F.lit(name)))
    return union_all(out)


@query("M04_cluster")
def cluster(spark, sf):
    v = vectors(spark, sf)
    return op.make("kmeans", k=10).fit(v).transform(v).select("vec_id", "label", "prediction")


@query("M05_cluster_hierarchical")
def cluster_hierarchical(spark, sf):
    v = vectors(spark, sf)
    return op.make("agglomerative", k=5).fit(v).transform(v).select("vec_id", "label", "prediction")


@query("M07_train_mlp")
def train_mlp(spark, sf):
    train, test = halves(vectors(spark, sf))
    return op.train_mlp(train, [32], 64, 10, 40).transform(test).select("vec_id", "label", "prediction")


MAX_FEATURES = 2000


def labelled_texts(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text", F.when(F.col("quality") == 1, "high").otherwise("low").alias("label"))
    return cut_lineage(sampling.stratified_split(docs, "doc_id", "label", 0.25), "split")


@query("M08_train_text_classifier")
def train_text_classifier(spark, sf):
    train, test = halves(labelled_texts(spark, sf))
    model = serving.fit_text(train, "text", "label", op.make("logistic_regression", maxIter=30, regParam=0.01), MAX_FEATURES)
    return serving.predict(model, test, ["doc_id", "label"]).select("doc_id", "label", "predicted_label", F.to_json("top").alias("top"))


@query("M10_class_weighted_fit")
def class_weighted_fit(spark, sf):
    train, test = halves(labelled_texts(spark, sf))
    estimator = op.make("logistic_regression", maxIter=30, regParam=0.01, weightCol="weight")
    model = serving.fit_text(train, "text", "label", estimator, MAX_FEATURES, weight="weight")
    return serving.predict(model, test, ["doc_id", "label"]).select("doc_id", "label", "predicted_label")


@query("M11_grid_search")
def grid_search(spark, sf):
    return op.search(vectors(spark, sf), "vec_id", "label", "logistic_regression",
                     op.grid({"regParam": [0.01, 0.5], "maxIter": [10]}), folds=2, classes=10)


@query("M12_random_search")
def random_search(spark, sf):
    return op.search(vectors(spark, sf), "vec_id", "label", "decision_tree",
                     op.random_draws({"maxDepth": [2, 3, 4, 5], "minInstancesPerNode": [1, 2, 4]}, 2), folds=2, classes=10)


@query("M13_auto_select")
def auto_select(spark, sf):
    spaces = {"logistic_regression": {"regParam": [0.01, 0.1], "maxIter": [10]}, "decision_tree": {"maxDepth": [3, 5]},
              "svm": {"regParam": [-1.0]}}
    return op.auto_select(vectors(spark, sf, 2), "vec_id", "label", list(spaces), spaces, draws=1, folds=2)


@query("M14_cluster_search")
def cluster_search(spark, sf):
    return op.cluster_search(vectors(spark, sf), op.grid({"k": [5, 10], "maxIter": [20]}))


@query("M16_predict_vectors")
def predict_vectors(spark, sf):
    train, test = halves(vectors(spark, sf))
    model = op.make("logistic_regression", maxIter=20).fit(train)
    return op.batch_predict(model, test, ["vec_id", "label"], [f"class_{i}" for i in range(10)]).select(
        "vec_id", "label", "prediction", "predicted_label", F.to_json("top").alias("top"))


# a linear model over the order lines: quantity, discount, tax, line status and quarter of shipping
NUMERIC, CATEGORICAL = ["quantity", "discount", "tax"], ["line_status", "quarter"]
FLAG_ROWS = [[0.4, -0.3, 0.2, -1.1, 0.3], [-0.2, 0.5, -0.4, 1.4, 0.1], [0.1, -0.2, 0.3, -0.6, -0.5]]
FLAG_CUTS = [0.1, 0.3, -0.1]
PRICE_ROW, PRICE_CUT = [22.0, -0.5, 0.25, 0.1, -0.2], 38.0


def order_lines(spark, sf, later: bool = False):
    """Order lines with gaps; the `later` ones also have an unknown line status and gaps in the quantity."""
    status = F.when(F.col("l_partkey") % 11 == 0, None).otherwise(F.col("l_linestatus"))
    quantity = F.col("l_quantity")
    if later:
        status = F.when(F.col("l_suppkey") % 13 == 0, "X").otherwise(status)
        quantity = F.when(F.col("l_suppkey") % 17 == 0, float("nan")).otherwise(quantity)
    return table(spark, sf, "lineitem").select(
        run_key().alias("run_id"), quantity.alias("quantity"), F.col("l_discount").alias("discount"),
        F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("tax"), status.alias("line_status"),
        F.concat(F.lit("Q"), F.quarter("l_shipdate")).alias("quarter"), F.col("l_returnflag").alias("flag"),
        (F.col("l_extendedprice") / 1000).alias("price"), F.lit("not a feature").alias("features"))


def reloaded(spark, sf, task: str):
    """The pipeline with given coefficients, fitted, saved and loaded again."""
    rows = order_lines(spark, sf)
    if task == "classification":
        given = serving.LinearScorer(coefficients=[x for r in FLAG_ROWS for x in r], intercepts=FLAG_CUTS)
        model = serving.fit_tabular(rows, NUMERIC, CATEGORICAL, "flag", given)
    else:
        given = serving.LinearScorer(coefficients=PRICE_ROW, intercepts=[PRICE_CUT])
        model = serving.fit_tabular(rows, NUMERIC, CATEGORICAL, "price", given, task)
    path = scratch_path(spark, "pipeline")
    serving.save(model, path, spark)
    return serving.load(path)


def _scores(row, cut):
    return f"{cut}::DOUBLE + " + " + ".join(f"{w}::DOUBLE * {c}" for w, c in zip(row, ("zq", "zd", "zt", "zs", "zw")))


def _prepared(name: str, later: bool) -> str:
    status = "CASE WHEN l_partkey % 11 <> 0 THEN l_linestatus END"
    quantity = "l_quantity"
    if later:
        status = f"CASE WHEN l_suppkey % 13 = 0 THEN 'X' ELSE {status} END"
        quantity = "CASE WHEN l_suppkey % 17 <> 0 THEN l_quantity END"
    return f"""
    {name}_raw AS (
      SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER) AS run_id, {quantity} AS q, l_discount AS d,
             CASE WHEN l_linenumber <> 3 THEN l_tax END AS t, {status} AS s, quarter(l_shipdate) - 1 AS w, l_returnflag AS flag,
             l_extendedprice / 1000 AS price FROM lineitem),
    {name}_full AS (
      SELECT run_id, flag, price, coalesce(q, mq) AS q, d, coalesce(t, mt) AS t, w,
             coalesce(nullif(list_position((SELECT list(DISTINCT s ORDER BY s) FROM train_raw WHERE s IS NOT NULL), coalesce(s, ms)), 0) - 1, 0) AS s
      FROM {name}_raw, (SELECT avg(q) AS mq, avg(t) AS mt FROM train_raw),
           (SELECT s AS ms FROM train_raw WHERE s IS NOT NULL GROUP BY s ORDER BY count(*) DESC, s LIMIT 1))"""


def _chain(name: str) -> str:
    """Common tables up to `scored`: probabilities pa, pn, pr and the number `guess` of every row of `name`."""
    tables = _prepared("train", False) + ("," + _prepared("later", True) if name == "later" else "")
    z = [_scores(r, c) for r, c in zip(FLAG_ROWS, FLAG_CUTS)]
    return f"""{tables},
    stat AS (SELECT avg(q) AS aq, stddev_pop(q) AS sq, avg(d) AS ad, stddev_pop(d) AS sd, avg(t) AS at_, stddev_pop(t) AS st,
                    avg(s) AS as_, stddev_pop(s) AS ss, avg(w) AS aw, stddev_pop(w) AS sw FROM train_full),
    scaled AS (SELECT run_id, flag, price, (q - aq) / sq AS zq, (d - ad) / sd AS zd, (t - at_) / st AS zt, (s - as_) / ss AS zs, (w - aw) / sw AS zw
               FROM {name}_full, stat),
    margins AS (SELECT *, {z[0]} AS za, {z[1]} AS zn, {z[2]} AS zr, {_scores(PRICE_ROW, PRICE_CUT)} AS guess FROM scaled),
    powers AS (SELECT *, exp(za - greatest(za, zn, zr)) AS ea, exp(zn - greatest(za, zn, zr)) AS en, exp(zr - greatest(za, zn, zr)) AS er FROM margins),
    scored AS (SELECT run_id, flag, price, round(guess, 4) AS guess, ea / (ea + en + er) AS pa, en / (ea + en + er) AS pn, er / (ea + en + er) AS pr,
                      CASE WHEN za >= zn AND za >= zr THEN 'A' WHEN zn >= zr THEN 'N' ELSE 'R' END AS label FROM powers)"""


@query("M16_batch_predict", f"""
    WITH {_chain("later")},
    listed AS (SELECT *, list_sort([{{'m': -pa, 'c': 'A'}}, {{'m': -pn, 'c': 'N'}}, {{'m': -pr, 'c': 'R'}}]) AS t FROM scored)
    SELECT run_id, label AS predicted_label, round(greatest(pa, pn, pr), 4) AS confidence,
           array_to_string([x.c || ' ' || printf('%.4f', round(-x.m, 4)) FOR x IN t], ', ') AS top FROM listed
""")
def batch_predict(spark, sf):
    found = serving.predict(reloaded(spark, sf, "classification"), order_lines(spark, sf, later=True), ["run_id", "features"])
    top = F.transform("top", lambda x: F.concat_ws(" ", x["class"], F.format_string("%.4f", x["probability"])))
    return found.select("run_id", "predicted_label", "confidence", F.array_join(top, ", ").alias("top"))


@query("M16_batch_predict_regression", f"WITH {_chain('later')} SELECT run_id, guess AS prediction FROM scored")
def batch_predict_regression(spark, sf):
    return serving.predict(reloaded(spark, sf, "regression"), order_lines(spark, sf, later=True), ["run_id"]).select("run_id", "prediction")


EXPORT_SQL = f"""
    WITH {_chain("later")}
    SELECT run_id, label AS prediction, round(greatest(pa, pn, pr), 4) AS confidence, round(pa, 4) AS prob_A, round(pn, 4) AS prob_N,
           round(pr, 4) AS prob_R FROM scored
"""


def exported(spark, sf):
    model = reloaded(spark, sf, "classification")
    return serving.predict(model, order_lines(spark, sf, later=True), ["run_id"]), model.stages[-1].getOrDefault("classes")


@query("S11_export_predictions_wide", EXPORT_SQL)
def export_predictions_wide(spark, sf):
    found, classes = exported(spark, sf)
    path = scratch_path(spark, "export")
    writers.write_csv_bom(writers.predictions_wide(found, ["run_id"], "predicted_label", "probs", classes), path)
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


@query("S12_export_predictions_json", EXPORT_SQL)
def export_predictions_json(spark, sf):
    found, classes = exported(spark, sf)
    path = scratch_path(spark, "export")
    writers.predictions_json(found, ["run_id"], "predicted_label", "probs", classes).write.text(path)
    shape = "run_id STRING, _prediction STRING, _confidence DOUBLE, _probabilities MAP<STRING, DOUBLE>"
    read = spark.read.schema(shape).json(path)
    return read.select("run_id", F.col("_prediction").alias("prediction"), F.col("_confidence").alias("confidence"),
                       *[F.col("_probabilities")[c].alias(f"prob_{c}") for c in classes])


CLASS_SQL = """
      SELECT 'classification' AS task, {independent} AS independent, num_samples, round(tp / num_samples, 6) AS accuracy,
             round(pw, 6) AS precision_weighted, round(rw, 6) AS recall_weighted, round(fw, 6) AS f1_weighted, round(pm, 6) AS precision_macro,
             round(rm, 6) AS recall_macro, round(fm, 6) AS f1_macro, NULL::DOUBLE AS mse, NULL::DOUBLE AS mae, NULL::DOUBLE AS rmse, NULL::DOUBLE AS r2
      FROM (
        SELECT sum(n) AS num_samples, sum(tp) AS tp, sum(p * n) / sum(n) AS pw, sum(r * n) / sum(n) AS rw, sum(f * n) / sum(n) AS fw,
               avg(p) AS pm, avg(r) AS rm, avg(f) AS fm
        FROM (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM (
          SELECT c, tp, n, CASE WHEN g > 0 THEN tp / g ELSE 0 END AS p, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS r FROM (
            SELECT c, count(*) FILTER (flag = c AND label = c) AS tp, count(*) FILTER (flag = c) AS n, count(*) FILTER (label = c) AS g
            FROM scored, (SELECT DISTINCT flag AS c FROM scored UNION SELECT label FROM scored) GROUP BY c))))"""
NUMBER_SQL = """
      SELECT 'regression' AS task, {independent} AS independent, count(*) AS num_samples, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
             round(avg((price - guess) * (price - guess)), 6) AS mse, round(avg(abs(price - guess)), 6) AS mae,
             round(sqrt(avg((price - guess) * (price - guess))), 6) AS rmse,
             round(1 - avg((price - guess) * (price - guess)) / var_pop(price), 6) AS r2 FROM scored"""


def _report(name: str, independent: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM (WITH {_chain(name)} {part.format(independent=independent)})" for part in (CLASS_SQL, NUMBER_SQL))


@query("E01_evaluate", _report("train", "false") + " UNION ALL " + _report("later", "true"))
def evaluate(spark, sf):
    """Saved pipelines of both tasks on the rows they were fitted on and on another set."""
    measures = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "precision_macro", "recall_macro", "f1_macro",
                "mse", "mae", "rmse", "r2"]
    out = []
    for task, target in (("classification", "flag"), ("regression", "price")):
        model = reloaded(spark, sf, task)
        for independent in (False, True):
            found = serving.evaluate(model, order_lines(spark, sf, later=independent), target, independent)
            out.append(found.select(F.lit(task).alias("task"), "independent", "num_samples", *[
                F.round(m, 6).alias(m) if m in found.columns else F.lit(None).cast("double").alias(m) for m in measures]))
    return union_all(out)


@query("M18_feature_importance")
def feature_importance(spark, sf):
    train, _ = halves(vectors(spark, sf))
    model = op.make("random_forest", 10, numTrees=5, maxDepth=4).fit(train)
    return op.feature_importance(model, [f"e{i}" for i in range(64)], spark)


@query("L03_importance_ranking")
def importance_ranking(spark, sf):
    train, _ = halves(vectors(spark, sf))
    return op.feature_importance(op.make("logistic_regression", 10, maxIter=10).fit(train), [f"e{i}" for i in range(64)], spark)


@query("M19_smoke_predictions")
def smoke_predictions(spark, sf):
    """Probe texts through a saved text model, with the accuracy of the probes."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "text", F.when(F.col("quality") == 1, "high").otherwise("low").alias("label"))
    model = serving.fit_text(cut_lineage(docs, "texts"), "text", "label", op.make("logistic_regression", maxIter=20, regParam=0.01), MAX_FEATURES)
    path = scratch_path(spark, "pipeline")
    serving.save(model, path, spark)
    probes = table(spark, sf, "benchmark").select("item_id", "text", F.lit("high").alias("label"))
    shown = serving.predict(serving.load(path), probes, ["item_id", "label"]).select("item_id", "label", "predicted_label", "confidence")
    accuracy = shown.agg(F.avg((F.col("label") == F.col("predicted_label")).cast("double"))).scalar()
    return shown.withColumn("probe_accuracy", accuracy)
