"""Aggregations: distributions, totals, metrics and curve statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators import knn
from tallyloom.operators.ordered import ranked, with_row

MAX_CLASSES = 5000


def count_by(df: DataFrame, by: str, skip_null: bool = False) -> DataFrame:
    src = df.filter(F.col(by).isNotNull()) if skip_null else df
    return src.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def n_where(rule: Column) -> Column:
    return F.coalesce(F.sum(F.when(rule, 1).otherwise(0)), F.lit(0))


def totals(df: DataFrame, size: str, public: str) -> DataFrame:
    total = F.coalesce(F.sum(size), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("total_count"), total.alias("total_size"),
                  F.round(total / F.lit(1024.0 ** 3), 2).alias("total_gb"),
                  n_where(F.col(public)).alias("public_count"))


def registry_totals(df: DataFrame, public: str, deployed: Column, metric: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), n_where(F.col(public)).alias("public_count"),
                  n_where(~F.col(public)).alias("private_count"), n_where(deployed).alias("deployed"),
                  F.avg(metric).alias("avg_metric"), F.max(metric).alias("max_metric"))


def job_totals(df: DataFrame, status: str, statuses: Sequence[str], active: Sequence[str],
               done: str, start: str, end: str) -> DataFrame:
    """One row: count per status, active jobs, mean seconds of finished jobs
    that have both timestamps."""
    secs = F.timestamp_diff("SECOND", F.col(start), F.col(end))
    s = F.col(status)
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[n_where(s == v).alias(f"n_{v.lower()}") for v in statuses],
                  n_where(s.isin(*active)).alias("active"),
                  F.round(F.avg(F.when((s == done) & F.col(start).isNotNull() & F.col(end).isNotNull(),
                                       secs)), 1).alias("avg_seconds"))


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and percent per label, most common first."""
    counts = count_by(df, label)
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total).orderBy(F.desc("n"), label)


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """Largest over smallest class; infinite with a single class."""
    return count_by(df, label).agg(
        F.when(F.count(F.lit(1)) < 2, float("inf")).otherwise(F.max("n") / F.min("n"))
        .alias("imbalance_ratio"))


def length_stats(df: DataFrame, text: str, short: int = 10, long: int = 500) -> DataFrame:
    """Shortest, longest, mean, upper median and the short / long counts.

    Lengths are counted first; the median is the (n div 2)-th of that histogram.
    """
    hist = df.groupBy(F.length(text).alias("len")).agg(F.count(F.lit(1)).alias("n"))
    upto = W.orderBy("len").rowsBetween(W.unboundedPreceding, 0)  # over distinct lengths only
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    seen = hist.select("len", "n", F.sum("n").over(upto).alias("cum"), total.alias("total"))
    return seen.agg(
        F.sum("n").alias("total"), F.min("len").alias("min_length"), F.max("len").alias("max_length"),
        (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("avg_length"),
        F.min(F.when(F.col("cum") > F.floor(F.col("total") / 2), F.col("len"))).alias("median_length"),
        F.sum(F.when(F.col("len") < short, F.col("n")).otherwise(0)).alias("short_count"),
        F.sum(F.when(F.col("len") > long, F.col("n")).otherwise(0)).alias("long_count"))


def duplicate_count(df: DataFrame, text: str) -> DataFrame:
    """Extra copies by content hash; copies are combined before the shuffle."""
    copies = df.groupBy(F.md5(text).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def quality_report(df: DataFrame, text: str, label: str) -> DataFrame:
    """One row of text statistics and the issues they raise."""
    row = with_row(with_row(length_stats(df, text), imbalance_ratio(df, label)), duplicate_count(df, text))
    issues = F.array_compact(F.array(
        F.when(F.col("imbalance_ratio") > 3, "class_imbalance"),
        F.when(F.col("short_count") > F.col("total") * 0.1, "too_many_short"),
        F.when(F.col("duplicates") > F.col("total") * 0.05, "many_duplicates"),
        F.when(F.col("total") < 2000, "small_dataset")))
    return row.withColumn("issues", issues)


# --------------------------------------------------------- classification

def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[str] | None = None) -> DataFrame:
    """(actual, predicted, n) for the pairs seen; with `labels`, also the pairs of these that are not."""
    counts = (df.select(F.col(actual).cast("string").alias("actual"), F.col(predicted).cast("string").alias("predicted"))
              .groupBy("actual", "predicted").agg(F.count(F.lit(1)).alias("n")))
    if labels is None:
        return counts
    zeros = df.sparkSession.createDataFrame([(a, b, 0) for a in labels for b in labels], "actual string, predicted string, n bigint")
    return counts.unionByName(zeros).groupBy("actual", "predicted").agg(F.sum("n").alias("n"))


def per_class_report(matrix: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) of every label on either side of a
    confusion matrix; a zero denominator gives 0."""
    n, hit = F.col("n"), F.col("actual") == F.col("predicted")
    rows = matrix.groupBy(F.col("actual").alias("label")).agg(
        F.sum(n).alias("support"), F.sum(F.when(hit, n).otherwise(0)).alias("tp"))
    cols = matrix.groupBy(F.col("predicted").alias("label")).agg(F.sum(n).alias("guessed"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    both = rows.join(cols, "label", "full_outer").fillna(0, ["support", "tp", "guessed"]) \
        .withColumn("precision", ratio(F.col("tp"), F.col("guessed"))) \
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
    p, r = F.col("precision"), F.col("recall")
    return both.select("label", "precision", "recall", ratio(2 * p * r, p + r).alias("f1"), "support", "tp")


def classification_metrics(matrix: DataFrame) -> DataFrame:
    """One row: accuracy and weighted / macro precision, recall, F1."""
    s, total = F.col("support"), F.sum("support")
    out = [(F.sum("tp") / total).alias("accuracy")]
    for m in ("precision", "recall", "f1"):
        out += [(F.sum(F.col(m) * s) / total).alias(f"{m}_weighted"), F.avg(m).alias(f"{m}_macro")]
    return per_class_report(matrix).agg(*out)


# ------------------------------------------------------------- regression

def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    e = F.col(actual) - F.col(predicted)
    mse = F.avg(e * e)
    return df.agg(mse.alias("mse"), F.avg(F.abs(e)).alias("mae"), F.sqrt(mse).alias("rmse"),
                  (1 - mse / F.var_pop(actual)).alias("r2"))


def residual_shape(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Population skew and kurtosis (normal = 3) of the residuals, RMSE / MAE."""
    e = F.col(actual) - F.col(predicted)
    return df.agg(F.skewness(e).alias("residual_skew"), (F.kurtosis(e) + 3).alias("residual_kurtosis"),
                  (F.sqrt(F.avg(e * e)) / F.avg(F.abs(e))).alias("rmse_mae_ratio"))


# ------------------------------------------------------------- clustering

def centroids(df: DataFrame, vec: str, label: str) -> DataFrame:
    v = array_to_vector(F.transform(F.col(vec), lambda x: x.cast("double")))
    return (df.select(label, v.alias("__v")).groupBy(label)
            .agg(Summarizer.mean(F.col("__v")).alias("c"), F.count(F.lit(1)).alias("n"))
            .select(label, vector_to_array("c").alias("c"), "n"))


def cluster_metrics(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """One row: silhouette, Davies-Bouldin, Calinski-Harabasz and inertia.

    The k centroids come to the driver (k is checked); rows never do. The
    silhouette is that of squared distances, linear in the rows.
    """
    spark = df.sparkSession
    found = centroids(df, vec, label).orderBy(label).limit(MAX_CLASSES + 1).collect()
    k, n = len(found), sum(r["n"] for r in found)
    if not 2 <= k < n or k > MAX_CLASSES:
        raise ValueError(f"cluster metrics need 2 <= k < n and k <= {MAX_CLASSES}; k={k}, n={n}")
    mids = np.array([r["c"] for r in found])
    sizes = np.array([r["n"] for r in found], dtype=float)
    table = spark.sparkContext.broadcast({str(r[label]): i for i, r in enumerate(found)})
    shared = spark.sparkContext.broadcast(mids)

    def to_centre(batches):
        for pdf in batches:
            if len(pdf):
                at = pdf["label"].astype(str).map(table.value).to_numpy()
                d2 = ((knn.matrix(pdf["v"]) - shared.value[at]) ** 2).sum(1)
                yield pd.DataFrame({"c": at, "d": np.sqrt(d2), "d2": d2})

    rows = df.select(F.transform(F.col(vec), lambda x: x.cast("double")).alias("v"),
                     F.col(label).cast("string").alias("label"))
    spread = {r["c"]: r for r in rows.mapInPandas(to_centre, "c int, d double, d2 double")
              .groupBy("c").agg(F.avg("d").alias("s"), F.sum("d2").alias("w")).collect()}
    s = np.array([spread[i]["s"] for i in range(k)])
    within = sum(spread[i]["w"] for i in range(k))
    gaps = knn.distances(mids, mids)
    np.fill_diagonal(gaps, np.inf)
    db = float(np.mean(np.max((s[:, None] + s[None, :]) / gaps, axis=1)))
    middle = (mids * sizes[:, None]).sum(0) / n
    between = float((sizes * ((mids - middle) ** 2).sum(1)).sum())
    ch = (between / (k - 1)) / (within / (n - k))
    return silhouette(df, key, vec, label).agg(F.avg("silhouette").alias("silhouette")).select(
        "silhouette", F.lit(db).alias("davies_bouldin"), F.lit(float(ch)).alias("calinski_harabasz"),
        F.lit(float(within)).alias("inertia"))


def silhouette(df: DataFrame, key: str, vec: str, label: str) -> DataFrame:
    """(id, label, silhouette) with squared Euclidean distances over all rows.

    The mean squared distance from a row to a cluster follows from the cluster's
    size, mean and mean squared length, so one pass over the rows is enough and
    only k such facts come to the driver (k is checked)."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    rows = df.select(F.col(key).alias("id"), F.col(label).cast("string").alias("label"), v.alias("v"))
    facts = centroids(rows, "v", "label").join(rows.groupBy("label").agg(F.avg(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x)).alias("q")), "label").orderBy("label").limit(MAX_CLASSES + 1).collect()
    if not 2 <= len(facts) <= MAX_CLASSES:
        raise ValueError(f"a silhouette needs 2 to {MAX_CLASSES} clusters")
    shared = df.sparkSession.sparkContext.broadcast((
        {r["label"]: i for i, r in enumerate(facts)}, np.array([r["c"] for r in facts]),
        np.array([r["n"] for r in facts], dtype=float), np.array([r["q"] for r in facts])))

    def judge(batches):
        place, mids, sizes, square = shared.value
        for pdf in batches:
            if not len(pdf):
                continue
            x, at = knn.matrix(pdf["v"]), pdf["label"].map(place).to_numpy()
            far = np.maximum((x * x).sum(1)[:, None] - 2 * x @ mids.T + square[None, :], 0.0)
            line = np.arange(len(x))
            alone = sizes[at] < 2
            a = far[line, at] * sizes[at] / np.where(alone, 1.0, sizes[at] - 1)
            far[line, at] = np.inf
            b = far.min(1)
            top = np.maximum(a, b)
            yield pd.DataFrame({"id": pdf["id"], "label": pdf["label"],
                                "silhouette": np.where(alone | (top == 0), 0.0, (b - a) / np.where(top == 0, 1.0, top))})

    return rows.mapInPandas(judge, f"id {rows.schema['id'].dataType.simpleString()}, label string, silhouette double")


def external_cluster_metrics(df: DataFrame, truth: str, found: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information from the contingency."""
    cell = df.groupBy(truth, found).agg(F.count(F.lit(1)).alias("n"))
    choose = lambda c: c * (c - 1) / 2.0
    info = lambda c: -F.sum(c / F.col("t") * F.log(c / F.col("t")))
    total = df.agg(F.count(F.lit(1))).scalar()
    side = lambda by: cell.groupBy(by).agg(F.sum("n").alias("m")).withColumn("t", total.cast("double")) \
        .agg(F.sum(choose(F.col("m"))).alias("pairs"), info(F.col("m")).alias("h"))
    a = cell.groupBy(truth).agg(F.sum("n").alias("na")).withColumnRenamed(truth, "__a")
    b = cell.groupBy(found).agg(F.sum("n").alias("nb")).withColumnRenamed(found, "__b")
    full = cell.join(a, F.col(truth).eqNullSafe(F.col("__a"))).join(b, F.col(found).eqNullSafe(F.col("__b"))) \
        .withColumn("t", total.cast("double"))
    joint = full.agg(F.sum(choose(F.col("n"))).alias("both"), F.first("t").alias("t"),
                     F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t")
                                                         / (F.col("na").cast("double") * F.col("nb")))).alias("mi"))
    rows, cols = side(truth), side(found)
    one = joint.withColumn("ra", rows.select("pairs").scalar()).withColumn("ha", rows.select("h").scalar()) \
        .withColumn("rb", cols.select("pairs").scalar()).withColumn("hb", cols.select("h").scalar())
    expected = F.col("ra") * F.col("rb") / choose(F.col("t"))
    mean_h = (F.col("ha") + F.col("hb")) / 2
    return one.select(
        F.when((F.col("ra") + F.col("rb")) / 2 == expected, 1.0)
        .otherwise((F.col("both") - expected) / ((F.col("ra") + F.col("rb")) / 2 - expected)).alias("adjusted_rand"),
        F.when(mean_h == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.col("mi")) / mean_h).alias("normalised_mutual_info"))


def cluster_balance(df: DataFrame, label: str, noise=-1) -> DataFrame:
    """Smallest over largest cluster and the share of noise rows."""
    counts = count_by(df, label)
    real = F.col(label) != F.lit(noise)
    return counts.agg((F.min(F.when(real, F.col("n"))) / F.max(F.when(real, F.col("n")))).alias("balance_ratio"),
                      (F.sum(F.when(real, 0).otherwise(F.col("n"))) / F.sum("n")).alias("noise_ratio"),
                      n_where(real).alias("n_clusters"))


# ------------------------------------------------------------- run curves

def fold_summary(df: DataFrame, run: str, score: str) -> DataFrame:
    return df.groupBy(run).agg(F.avg(score).alias("cv_mean"), F.stddev_pop(score).alias("cv_std"),
                               F.count(score).alias("n_folds"))


def loss_curve(df: DataFrame, run: str, order: str, loss: str, ties: Sequence[str] = ()) -> DataFrame:
    """Shape of each run's loss: variation, slope, early and late means, flags."""
    r = ranked(df.filter(F.col(loss).isNotNull()), [run], order, ties, total="__n")
    x = F.col(loss)
    g = r.groupBy(run).agg(
        F.max("__n").alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd"),
        F.regr_slope(x, (F.col("rn") - 1).cast("double")).alias("slope"),
        F.avg(F.when(F.col("rn") <= 3, x)).alias("early"),
        F.avg(F.when(F.col("rn") > F.col("__n") - 3, x)).alias("late"))
    known = (F.col("n") >= 3) & (F.col("mean") > 0)
    cv = F.when(known, F.col("sd") / F.col("mean")).otherwise(0.0)
    flag = lambda c: F.when(known, c).otherwise(False)
    diverging = flag(F.col("late") > F.col("early") * 1.5)
    return g.select(
        run, "n", cv.alias("cv"), F.when(known, F.col("slope")).alias("slope"),
        F.when(known, F.col("early")).alias("early_mean"), F.when(known, F.col("late")).alias("late_mean"),
        flag(cv > 0.25).alias("oscillating"), diverging.alias("diverging"),
        flag((F.col("late") > F.col("early") * 0.7) & ~diverging).alias("slow_convergence"),
        flag((F.col("late") < F.col("early") * 0.3) & (cv < 0.12)).alias("converged_well"),
        F.when(~known, "unknown").when(diverging, "diverging").when(F.col("slope") < -0.01, "converging")
        .when(F.abs(F.col("slope")) < 0.01, "flat").otherwise("increasing").alias("trend"))


def range_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations): rows for which a declared rule is false, in one pass."""
    row = df.agg(*[n_where(~rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    cells = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("violations"))
                      for i, name in enumerate(rules)])
    return row.select(F.explode(cells).alias("c")).select("c.*")


def inverse_frequency_weights(df: DataFrame, label: str, threshold: float = 3.0) -> DataFrame:
    """(label, n, weight): n/(k·count), or 1 when the classes are close enough."""
    counts = count_by(df, label)
    w = W.partitionBy(F.lit(0))  # over the class counts only
    raw = F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n"))
    both = counts.withColumn("raw", raw)
    lo, hi = F.min("raw").over(w), F.max("raw").over(w)
    return both.select(label, "n", F.when(hi / F.greatest(lo, F.lit(1.0)) > threshold, F.col("raw"))
                       .otherwise(1.0).alias("weight"))


def dashboard_rollup(df: DataFrame, dimensions: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Every single-dimension rollup and the grand total from one scan."""
    sets = [[F.col(d)] for d in dimensions] + [[]]
    return df.groupingSets(sets, *dimensions).agg(
        F.grouping_id(*dimensions).alias("level"), *[c.alias(k) for k, c in measures.items()])
