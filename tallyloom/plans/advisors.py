"""Bindings for rule-based advice on profiles and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import advisors as op, profile, stats
from tallyloom.plans.aggregates import CURVE_SQL
from tallyloom.plans.registry import RUNS_SQL, query, runs, sql_round, table
from tallyloom.sources.readers import union_all

LINE_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def corr_sql(table_name, cols):
    pairs = [f"abs(corr({a}, {b}))" for i, a in enumerate(cols) for b in cols[i + 1:]]
    high = " + ".join(f"({p} > 0.85 AND {p} < 1)::INT" for p in pairs)
    return f"({high})::BIGINT AS high_corr_pairs, round(({' + '.join(pairs)}) / {len(pairs)}, 4) AS avg_correlation FROM {table_name}"


@query("R01_dataset_profile", f"""
    WITH l AS (SELECT 'lineitem' AS table_name, count(*) AS n_samples, 11 AS n_features, 0.0::DOUBLE AS missing_rate, 'categorical' AS target_type,
      (SELECT count(DISTINCT l_returnflag) FROM lineitem) AS n_classes, (SELECT round(min(c)::DOUBLE / max(c), 4) FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag)) AS class_balance,
      8 AS numeric_cols, 2 AS categorical_cols, 0 AS text_column_count, FALSE AS text_heavy, FALSE AS wide_data, FALSE AS high_dim, {corr_sql("lineitem", LINE_NUM)}),
    c AS (SELECT 'customer', count(*), 5, 0.0::DOUBLE, 'continuous', 0, 1.0::DOUBLE, 3, 2, 1, TRUE, FALSE, FALSE, {corr_sql("customer", ["c_custkey", "c_nationkey", "c_acctbal"])}),
    b AS (SELECT 'labels', count(*), 3, 0.0::DOUBLE, 'categorical', count(DISTINCT toxic), (SELECT round(min(n)::DOUBLE / max(n), 4) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic)),
      3, 0, 0, FALSE, FALSE, FALSE, {corr_sql("labels", ["doc_id", "quality", "toxic"])})
    SELECT * FROM l UNION ALL SELECT * FROM c UNION ALL SELECT * FROM b
""")
def dataset_profile(spark, sf):
    out = []
    for name, target in (("lineitem", "l_returnflag"), ("customer", "c_acctbal"), ("labels", "toxic")):
        row = profile.dataset_profile(table(spark, sf, name), target)
        out.append(row.select(F.lit(name).alias("table_name"), "n_samples", "n_features", "missing_rate", "target_type", "n_classes", "class_balance",
                              "numeric_cols", "categorical_cols", "text_column_count", "text_heavy", "wide_data", "high_dim",
                              F.col("high_corr_pairs").cast("long").alias("high_corr_pairs"), "avg_correlation"))
    return union_all(out)


PROFILE_SQL = """
    p AS (SELECT l_partkey AS dataset_id, count(*) * count(*) * (sum(l_linenumber) % 13) AS n_samples, sum(l_linenumber)::BIGINT * 3 % 260 + 1 AS n_features,
      max(l_tax) * 3 AS missing_rate, count(*) FILTER (l_discount > 0.07) AS high_corr_pairs, min(l_discount) + max(l_discount) * 2 AS avg_correlation,
      min(l_quantity) < 3 AS imbalanced, CASE WHEN max(l_quantity) > 49 THEN 'continuous' ELSE 'categorical' END AS target_type,
      count(DISTINCT l_returnflag) AS n_classes, sum(l_linenumber) % 11 = 0 AS text_heavy FROM lineitem GROUP BY 1),
    prof AS (SELECT *, n_features > n_samples AS wide_data, n_features > 100 AS high_dim FROM p)
"""


def profiles(spark, sf):
    """One profile row per dataset, derived from its runs (same as PROFILE_SQL)."""
    n, s = F.count(F.lit(1)), F.sum("l_linenumber")
    p = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("dataset_id")).agg(
        (n * n * (s % 13)).alias("n_samples"), (s * 3 % 260 + 1).alias("n_features"), (F.max("l_tax") * 3).alias("missing_rate"),
        F.sum(F.when(F.col("l_discount") > 0.07, 1).otherwise(0)).alias("high_corr_pairs"),
        (F.min("l_discount") + F.max("l_discount") * 2).alias("avg_correlation"), (F.min("l_quantity") < 3).alias("imbalanced"),
        F.when(F.max("l_quantity") > 49, "continuous").otherwise("categorical").alias("target_type"),
        F.countDistinct("l_returnflag").alias("n_classes"), (s % 11 == 0).alias("text_heavy"))
    return p.withColumn("wide_data", F.col("n_features") > F.col("n_samples")).withColumn("high_dim", F.col("n_features") > 100)


@query("R02_recommend_task", f"""
    WITH {PROFILE_SQL}
    SELECT dataset_id, CASE WHEN text_heavy THEN 'nlp' WHEN target_type = 'continuous' THEN 'regression' ELSE 'classification' END AS task,
      CASE WHEN text_heavy THEN 0.85 WHEN target_type = 'continuous' THEN 0.90 WHEN n_classes = 2 THEN 0.92 ELSE 0.90 END::DOUBLE AS confidence FROM prof
""")
def recommend_task(spark, sf):
    c = F.col
    task, conf = op.recommend_task(c("text_heavy"), c("target_type"), c("n_classes"))
    return profiles(spark, sf).select("dataset_id", task.alias("task"), conf.alias("confidence"))


@query("R03_recommend_algorithms", f"""
    WITH {PROFILE_SQL}
    SELECT dataset_id, CASE WHEN text_heavy THEN 'transformer_bert:0.95,tfidf_logistic:0.7,tfidf_svm:0.65' WHEN high_dim AND n_features > 200 THEN 'mlp:0.88,random_forest:0.55'
      WHEN target_type = 'continuous' AND n_samples > 5000 THEN 'gradient_boosting_regressor:0.88,random_forest_regressor:0.82,ridge:0.7,mlp:0.65'
      WHEN target_type = 'continuous' THEN 'ridge:0.85,random_forest_regressor:0.75,knn_regressor:0.6' WHEN n_samples > 5000 AND NOT imbalanced THEN 'random_forest:0.9,gradient_boosting:0.87,mlp:0.72'
      WHEN imbalanced THEN 'random_forest:0.88,gradient_boosting:0.82' WHEN n_samples < 1000 THEN 'svm:0.82,logistic_regression:0.78' ELSE 'random_forest:0.88,svm:0.75,knn:0.65' END AS algorithms FROM prof
""")
def recommend_algorithms(spark, sf):
    c = F.col
    key = op.advice_key(c("text_heavy"), c("high_dim"), c("n_features"), c("target_type"), c("n_samples"), c("imbalanced"))
    listed = F.transform(op.recommend_algorithms(key), lambda a: F.concat(a["algorithm"], F.lit(":"), a["confidence"].cast("string")))
    return profiles(spark, sf).select("dataset_id", F.array_join(listed, ",").alias("algorithms"))


@query("R05_category_task_map", f"""
    WITH {PROFILE_SQL},
    c AS (SELECT dataset_id, target_type, CASE p_type WHEN 'PROMO' THEN 'nlp' WHEN 'SMALL' THEN 'clustering' WHEN 'LARGE' THEN 'time_series' WHEN 'ECONOMY' THEN 'regression' ELSE 'tabular' END AS category,
      p_size > 40 AS latent FROM prof JOIN part ON p_partkey = dataset_id)
    SELECT dataset_id, CASE category WHEN 'nlp' THEN 'classification' WHEN 'clustering' THEN 'clustering' WHEN 'regression' THEN 'regression' ELSE
      CASE target_type WHEN 'continuous' THEN 'regression' ELSE 'classification' END END AS task,
      CASE category WHEN 'nlp' THEN 'text_needs_text_features' WHEN 'time_series' THEN 'random_split_breaks_order' ELSE CASE WHEN latent THEN 'latent_columns' END END AS warning FROM c
""")
def category_task_map(spark, sf):
    names = {"PROMO": "nlp", "SMALL": "clustering", "LARGE": "time_series", "ECONOMY": "regression"}
    cat = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("p_type")], F.lit("tabular"))
    share = F.when(F.col("p_size") > 40, 0.9).otherwise(0.1)
    task, warning = op.category_task(cat, F.col("target_type"), share)
    joined = profiles(spark, sf).join(table(spark, sf, "part"), F.col("p_partkey") == F.col("dataset_id"))
    return joined.select("dataset_id", task.alias("task"), warning.alias("warning"))


SIGNAL_SQL = """
    sc AS (SELECT *, n_features / greatest(n_samples, 1) AS ratio FROM prof),
    sd AS (SELECT *, greatest(0.05::DOUBLE, least(0.98::DOUBLE, 0.70::DOUBLE - CASE WHEN ratio > 0.5 THEN 0.25::DOUBLE WHEN ratio > 0.1 THEN 0.10 ELSE 0 END - CASE WHEN wide_data THEN 0.30::DOUBLE ELSE 0 END
      - CASE WHEN missing_rate > 0.2 THEN 0.25::DOUBLE WHEN missing_rate > 0.08 THEN 0.10 ELSE 0 END - CASE WHEN high_corr_pairs > 10 THEN 0.10::DOUBLE WHEN high_corr_pairs > 3 THEN 0.05 ELSE 0 END
      - CASE WHEN imbalanced THEN 0.08::DOUBLE ELSE 0 END + CASE WHEN avg_correlation BETWEEN 0.12 AND 0.35 THEN 0.08::DOUBLE ELSE 0 END)) AS score FROM sc),
    sig AS (SELECT *, CASE WHEN score >= 0.70::DOUBLE THEN 'strong' WHEN score >= 0.45::DOUBLE THEN 'moderate' WHEN score >= 0.25::DOUBLE THEN 'weak' ELSE 'noise' END AS level FROM sd)
"""


def signals(spark, sf):
    c = F.col
    s = op.signal_quality(c("n_samples"), c("n_features"), c("avg_correlation"), c("high_corr_pairs"), c("missing_rate"), c("imbalanced"), c("wide_data"))
    return profiles(spark, sf).withColumns(s)


@query("R06_signal_quality", f"""
    WITH {PROFILE_SQL}, {SIGNAL_SQL}
    SELECT dataset_id, {sql_round("score", 3)} AS score, level, {sql_round("ratio", 4)} AS ratio, {sql_round("1.0::DOUBLE + (1.0::DOUBLE - score) * 3.0::DOUBLE", 2)} AS regularization_bias,
      concat_ws(',', CASE WHEN ratio > 0.5 THEN 'ratio_high' WHEN ratio > 0.1 THEN 'ratio_raised' END, CASE WHEN wide_data THEN 'wide' END,
        CASE WHEN missing_rate > 0.2 THEN 'missing_high' WHEN missing_rate > 0.08 THEN 'missing_raised' END, CASE WHEN high_corr_pairs > 10 THEN 'collinear' END, CASE WHEN imbalanced THEN 'imbalanced' END) AS issues FROM sig
""")
def signal_quality(spark, sf):
    return signals(spark, sf).select("dataset_id", "score", "level", "ratio", "regularization_bias", F.array_join("issues", ",").alias("issues"))


@query("R09_root_cause", f"""
    WITH {RUNS_SQL}, {PROFILE_SQL}, {SIGNAL_SQL},
    r AS (SELECT run_id, task, acc - 0.45 AS s, train_acc - 0.35 AS t, CASE task WHEN 'regression' THEN 0.3 WHEN 'clustering' THEN 0.25 ELSE 0.55 END::DOUBLE AS low, level, {sql_round("score", 3)} AS score
      FROM runs JOIN sig USING (dataset_id))
    SELECT run_id, CASE WHEN level IN ('weak', 'noise') AND s < low THEN 'data' WHEN s < low * 0.6::DOUBLE THEN 'algorithm' WHEN abs(t - s) > 0.15 OR s < low THEN 'parameter' ELSE 'unknown' END AS root_cause,
      {sql_round("CASE WHEN level IN ('weak', 'noise') AND s < low THEN least(0.95::DOUBLE, 0.75::DOUBLE + (1.0::DOUBLE - score) * 0.2::DOUBLE) WHEN s < low * 0.6::DOUBLE THEN 0.65 WHEN abs(t - s) > 0.15 THEN 0.72 WHEN s < low THEN 0.55 ELSE 0.4 END", 2)} AS confidence FROM r
""")
def root_cause(spark, sf):
    sig = signals(spark, sf).select(F.col("dataset_id").alias("__d"), "score", "level")
    df = runs(spark, sf).join(sig, F.col("dataset_id") == F.col("__d"))
    cause, conf = op.root_cause(F.col("task"), F.col("acc") - 0.45, F.col("train_acc") - 0.35, F.col("level"), F.col("score"))
    return df.select("run_id", cause.alias("root_cause"), conf.alias("confidence"))


SCORES_SQL = f"""
    {RUNS_SQL},
    m AS (SELECT *, CASE WHEN task = 'regression' THEN ind_acc END AS r2, CASE WHEN task = 'clustering' THEN round(acc - 0.5, 4) END AS sil,
      CASE WHEN task = 'classification' THEN acc WHEN task = 'regression' THEN ind_acc END AS test FROM runs),
    a1 AS (SELECT *, CASE WHEN acc >= 0.98 THEN 78 + (acc - 0.98) / 0.02::DOUBLE * 2 WHEN acc >= 0.95 THEN 68 + (acc - 0.95) / 0.03::DOUBLE * 10 WHEN acc >= 0.88 THEN 55 + (acc - 0.88) / 0.07::DOUBLE * 13
        WHEN acc >= 0.80 THEN 40 + (acc - 0.80) / 0.08::DOUBLE * 15 WHEN acc >= 0.7 THEN 25 + (acc - 0.7) / 0.1::DOUBLE * 15 ELSE 0 END AS base,
      CASE WHEN coalesce(f1, 0) <= 0 THEN 0 WHEN f1 >= 0.95 THEN 15 WHEN f1 >= 0.85 THEN 10 WHEN f1 >= 0.75 THEN 5 WHEN f1 >= 0.6 THEN 0 WHEN f1 >= 0.45 THEN -5 WHEN f1 >= 0.3 THEN -10 ELSE -15 END AS bonus,
      CASE WHEN r2 >= 0.95 THEN 92 + (r2 - 0.95) / 0.05::DOUBLE * 8 WHEN r2 >= 0.85 THEN 78 + (r2 - 0.85) / 0.10::DOUBLE * 14 WHEN r2 >= 0.7 THEN 60 + (r2 - 0.7) / 0.15::DOUBLE * 18
        WHEN r2 >= 0.5 THEN 38 + (r2 - 0.5) / 0.2::DOUBLE * 22 WHEN r2 >= 0.25 THEN 18 + (r2 - 0.25) / 0.25::DOUBLE * 20 WHEN r2 >= 0 THEN 5 + r2 / 0.25::DOUBLE * 13 ELSE 0 END AS rs,
      CASE WHEN sil >= 0.7 THEN 88 + (sil - 0.7) / 0.3::DOUBLE * 12 WHEN sil >= 0.5 THEN 65 + (sil - 0.5) / 0.2::DOUBLE * 23 WHEN sil >= 0.3 THEN 38 + (sil - 0.3) / 0.2::DOUBLE * 27 ELSE 15 + (sil - 0.1) / 0.2::DOUBLE * 23 END AS cs FROM m),
    a2 AS (SELECT *, CASE WHEN task = 'classification' THEN {sql_round("greatest(0, least(100, base + bonus))::DOUBLE", 1)} WHEN task = 'regression' AND r2 IS NOT NULL THEN {sql_round("greatest(0, least(100, rs))::DOUBLE", 1)}
        WHEN task = 'clustering' THEN {sql_round("greatest(0, least(100, cs))::DOUBLE", 1)} ELSE 20 END AS absolute FROM a1),
    ov AS (SELECT *, CASE WHEN task = 'clustering' THEN 'none' WHEN test IS NULL THEN CASE WHEN f1 - 0 > 0.25 AND task = 'regression' THEN 'critical' WHEN f1 > 0.15 THEN 'critical' ELSE 'none' END
        WHEN task = 'regression' THEN CASE WHEN train_acc - test > 0.3 THEN 'critical' WHEN train_acc - test > 0.2 THEN 'high' WHEN train_acc - test > 0.1 THEN 'medium' WHEN train_acc - test > 0.05 THEN 'low' ELSE 'none' END
        ELSE CASE WHEN train_acc - test > 0.2 THEN 'critical' WHEN train_acc - test > 0.12 THEN 'high' WHEN train_acc - test > 0.06 THEN 'medium' WHEN train_acc - test > 0.03 THEN 'low' ELSE 'none' END END AS severity FROM a2),
    ov2 AS (SELECT *, CASE severity WHEN 'critical' THEN 10 WHEN 'high' THEN 35 WHEN 'medium' THEN 55 WHEN 'low' THEN 75 ELSE 100 END::DOUBLE AS overfit,
      CASE task WHEN 'classification' THEN CASE WHEN acc >= 0.9 THEN 85 WHEN acc >= 0.78 THEN 73 ELSE 58 END
        WHEN 'regression' THEN CASE WHEN r2 IS NULL THEN 50 WHEN r2 >= 0.85 THEN 85 WHEN r2 >= 0.65 THEN 73 WHEN r2 >= 0.4 THEN 58 WHEN r2 >= 0.1 THEN 40 ELSE 30 END
        ELSE CASE WHEN sil >= 0.6 THEN 85 WHEN sil >= 0.4 THEN 73 WHEN sil >= 0.2 THEN 58 ELSE 40 END END::DOUBLE AS convergence,
      round(greatest(0, least(100, 100.0::DOUBLE - CASE WHEN coalesce(ind_acc, 0) > 0 THEN CASE WHEN abs(acc - ind_acc) > 0.4 THEN 35 WHEN abs(acc - ind_acc) > 0.25 THEN 20 WHEN abs(acc - ind_acc) > 0.15 THEN 10 WHEN abs(acc - ind_acc) > 0.08 THEN 5 ELSE 0 END ELSE 0 END
        - CASE WHEN coalesce(f1, 0) > 0 THEN CASE WHEN acc - f1 > 0.3 THEN 25 WHEN acc - f1 > 0.15 THEN 12 WHEN acc - f1 > 0.08 THEN 5 ELSE 0 END ELSE 0 END)), 1) AS balance,
      round(greatest(0, least(100, 80.0::DOUBLE - CASE task WHEN 'classification' THEN CASE WHEN train_acc - coalesce(test, 0) > 0.15 THEN 30 WHEN train_acc - coalesce(test, 0) > 0.08 THEN 15 WHEN train_acc - coalesce(test, 0) > 0.03 THEN 5 ELSE 0 END
        WHEN 'regression' THEN CASE WHEN train_acc - coalesce(test, 0) > 0.2 THEN 30 WHEN train_acc - coalesce(test, 0) > 0.1 THEN 15 WHEN train_acc - coalesce(test, 0) > 0.05 THEN 5 ELSE 0 END ELSE 0 END
        + CASE WHEN dataset_id % 4 = 0 THEN 0 WHEN dataset_id * 20 / (dataset_id % 4 * 6400) < 1 THEN -15 WHEN dataset_id * 20 / (dataset_id % 4 * 6400) < 5 THEN -5 ELSE 0 END)), 1) AS generalisation FROM ov),
    h AS (SELECT *, greatest(3, least(99, {sql_round("0.0::DOUBLE + absolute * 0.35::DOUBLE + overfit * 0.25::DOUBLE + convergence * 0.2::DOUBLE + balance * 0.1::DOUBLE + generalisation * 0.1::DOUBLE", 1)})) AS health FROM ov2)
"""


def run_scores(spark, sf):
    c = F.col
    df = runs(spark, sf) \
        .withColumn("r2", F.when(c("task") == "regression", c("ind_acc"))) \
        .withColumn("sil", F.when(c("task") == "clustering", F.round(c("acc") - 0.5, 4))) \
        .withColumn("test", F.when(c("task") == "classification", c("acc")).when(c("task") == "regression", c("ind_acc"))) \
        .withColumn("samples", F.when(c("dataset_id") % 4 > 0, c("dataset_id") * 20)).withColumn("units", c("dataset_id") % 4 * 64)
    sev = op.overfit_severity(c("task"), c("train_acc"), c("test"), F.lit(True), c("f1"))
    scored = df.withColumn("absolute", op.absolute_score(c("task"), c("acc"), c("f1"), c("r2"), c("sil"))).withColumn("severity", sev)
    return (scored.withColumn("overfit", op.overfit_score(c("severity")))
            .withColumn("convergence", op.convergence_from_metric(c("task"), c("acc"), c("r2"), c("sil")))
            .withColumn("balance", op.class_balance_score(c("acc"), c("ind_acc"), c("f1"), c("acc")))
            .withColumn("generalisation", op.generalisation_score(c("task"), F.lit(2), c("train_acc"), c("test"),
                                                                  F.coalesce("samples", F.lit(0)), F.when(c("samples") > 0, c("units")).otherwise(0))))


PARTS = {"absolute_perf": "absolute", "overfitting_risk": "overfit", "convergence_quality": "convergence",
         "class_balance": "balance", "generalization": "generalisation"}


@query("R10_absolute_score", f"WITH {SCORES_SQL} SELECT run_id, absolute::DOUBLE AS absolute FROM h")
def absolute_score(spark, sf):
    return run_scores(spark, sf).select("run_id", "absolute")


@query("R11_overfit_score", f"WITH {SCORES_SQL} SELECT run_id, severity, overfit FROM h")
def overfit_score(spark, sf):
    return run_scores(spark, sf).select("run_id", "severity", "overfit")


@query("R12_convergence_score", f"""
    WITH {SCORES_SQL}, {CURVE_SQL},
    s AS (SELECT user_id, 80 - CASE WHEN oscillating THEN CASE WHEN round(cv, 4) > 0.5 THEN 40 WHEN round(cv, 4) > 0.35 THEN 30 WHEN round(cv, 4) > 0.25 THEN 20 ELSE 10 END ELSE 0 END
       - CASE WHEN slow_convergence THEN 15 ELSE 0 END - CASE WHEN diverging THEN 50 ELSE 0 END AS s, converged_well FROM curve)
    SELECT run_id AS id, convergence AS score FROM h
    UNION ALL SELECT 'user-' || user_id, greatest(0, least(100, CASE WHEN converged_well THEN least(100, s + 20) ELSE s END))::DOUBLE FROM s
""")
def convergence_score(spark, sf):
    c = F.col
    curve = stats.loss_curve(table(spark, sf, "events"), "user_id", "ts", "value", ["event_id"])
    score = op.convergence_from_curve(c("cv"), c("oscillating"), c("slow_convergence"), c("diverging"), c("converged_well"))
    return run_scores(spark, sf).select(c("run_id").alias("id"), c("convergence").alias("score")).unionByName(
        curve.select(F.concat(F.lit("user-"), "user_id").alias("id"), score.alias("score")))


@query("R13_balance_generalisation", f"WITH {SCORES_SQL} SELECT run_id, balance, generalisation FROM h")
def balance_generalisation(spark, sf):
    return run_scores(spark, sf).select("run_id", "balance", "generalisation")


@query("R13_residual_cluster_balance", """
    WITH g AS (SELECT l_partkey AS dataset_id, skewness(l_extendedprice) AS dummy, count(*) AS n, count(DISTINCT l_suppkey) AS k, min(l_quantity) / max(l_quantity) AS ratio, max(l_tax) * 4 AS noise,
      max(l_discount) * 20 AS skew, count(*) FILTER (l_discount > 0.05) / 4.0 AS kurt, max(l_quantity) / 20 AS rmse, 1.0 + min(l_tax) AS mae FROM lineitem GROUP BY 1)
    SELECT dataset_id, greatest(0, least(100, 85 - CASE WHEN skew > 1.5 THEN 35 WHEN skew > 1 THEN 20 WHEN skew > 0.5 THEN 10 WHEN skew > 0.25 THEN 5 ELSE 0 END
        - CASE WHEN kurt > 4 THEN 20 WHEN kurt > 3.5 THEN 10 ELSE 0 END - CASE WHEN rmse / mae > 2.5 THEN 15 WHEN rmse / mae > 1.8 THEN 8 ELSE 0 END))::DOUBLE AS residual_balance,
      greatest(0, least(100, CASE WHEN ratio >= 0.7 THEN 95 WHEN ratio >= 0.5 THEN 85 WHEN ratio >= 0.3 THEN 65 WHEN ratio >= 0.15 THEN 40 WHEN ratio >= 0.05 THEN 20 ELSE 8 END
        - CASE WHEN noise > 0.3 THEN 30 WHEN noise > 0.15 THEN 15 WHEN noise > 0.08 THEN 8 ELSE 0 END))::DOUBLE AS cluster_balance FROM g
""")
def residual_cluster_balance(spark, sf):
    g = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("dataset_id")).agg(
        F.countDistinct("l_suppkey").alias("k"), (F.min("l_quantity") / F.max("l_quantity")).alias("ratio"), (F.max("l_tax") * 4).alias("noise"),
        (F.max("l_discount") * 20).alias("skew"), (F.sum(F.when(F.col("l_discount") > 0.05, 1).otherwise(0)) / 4.0).alias("kurt"),
        (F.max("l_quantity") / 20).alias("rmse"), (1.0 + F.min("l_tax")).alias("mae"))
    c = F.col
    return g.select("dataset_id", op.residual_balance_score(c("skew"), c("kurt"), c("rmse"), c("mae")).alias("residual_balance"),
                    op.cluster_balance_score(c("ratio"), c("k"), F.lit(None).cast("double"), c("noise")).alias("cluster_balance"))


@query("R14_health_score", f"""
    WITH {SCORES_SQL}
    SELECT run_id, health::DOUBLE AS health, concat_ws(',', {", ".join(f"CASE WHEN {c} < 45 THEN 'low_{k}:high' WHEN {c} < 65 THEN 'low_{k}:medium' WHEN {c} < 80 THEN 'low_{k}:low' END" for k, c in PARTS.items())}) AS issues FROM h
""")
def health_score(spark, sf):
    parts = {k: F.col(c) for k, c in PARTS.items()}
    return run_scores(spark, sf).select("run_id", op.health_score(parts).alias("health"),
                                        F.array_join(op.health_issues(parts), ",").alias("issues"))


@query("R15_decision_path", f"""
    WITH {CURVE_SQL},
    b AS (SELECT user_id, CASE user_id % 3 WHEN 0 THEN 'classification' WHEN 1 THEN 'regression' ELSE 'clustering' END AS task, arg_min(value, (ts, event_id)) AS f, arg_max(value, (ts, event_id)) AS l,
       avg(value) / 120 AS tr, min(value) / 10 AS te, max(value) / 100000 AS lr, (count(*) % 5 + 1) * 32 AS bs FROM events GROUP BY user_id),
    q AS (SELECT b.*, curve.* EXCLUDE (user_id), CASE task WHEN 'clustering' THEN 'none' WHEN 'regression' THEN CASE WHEN tr - te > 0.3 THEN 'critical' WHEN tr - te > 0.2 THEN 'high' WHEN tr - te > 0.1 THEN 'medium' WHEN tr - te > 0.05 THEN 'low' ELSE 'none' END
       ELSE CASE WHEN tr - te > 0.2 THEN 'critical' WHEN tr - te > 0.12 THEN 'high' WHEN tr - te > 0.06 THEN 'medium' WHEN tr - te > 0.03 THEN 'low' ELSE 'none' END END AS sev,
       CASE task WHEN 'classification' THEN l > 2 WHEN 'regression' THEN l > f * 0.8::DOUBLE AND l > 10 ELSE l > 5 END AS high,
       CASE task WHEN 'classification' THEN tr < 0.55 AND te < 0.55 AND abs(tr - te) < 0.1 AND te > 0 WHEN 'regression' THEN tr < 0.25 AND te < 0.25 AND abs(tr - te) < 0.1 ELSE FALSE END AS under,
       0.001::DOUBLE * (bs / 64) AS want FROM b JOIN curve USING (user_id))
    SELECT user_id, concat_ws(',', CASE WHEN n >= 3 THEN CASE WHEN high THEN 'Q1:YES:high' ELSE 'Q1:NO:none' END END, CASE WHEN sev = 'none' THEN 'Q2:NO:none' ELSE 'Q2:YES:' || sev END,
      CASE WHEN under THEN 'Q3:YES:medium' ELSE 'Q3:NO:none' END, CASE WHEN trend = 'unknown' AND n < 3 THEN 'Q4:SKIP:none' WHEN oscillating THEN 'Q4:YES:medium' WHEN slow_convergence THEN 'Q4:SLOW:low' ELSE 'Q4:NO:none' END,
      CASE WHEN n >= 3 AND lr > want * 3 THEN 'Q5:LR_HIGH:medium' WHEN n >= 3 AND lr < want / 3 THEN 'Q5:LR_LOW:medium' END) AS path FROM q
""")
def decision_path(spark, sf):
    c, ev = F.col, table(spark, sf, "events")
    curve = stats.loss_curve(ev, "user_id", "ts", "value", ["event_id"]).withColumnRenamed("user_id", "__u")
    place = F.struct("ts", "event_id")
    b = ev.groupBy("user_id").agg(F.min_by("value", place).alias("f"), F.max_by("value", place).alias("l"), (F.avg("value") / 120).alias("tr"),
                                  (F.min("value") / 10).alias("te"), (F.max("value") / 100000).alias("lr"), ((F.count(F.lit(1)) % 5 + 1) * 32).alias("bs"))
    b = b.withColumn("task", F.when(c("user_id") % 3 == 0, "classification").when(c("user_id") % 3 == 1, "regression").otherwise("clustering"))
    df = b.join(curve, c("user_id") == c("__u")).withColumn("sev", op.overfit_severity(c("task"), c("tr"), c("te"), F.lit(True), F.lit(None).cast("double")))
    path = op.decision_path(c("task"), c("n"), c("f"), c("l"), c("sev"), c("tr"), c("te"), c("trend"), c("oscillating"), c("slow_convergence"), c("lr"), c("bs"))
    return df.select("user_id", F.array_join(F.transform(path, lambda s: F.concat_ws(":", s["node"], s["answer"], s["severity"])), ",").alias("path"))


@query("R16_anti_patterns", f"""
    WITH {RUNS_SQL}, r AS (SELECT run_id, dataset_id, task, status, acc, f1, day(created) AS epochs FROM runs)
    SELECT run_id, concat_ws(',', CASE WHEN status <> 'trained' AND f1 IS NULL AND epochs < 2 THEN 'no_baseline' END,
      CASE WHEN task = 'classification' AND status = 'trained' AND dataset_id % 2 = 0 THEN 'grid_search_high_dim' END, CASE WHEN f1 IS NOT NULL AND epochs > 10 THEN 'potential_test_leak' END) AS found FROM r
""")
def anti_patterns(spark, sf):
    c = F.col
    small = F.create_map(F.lit("algorithm"), F.lit("x"), F.lit("tuned"), F.when(c("status") == "trained", "true").otherwise("false"),
                         F.lit("tuning_method"), F.when(c("task") == "classification", "grid").otherwise("random"), F.lit("a"), F.lit("1"))
    big = F.map_concat(small, F.create_map(F.lit("b"), F.lit("1"), F.lit("c"), F.lit("1"), F.lit("d"), F.lit("1")))
    params = F.when(c("dataset_id") % 2 == 0, big).otherwise(small)
    found = op.anti_patterns(params, c("f1").isNotNull(), c("f1").isNotNull(), F.dayofmonth("created"))
    return runs(spark, sf).select("run_id", F.array_join(found, ",").alias("found"))
