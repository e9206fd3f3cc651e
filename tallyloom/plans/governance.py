"""Bindings for evaluation, diagnosis and clean-up plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import filters, governance as op, joins, ranking
from tallyloom.plans.registry import RUNS_SQL, query, r9, runs, table

DIAG_SQL = f"""
    {RUNS_SQL},
    x AS (SELECT *, CASE WHEN dataset_id % 2 = 0 THEN 1.5 ELSE 1.0 END::DOUBLE AS k, train_acc + 0.08 AS tr FROM runs),
    g AS (SELECT *, list_filter([CASE WHEN acc = 1.0 THEN 'perfect_accuracy' END, CASE WHEN acc < 1.0 AND acc >= 0.999 THEN 'near_perfect_accuracy' END,
      CASE WHEN acc - f1 > 0.15 THEN 'f1_accuracy_gap' END, CASE WHEN f1 IS NULL AND acc >= 0.90 THEN 'missing_f1' END,
      CASE WHEN acc >= 0.90 AND f1 < 0.01 THEN 'majority_class_predictor' END, CASE WHEN tr - acc > 0.15 THEN 'train_test_gap' END,
      CASE WHEN acc - ind_acc >= 0.3::DOUBLE * k THEN 'independent_test_gap_severe' WHEN acc - ind_acc >= 0.15::DOUBLE * k THEN 'independent_test_gap_moderate' END], lambda r: r IS NOT NULL) AS reasons,
      ind_acc IS NULL AND acc >= 0.90 AS warn FROM x),
    t AS (SELECT *, CASE WHEN list_has_any(reasons, ['constant_or_zero_var', 'perfect_accuracy', 'independent_test_gap_severe', 'missing_f1', 'majority_class_predictor']) THEN 'definite_delete'
      WHEN list_has_any(reasons, ['near_perfect_accuracy', 'f1_accuracy_gap', 'train_test_gap', 'independent_test_gap_moderate']) AND acc >= 0.95 THEN 'high_risk_delete'
      WHEN warn AND acc < 0.95 THEN 'warning_only'
      WHEN list_has_any(reasons, ['near_perfect_accuracy', 'f1_accuracy_gap', 'train_test_gap', 'independent_test_gap_moderate']) THEN 'warning_only' ELSE 'healthy' END AS tier FROM g)
"""


def diagnosed(spark, sf):
    df = runs(spark, sf).withColumn("tr", F.col("train_acc") + 0.08)
    return op.with_tier(df, train="tr", synthetic=F.col("dataset_id") % 2 == 0)


@query("E02_independent_gap", f"""
    WITH {RUNS_SQL}, g AS (SELECT *, round(acc - ind_acc, 4) AS gap FROM runs WHERE ind_acc IS NOT NULL)
    SELECT dataset_id, algorithm, run_id, gap FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, algorithm ORDER BY abs(gap), run_id) AS r FROM g) WHERE r = 1
""")
def independent_gap(spark, sf):
    return op.independent_gap(runs(spark, sf), ["dataset_id", "algorithm"], "run_id", "acc", "ind_acc") \
        .select("dataset_id", "algorithm", "run_id", "gap")


@query("E03_diagnose", f"WITH {DIAG_SQL} SELECT run_id, array_to_string(reasons, ',') AS reasons FROM t")
def diagnose(spark, sf):
    return diagnosed(spark, sf).select("run_id", F.array_join("reasons", ",").alias("reasons"))


@query("E04_tier", f"WITH {DIAG_SQL} SELECT run_id, tier FROM t")
def tier(spark, sf):
    return diagnosed(spark, sf).select("run_id", "tier")


@query("A26_tier_summary", f"""
    WITH {DIAG_SQL}
    SELECT dataset_id, count(*) FILTER (tier = 'definite_delete') AS definite_delete, count(*) FILTER (tier = 'high_risk_delete') AS high_risk_delete,
      count(*) FILTER (tier = 'warning_only') AS warning_only, count(*) FILTER (tier = 'healthy') AS healthy FROM t GROUP BY dataset_id
""")
def tier_summary(spark, sf):
    return op.tier_summary(diagnosed(spark, sf), "dataset_id")


@query("A26_gap_summary", f"""
    WITH {RUNS_SQL}, g AS (SELECT abs(round(acc - ind_acc, 4)) AS g FROM runs)
    SELECT count(g) AS evaluated, round(avg(g), 4) AS avg_gap, count(*) FILTER (g > 0.15) AS large_gaps, count(*) FILTER (g > 0.05 AND g <= 0.15) AS moderate_gaps FROM g
""")
def gap_summary(spark, sf):
    return op.gap_summary(runs(spark, sf).withColumn("gap", F.round(F.col("acc") - F.col("ind_acc"), 4)), "gap")


CONSTANT_SQL = """
    c AS (SELECT user_id, count(*) AS n, count(DISTINCT event_type) = 1 AS single, stddev_pop(value / 6000) AS sd FROM events GROUP BY user_id)
"""


@query("E05_constant_predictor", f"""
    WITH {CONSTANT_SQL} SELECT user_id, n, single, round(sd, 9) AS proba_std, single OR sd < 0.01 AS is_constant FROM c
""")
def constant_predictor(spark, sf):
    probes = table(spark, sf, "events").withColumn("p", F.col("value") / 6000)
    return op.constant_predictors(probes, "user_id", "event_type", "p").withColumn("proba_std", r9(F.col("proba_std")))


@query("E06_quick_diagnose", f"""
    WITH {RUNS_SQL}, {CONSTANT_SQL},
    q AS (SELECT run_id, acc, coalesce(single OR sd < 0.01, FALSE) AS constant FROM runs LEFT JOIN c ON c.user_id = dataset_id)
    SELECT run_id, concat_ws(',', CASE WHEN acc = 1 THEN 'perfect_accuracy' END, CASE WHEN acc < 1 AND acc >= 0.999 THEN 'near_perfect_accuracy' END, CASE WHEN constant THEN 'constant_or_zero_var' END) AS reasons,
      CASE WHEN acc = 1 OR constant THEN 'definite_delete' WHEN acc < 1 AND acc >= 0.999 THEN 'high_risk_delete' ELSE 'healthy' END AS tier FROM q
""")
def quick_diagnose(spark, sf):
    probes = table(spark, sf, "events").withColumn("p", F.col("value") / 6000)
    found = op.constant_predictors(probes, "user_id", "event_type", "p").select("user_id", "is_constant")
    df = runs(spark, sf).join(found, F.col("dataset_id") == F.col("user_id"), "left")
    return op.quick_diagnose(df, "acc", F.coalesce("is_constant", F.lit(False))).select(
        "run_id", F.array_join("reasons", ",").alias("reasons"), "tier")


SOURCE_SQL = """
    m AS (SELECT l_partkey AS id, count(*) AS n FROM lineitem GROUP BY 1),
    s AS (SELECT p_partkey AS id, coalesce(n, 0) AS n_models, CASE WHEN regexp_matches(p_name, '^(red|blue) ') THEN 'KEEP' WHEN regexp_matches(p_name, 'ring$') THEN 'DELETE'
       WHEN contains(p_name, 'bolt') AND p_type = 'PROMO' THEN 'KEEP' WHEN regexp_matches(p_brand, '^Brand#1[0-9]$') THEN 'DELETE' ELSE 'UNCERTAIN' END AS v,
       CASE WHEN regexp_matches(p_name, '^(red|blue) ') THEN 'named' WHEN regexp_matches(p_name, 'ring$') THEN 'pattern'
       WHEN contains(p_name, 'bolt') AND p_type = 'PROMO' THEN 'manifest' WHEN regexp_matches(p_brand, '^Brand#1[0-9]$') THEN 'generated' ELSE 'no_rule' END AS reason
       FROM part LEFT JOIN m ON m.id = p_partkey),
    a AS (SELECT id, n_models, reason, CASE WHEN v = 'DELETE' AND n_models > 0 THEN 'DELETE_WITH_MODELS' ELSE v END AS classification FROM s)
"""


def sources(spark, sf):
    part = joins.children_count(table(spark, sf, "part"), "p_partkey", table(spark, sf, "lineitem"), "l_partkey", "n_models")
    return op.classify_sources(part, [
        (F.col("p_name").rlike("^(red|blue) "), "KEEP", "named"), (F.col("p_name").rlike("ring$"), "DELETE", "pattern"),
        (F.col("p_name").contains("bolt") & (F.col("p_type") == "PROMO"), "KEEP", "manifest"),
        (F.col("p_brand").rlike("^Brand#1[0-9]$"), "DELETE", "generated")], "n_models")


@query("E07_classify_sources", f"WITH {SOURCE_SQL} SELECT id, classification, reason, n_models FROM a")
def classify_sources(spark, sf):
    return sources(spark, sf).select(F.col("p_partkey").alias("id"), "classification", "reason", "n_models")


@query("E08_audit_summary", f"WITH {SOURCE_SQL} SELECT classification, count(*) AS n, sum(n_models)::BIGINT AS models_affected FROM a GROUP BY 1")
def audit_summary(spark, sf):
    return op.audit_summary(sources(spark, sf), "n_models")


@query("E09_removal_plan", f"""
    WITH {RUNS_SQL},
    r AS (SELECT *, row_number() OVER (PARTITION BY dataset_id, algorithm ORDER BY acc DESC, coalesce(f1, 0) DESC, run_id) AS rn FROM runs)
    , p AS (SELECT run_id, CASE WHEN created < TIMESTAMP '1995-06-01' THEN 0 WHEN f1 IS NULL THEN 1 WHEN rn > 1 THEN 2
      WHEN CASE task WHEN 'classification' THEN acc - 0.42 < 0.5 WHEN 'regression' THEN f1 - 0.9 < 0 ELSE ind_acc - 0.4 < 0.3 END THEN 3 END AS p FROM r)
    SELECT run_id, CASE min(p) WHEN 0 THEN 'archived' WHEN 1 THEN 'pre_backfill' WHEN 2 THEN 'duplicate' ELSE 'low_quality' END AS category
    FROM p WHERE p IS NOT NULL GROUP BY run_id
""")
def removal_plan(spark, sf):
    df = ranking.keep_best(runs(spark, sf), ["dataset_id", "algorithm"], ["acc", "f1"], "run_id")
    scored = df.withColumn("a", F.col("acc") - 0.42).withColumn("r2", F.col("f1") - 0.9).withColumn("s", F.col("ind_acc") - 0.4)
    return op.removal_plan(scored, "run_id", [
        ("archived", F.col("created") < F.to_timestamp_ntz(F.lit("1995-06-01 00:00:00"))),
        ("pre_backfill", F.col("f1").isNull()),
        ("duplicate", F.col("verdict") == "duplicate"),
        ("low_quality", filters.low_quality("task", "a", "r2", "s"))])


@query("E10_retrain_queue", f"""
    WITH {DIAG_SQL}
    SELECT dataset_id, algorithm, run_id, tier FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, algorithm ORDER BY CASE tier WHEN 'definite_delete' THEN 1 ELSE 2 END, run_id) AS r
      FROM t WHERE tier IN ('definite_delete', 'high_risk_delete')) WHERE r = 1
""")
def retrain_queue(spark, sf):
    return op.retrain_queue(diagnosed(spark, sf), ["dataset_id", "algorithm"], "run_id")


@query("E11_compare_models", f"""
    WITH {RUNS_SQL}, p AS (SELECT run_id, acc, f1, train_acc, round(1 - acc, 4) AS loss FROM runs ORDER BY acc DESC, run_id LIMIT 4),
    l AS (SELECT run_id, 'acc' AS metric, acc AS value, acc AS s FROM p UNION ALL SELECT run_id, 'f1', f1, f1 FROM p
          UNION ALL SELECT run_id, 'train_acc', train_acc, train_acc FROM p UNION ALL SELECT run_id, 'loss', loss, -loss FROM p)
    SELECT run_id, metric, value, value IS NOT NULL AND row_number() OVER (PARTITION BY metric ORDER BY s DESC NULLS LAST, run_id) = 1 AS is_best FROM l
""")
def compare_models(spark, sf):
    df = runs(spark, sf).withColumn("loss", F.round(1 - F.col("acc"), 4))
    four = ranking.top_n(df, [F.desc("acc"), F.asc("run_id")], 4)
    return op.compare_models(four, "run_id", {"acc": True, "f1": True, "train_acc": True, "loss": False})


@query("E12_alert_lines", f"""
    WITH {DIAG_SQL}, p AS (SELECT run_id, tier, row_number() OVER (ORDER BY run_id) AS r, count(*) OVER () AS n FROM t WHERE tier IN ('definite_delete', 'high_risk_delete'))
    SELECT r::INTEGER AS line_no, tier || ': ' || run_id AS line FROM p WHERE r <= 10 UNION ALL SELECT 11, '... and ' || (max(n) - 10) || ' more' FROM p HAVING max(n) > 10
""")
def alert_lines(spark, sf):
    bad = diagnosed(spark, sf).filter(F.col("tier").isin("definite_delete", "high_risk_delete"))
    return op.alert_lines(bad, F.concat("tier", F.lit(": "), "run_id"), ["run_id"])
