"""Diagnosis of model runs: reasons, tiers, plans, queues and alerts.

The whole registry is scored with column expressions in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ranking import best_flags, winners

# Thresholds of the diagnosis.
PERFECT, NEAR_PERFECT = 1.0, 0.999
F1_GAP, TRAIN_GAP = 0.15, 0.15
GAP_SEVERE, GAP_MODERATE, SYNTHETIC_FACTOR = 0.30, 0.15, 1.5
HIGH_ACCURACY, RISK_ACCURACY, NO_F1 = 0.90, 0.95, 0.01
PROBABILITY_SPREAD = 0.01
HEALTH_LIMIT = 40

DEFINITE = ("constant_or_zero_var", "perfect_accuracy", "independent_test_gap_severe", "missing_f1", "majority_class_predictor")
HIGH_RISK = ("near_perfect_accuracy", "f1_accuracy_gap", "train_test_gap", "independent_test_gap_moderate")
TIERS = ("definite_delete", "high_risk_delete", "warning_only", "healthy")


def checks(acc: Column, f1: Column, train: Column, ind: Column, synthetic: Column,
           constant: Column | None = None) -> dict[str, Column]:
    """Reason -> condition, in the order the checks run."""
    factor = F.when(synthetic, SYNTHETIC_FACTOR).otherwise(1.0)
    gap = acc - ind
    out = {
        "perfect_accuracy": acc == PERFECT,
        "near_perfect_accuracy": (acc < PERFECT) & (acc >= NEAR_PERFECT),
        "f1_accuracy_gap": acc - f1 > F1_GAP,
        "missing_f1": f1.isNull() & (acc >= HIGH_ACCURACY),
        "majority_class_predictor": (acc >= HIGH_ACCURACY) & (f1 < NO_F1),
        "train_test_gap": train - acc > TRAIN_GAP,
        "independent_test_gap_severe": gap >= GAP_SEVERE * factor,
        "independent_test_gap_moderate": (gap >= GAP_MODERATE * factor) & (gap < GAP_SEVERE * factor),
    }
    if constant is not None:
        out["constant_or_zero_var"] = constant
    return out


def listed(conditions: Mapping[str, Column]) -> Column:
    """Array of the names whose condition holds."""
    return F.array_compact(F.array(*[F.when(c, name) for name, c in conditions.items()]))


def any_of(conditions: Mapping[str, Column], names: Sequence[str]) -> Column:
    """Whether one of the named conditions holds; unknown counts as no."""
    out = F.lit(False)
    for n in names:
        if n in conditions:
            out = out | F.coalesce(conditions[n], F.lit(False))
    return out


def cautions(acc: Column, ind: Column, health: Column | None = None) -> dict[str, Column]:
    """No independent evaluation at high accuracy, or a low health score."""
    out = {"no_independent_evaluation": ind.isNull() & (acc >= HIGH_ACCURACY)}
    if health is not None:
        out["low_health_score"] = health < HEALTH_LIMIT
    return out


def tier(found: Mapping[str, Column], warned: Mapping[str, Column], acc: Column) -> Column:
    """Decided on the conditions themselves, so a filter on the tier stays a
    plain predicate and builds no arrays."""
    risky = any_of(found, HIGH_RISK)
    return (F.when(any_of(found, DEFINITE), "definite_delete")
            .when(risky & (acc >= RISK_ACCURACY), "high_risk_delete")
            .when(any_of(warned, list(warned)) & (acc.isNull() | (acc < RISK_ACCURACY)), "warning_only")
            .when(risky, "warning_only").otherwise("healthy"))


def with_tier(df: DataFrame, acc="acc", f1="f1", train="train_acc", ind="ind_acc", synthetic: Column | None = None,
              constant: Column | None = None, health: Column | None = None) -> DataFrame:
    """Add `reasons`, `warnings` and `tier`."""
    c = F.col
    syn = F.lit(False) if synthetic is None else synthetic
    found = checks(c(acc), c(f1), c(train), c(ind), syn, constant)
    warned = cautions(c(acc), c(ind), health)
    return df.withColumns({"reasons": listed(found), "warnings": listed(warned), "tier": tier(found, warned, c(acc))})


def quick_diagnose(df: DataFrame, acc: str, constant: Column) -> DataFrame:
    """Accuracy and constant-predictor checks only."""
    a = F.col(acc)
    reasons = F.array_compact(F.array(F.when(a == PERFECT, "perfect_accuracy"),
                                      F.when((a < PERFECT) & (a >= NEAR_PERFECT), "near_perfect_accuracy"),
                                      F.when(constant, "constant_or_zero_var")))
    out = df.withColumn("reasons", reasons)
    r = F.col("reasons")
    return out.withColumn("tier", F.when(F.array_contains(r, "perfect_accuracy") | F.array_contains(r, "constant_or_zero_var"), "definite_delete")
                          .when(F.array_contains(r, "near_perfect_accuracy") & (a >= RISK_ACCURACY), "high_risk_delete")
                          .when(F.size(r) > 0, "warning_only").otherwise("healthy"))


def constant_predictors(probes: DataFrame, model: str, prediction: str, probability: str) -> DataFrame:
    """Per model: distinct predictions, spread of the first-class probability,
    and whether the model is constant. Min and max tell a single value apart
    without collecting values."""
    return probes.groupBy(model).agg(
        F.count(F.lit(1)).alias("n"), (F.min(prediction) == F.max(prediction)).alias("single"),
        F.stddev_pop(probability).alias("proba_std")) \
        .withColumn("is_constant", F.col("single") | (F.col("proba_std") < PROBABILITY_SPREAD))


def tier_summary(df: DataFrame, by: str) -> DataFrame:
    count = lambda t: F.sum(F.when(F.col("tier") == t, 1).otherwise(0)).alias(t)
    return df.groupBy(by).agg(*[count(t) for t in TIERS])


def gap_summary(df: DataFrame, gap: str) -> DataFrame:
    g = F.abs(F.col(gap))
    return df.agg(F.count(gap).alias("evaluated"), F.round(F.avg(g), 4).alias("avg_gap"),
                  F.sum(F.when(g > 0.15, 1).otherwise(0)).alias("large_gaps"),
                  F.sum(F.when((g > 0.05) & (g <= 0.15), 1).otherwise(0)).alias("moderate_gaps"))


def classify_sources(df: DataFrame, rules: Sequence[tuple[Column, str, str]], n_models: str) -> DataFrame:
    """First matching rule gives the class and reason; synthetic data that models
    depend on is told apart; nothing matching is UNCERTAIN."""
    verdict, reason = F.lit("UNCERTAIN"), F.lit("no_rule")
    for rule, value, why in reversed(rules):
        verdict, reason = F.when(rule, value).otherwise(verdict), F.when(rule, why).otherwise(reason)
    both = df.withColumn("classification", verdict).withColumn("reason", reason)
    return both.withColumn("classification", F.when((F.col("classification") == "DELETE") & (F.col(n_models) > 0), "DELETE_WITH_MODELS")
                           .otherwise(F.col("classification")))


def audit_summary(df: DataFrame, n_models: str) -> DataFrame:
    return df.groupBy("classification").agg(F.count(F.lit(1)).alias("n"), F.sum(n_models).alias("models_affected"))


def removal_plan(df: DataFrame, key: str, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per key that a rule removes, with the first such reason in the order
    of the rules; all rules are judged in one pass over the rows."""
    names = F.array(*[F.lit(name) for name, _ in rules])
    first = F.coalesce(*[F.when(rule, F.lit(i)) for i, (_, rule) in enumerate(rules)])
    return (df.select(key, first.alias("__p")).filter(F.col("__p").isNotNull()).groupBy(key).agg(F.min("__p").alias("__p"))
            .select(key, F.get(names, F.col("__p")).alias("category")))


def retrain_queue(df: DataFrame, by: Sequence[str], key: str, tiers: Sequence[str] = TIERS[:2]) -> DataFrame:
    """One run per (dataset, algorithm) among the chosen tiers, worst tier first."""
    names = F.array(*[F.lit(t) for t in tiers])
    worst = F.min(F.struct(F.array_position(names, F.col("tier")).alias("s"), F.col(key).alias("k")))
    return (df.filter(F.col("tier").isin(*tiers)).groupBy(*by).agg(worst.alias("__w"))
            .select(*by, F.col("__w.k").alias(key), F.element_at(names, F.col("__w.s").cast("int")).alias("tier")))


def compare_models(df: DataFrame, key: str, metrics: Mapping[str, bool]) -> DataFrame:
    """Metrics as rows, the compared runs side by side as `value`, best marked."""
    return best_flags(df, key, metrics)


def alert_lines(df: DataFrame, line: Column, order: Sequence[str], limit: int = 10) -> DataFrame:
    """The first `limit` alert lines and a closing line counting the rest."""
    shown = df.orderBy(*order).limit(limit).withColumn("line", line)
    rows = shown.select(F.row_number().over(W.orderBy(*order)).alias("line_no"), "line")  # over `limit` rows
    rest = df.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(
        F.lit(limit + 1).alias("line_no"), F.concat(F.lit("... and "), F.col("n") - limit, F.lit(" more")).alias("line"))
    return rows.unionByName(rest)


def independent_gap(df: DataFrame, by: Sequence[str], key: str, acc: str, ind: str) -> DataFrame:
    """Per model the evaluation closest to its own accuracy."""
    gaps = df.withColumn("gap", F.round(F.coalesce(F.col(acc), F.lit(0.0)) - F.col(ind), 4)).filter(F.col("gap").isNotNull())
    best = winners(gaps, by, [-F.abs(F.col("gap"))], key)
    return gaps.join(best.select(F.col(key).alias("__k")), F.col(key) == F.col("__k"), "left_semi")
