"""Rule-based advice on dataset profiles and finished runs.

Pure column expressions: a registry of any size is scored in one pass. Missing
metrics count as the default the rule names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.values import round_even


def pieces(value: Column, steps: Sequence[tuple[float, float, float, float]], rest: Column) -> Column:
    """Piecewise line: from each lower bound, start + (value - bound) / width · rise."""
    out = rest
    for bound, start, width, rise in reversed(steps):
        out = F.when(value >= bound, start + (value - bound) / width * rise).otherwise(out)
    return out


def ladder(value: Column, steps: Sequence[tuple[float, float]], rest, strict: bool = True) -> Column:
    """First level whose bound the value exceeds (or reaches, unless strict)."""
    out = F.lit(rest)
    for bound, level in reversed(steps):
        out = F.when(value > bound if strict else value >= bound, level).otherwise(out)
    return out


def bounded(score: Column, low: float = 0.0, high: float = 100.0, decimals: int = 1) -> Column:
    return round_even(F.greatest(F.lit(low), F.least(F.lit(high), score)), decimals)


# --------------------------------------------------------------- dataset rows

def recommend_task(text_heavy: Column, target_type: Column, n_classes: Column) -> tuple[Column, Column]:
    """(task, confidence)."""
    categorical = target_type == "categorical"
    task = (F.when(text_heavy, "nlp").when(target_type == "continuous", "regression")
            .when(categorical, "classification").otherwise("other"))
    conf = (F.when(text_heavy, 0.85).when(target_type == "continuous", 0.90)
            .when(categorical & (n_classes == 2), 0.92).when(categorical, 0.90).otherwise(0.50))
    return task, conf


# Algorithms and confidences per situation.
ADVICE = {
    "text": [("transformer_bert", 0.95), ("tfidf_logistic", 0.70), ("tfidf_svm", 0.65)],
    "wide": [("mlp", 0.88), ("random_forest", 0.55)],
    "continuous_large": [("gradient_boosting_regressor", 0.88), ("random_forest_regressor", 0.82), ("ridge", 0.70), ("mlp", 0.65)],
    "continuous_small": [("ridge", 0.85), ("random_forest_regressor", 0.75), ("knn_regressor", 0.60)],
    "balanced_large": [("random_forest", 0.90), ("gradient_boosting", 0.87), ("mlp", 0.72)],
    "imbalanced": [("random_forest", 0.88), ("gradient_boosting", 0.82)],
    "small": [("svm", 0.82), ("logistic_regression", 0.78)],
    "medium": [("random_forest", 0.88), ("svm", 0.75), ("knn", 0.65)],
    "unknown": [("random_forest", 0.60), ("mlp", 0.50)],
}


def advice_key(text_heavy: Column, high_dim: Column, n_features: Column, target_type: Column, n: Column, imbalanced: Column) -> Column:
    cat = target_type == "categorical"
    return (F.when(text_heavy, "text").when(high_dim & (n_features > 200), "wide")
            .when((target_type == "continuous") & (n > 5000), "continuous_large")
            .when(target_type == "continuous", "continuous_small")
            .when(cat & (n > 5000) & ~imbalanced, "balanced_large").when(cat & imbalanced, "imbalanced")
            .when(cat & (n < 1000), "small").when(cat, "medium").otherwise("unknown"))


def recommend_algorithms(key: Column, advice: Mapping[str, Sequence[tuple[str, float]]] = ADVICE, top: int = 5) -> Column:
    """Array of (algorithm, confidence), best first."""
    def listed(items):
        return F.array(*[F.struct(F.lit(a).alias("algorithm"), F.lit(c).alias("confidence")) for a, c in items[:top]])

    pairs = [x for k, items in advice.items() for x in (F.lit(k), listed(items))]
    return F.create_map(*pairs)[key]


# Categories that force a task, and those that carry a warning.
FORCED_TASK = {"classification": "classification", "regression": "regression", "clustering": "clustering",
               "nlp": "classification", "vision": "classification"}
CATEGORY_WARNING = {"nlp": "text_needs_text_features", "vision": "images_need_image_models",
                    "synthetic": "target_may_be_random", "time_series": "random_split_breaks_order"}


def category_task(category: Column, target_type: Column, latent_share: Column) -> tuple[Column, Column]:
    """(task, warning): the category forces a task, else the target decides;
    tables that are mostly latent columns get their own warning."""
    lookup = lambda m: F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[category]
    task = F.coalesce(lookup(FORCED_TASK), F.when(target_type == "continuous", "regression").otherwise("classification"))
    return task, F.coalesce(lookup(CATEGORY_WARNING), F.when(latent_share >= 0.7, "latent_columns"))


def signal_quality(n_samples: Column, n_features: Column, avg_corr: Column, high_corr: Column, missing: Column,
                   imbalanced: Column, wide: Column) -> dict[str, Column]:
    """Score, level, ratio, regularisation bias and the issues that lowered it."""
    n = F.greatest(n_samples, F.lit(1))
    ratio = n_features / n
    score = (F.lit(0.70) - ladder(ratio, [(0.5, 0.25), (0.1, 0.10)], 0.0) - F.when(wide, 0.30).otherwise(0.0)
             - ladder(missing, [(0.20, 0.25), (0.08, 0.10)], 0.0) - ladder(high_corr, [(10, 0.10), (3, 0.05)], 0.0)
             - F.when(imbalanced, 0.08).otherwise(0.0) + F.when(avg_corr.between(0.12, 0.35), 0.08).otherwise(0.0))
    score = F.greatest(F.lit(0.05), F.least(F.lit(0.98), score))
    issues = F.array_compact(F.array(
        F.when(ratio > 0.5, "ratio_high").when(ratio > 0.1, "ratio_raised"), F.when(wide, "wide"),
        F.when(missing > 0.20, "missing_high").when(missing > 0.08, "missing_raised"),
        F.when(high_corr > 10, "collinear"), F.when(imbalanced, "imbalanced")))
    return {"score": round_even(score, 3), "level": ladder(score, [(0.70, "strong"), (0.45, "moderate"), (0.25, "weak")], "noise", strict=False),
            "issues": issues, "ratio": round_even(ratio, 4), "regularization_bias": round_even(1.0 + (1.0 - score) * 3.0, 2)}


# Below this a task's score counts as low.
LOW_SCORE = {"regression": 0.30, "clustering": 0.25, "classification": 0.55}


def root_cause(task: Column, score: Column, train: Column, level: Column, signal: Column) -> tuple[Column, Column]:
    """(cause, confidence): data, algorithm, parameter or unknown."""
    low = F.when(task == "regression", LOW_SCORE["regression"]).when(task == "clustering", LOW_SCORE["clustering"]) \
        .otherwise(LOW_SCORE["classification"])
    gap = F.abs(train - score)
    weak = level.isin("weak", "noise") & (score < low)
    cause = (F.when(weak, "data").when(score < low * 0.6, "algorithm").when((gap > 0.15) | (score < low), "parameter")
             .otherwise("unknown"))
    conf = (F.when(weak, F.least(F.lit(0.95), 0.75 + (1.0 - signal) * 0.2)).when(score < low * 0.6, 0.65)
            .when(gap > 0.15, 0.72).when(score < low, 0.55).otherwise(0.40))
    return cause, round_even(conf, 2)


# ------------------------------------------------------------------- run rows

# Fixed values: (from, score there, width, rise over the width).
ACCURACY_LINE = [(0.98, 78, 0.02, 2), (0.95, 68, 0.03, 10), (0.88, 55, 0.07, 13), (0.80, 40, 0.08, 15),
                 (0.70, 25, 0.10, 15), (0.55, 10, 0.15, 15), (0.40, 3, 0.15, 7)]
F1_BONUS = [(0.95, 15), (0.85, 10), (0.75, 5), (0.60, 0), (0.45, -5), (0.30, -10)]
R2_LINE = [(0.95, 92, 0.05, 8), (0.85, 78, 0.10, 14), (0.70, 60, 0.15, 18), (0.50, 38, 0.20, 22), (0.25, 18, 0.25, 20), (0.0, 5, 0.25, 13)]
SILHOUETTE_LINE = [(0.70, 88, 0.30, 12), (0.50, 65, 0.20, 23), (0.30, 38, 0.20, 27), (0.10, 15, 0.20, 23), (0.0, 5, 0.10, 10)]


def absolute_score(task: Column, acc: Column, f1: Column, r2: Column, silhouette: Column) -> Column:
    a, f = F.coalesce(acc, F.lit(0.0)), F.coalesce(f1, F.lit(0.0))
    base = pieces(a, ACCURACY_LINE, F.when(a > 0, a * 7).otherwise(0.0))
    bonus = F.when(f > 0, ladder(f, F1_BONUS, -15, strict=False)).otherwise(0)
    reg = pieces(r2, R2_LINE, F.greatest(F.lit(0.0), 3 + r2 * 3))
    clu = pieces(silhouette, SILHOUETTE_LINE, F.greatest(F.lit(0.0), 2 + silhouette * 3))
    return (F.when(task == "classification", bounded(base + bonus))
            .when((task == "regression") & r2.isNotNull(), bounded(reg))
            .when((task == "clustering") & silhouette.isNotNull(), bounded(clu)).otherwise(20.0))


SEVERITY_SCORE = {"critical": 10.0, "high": 35.0, "medium": 55.0, "low": 75.0}


def overfit_severity(task: Column, train: Column, test: Column, separated: Column, best_cv: Column) -> Column:
    """none, low, medium, high or critical from the train-test gap; without a
    usable gap the cross-validation score against the test score decides."""
    names = ("critical", "high", "medium", "low")
    steps = lambda bounds: list(zip(bounds, names, strict=True))
    gap, cv = train - test, best_cv - F.coalesce(test, F.lit(0.0))
    reg = task == "regression"
    by_gap = F.when(reg, ladder(gap, steps((0.30, 0.20, 0.10, 0.05)), "none")) \
        .otherwise(ladder(gap, steps((0.20, 0.12, 0.06, 0.03)), "none"))
    by_cv = F.when(best_cv.isNull(), "none").when(reg, ladder(cv, steps((0.25, 0.15, 0.08, 0.04)), "none")) \
        .otherwise(ladder(cv, steps((0.15, 0.10, 0.05, 0.02)), "none"))
    return (F.when(task == "clustering", "none").when(train.isNull() | test.isNull(), by_cv)
            .when(~separated & (F.abs(gap) < 0.005), by_cv).otherwise(by_gap))


def overfit_score(severity: Column) -> Column:
    out = F.lit(100.0)
    for name, score in SEVERITY_SCORE.items():
        out = F.when(severity == name, score).otherwise(out)
    return out


def convergence_from_metric(task: Column, acc: Column, r2: Column, silhouette: Column) -> Column:
    """Runs of fewer than three epochs: the final metric stands in."""
    a = F.coalesce(acc, F.lit(0.0))
    levels = (85.0, 73.0, 58.0, 40.0)
    steps = lambda bounds: list(zip(bounds, levels, strict=True))
    cls = F.when(a >= 0.90, 85.0).when(a >= 0.78, 73.0).when(a >= 0.60, 58.0).when(a > 0, 40.0).otherwise(30.0)
    reg = ladder(r2, steps((0.85, 0.65, 0.40, 0.10)), 30.0, strict=False)
    clu = ladder(silhouette, steps((0.60, 0.40, 0.20, 0.05)), 30.0, strict=False)
    return (F.when(task == "classification", cls).when((task == "regression") & r2.isNotNull(), reg)
            .when((task == "clustering") & silhouette.isNotNull(), clu).otherwise(50.0))


def convergence_from_curve(cv: Column, oscillating: Column, slow: Column, diverging: Column, converged: Column) -> Column:
    shaky = F.when(oscillating, ladder(round_even(cv, 4), [(0.50, 40), (0.35, 30), (0.25, 20)], 10)).otherwise(0)
    score = F.lit(80.0) - shaky - F.when(slow, 15).otherwise(0) - F.when(diverging, 50).otherwise(0)
    return bounded(F.when(converged, F.least(F.lit(100.0), score + 20)).otherwise(score))


def class_balance_score(prec: Column, rec: Column, f1: Column, acc: Column) -> Column:
    p, r, f, a = (F.coalesce(c, F.lit(0.0)) for c in (prec, rec, f1, acc))
    pr = F.when((p > 0) & (r > 0), ladder(F.abs(p - r), [(0.40, 35), (0.25, 20), (0.15, 10), (0.08, 5)], 0)).otherwise(0)
    af = F.when((a > 0) & (f > 0), ladder(a - f, [(0.30, 25), (0.15, 12), (0.08, 5)], 0)).otherwise(0)
    poor = lambda c: F.when((c > 0) & (c < 0.30), 15).otherwise(0)
    return bounded(100.0 - pr - af - poor(p) - poor(r))


def residual_balance_score(skew: Column, kurtosis: Column, rmse: Column, mae: Column) -> Column:
    s, k = F.abs(F.coalesce(skew, F.lit(0.0))), F.coalesce(kurtosis, F.lit(0.0))
    ratio = F.when((mae > 0) & (rmse > 0), rmse / mae).otherwise(0.0)
    return bounded(85.0 - ladder(s, [(1.5, 35), (1.0, 20), (0.5, 10), (0.25, 5)], 0)
                   - ladder(k, [(4.0, 20), (3.5, 10)], 0) - ladder(ratio, [(2.5, 15), (1.8, 8)], 0))


def cluster_balance_score(balance: Column, n_clusters: Column, silhouette: Column, noise: Column) -> Column:
    """From the size ratio where two clusters are known, else the silhouette."""
    sized = ladder(balance, [(0.7, 95.0), (0.5, 85.0), (0.3, 65.0), (0.15, 40.0), (0.05, 20.0)], 8.0, strict=False)
    base = F.coalesce(silhouette, F.lit(0.3)) * 100
    guess = F.greatest(F.lit(10.0), F.least(F.lit(95.0), F.when(n_clusters > 10, F.least(F.lit(100.0), base * 1.3)).otherwise(base)))
    return bounded(F.when(balance.isNotNull(), sized).otherwise(guess)
                   - ladder(F.coalesce(noise, F.lit(0.0)), [(0.30, 30), (0.15, 15), (0.08, 8)], 0))


def generalisation_score(task: Column, n_epochs: Column, avg_train: Column, test: Column, n_samples: Column,
                         hidden_units: Column) -> Column:
    gap = avg_train - F.coalesce(test, F.lit(0.0))
    by_gap = F.when(task == "classification", ladder(gap, [(0.15, 30), (0.08, 15), (0.03, 5)], 0)) \
        .when(task == "regression", ladder(gap, [(0.20, 30), (0.10, 15), (0.05, 5)], 0)).otherwise(0)
    gap_cost = F.when((n_epochs >= 2) & avg_train.isNotNull(), by_gap).otherwise(0)
    ratio = n_samples / F.greatest(hidden_units * 100, F.lit(1))
    capacity = F.when((hidden_units > 0) & (n_samples > 0),
                      F.when(ratio < 1, -15).when(ratio < 5, -5).when(ratio > 50, 5).otherwise(0)).otherwise(0)
    return bounded(F.lit(80.0) - gap_cost + capacity)


# Weights of the five parts of the health score.
HEALTH_WEIGHTS = {"absolute_perf": 0.35, "overfitting_risk": 0.25, "convergence_quality": 0.20,
                  "class_balance": 0.10, "generalization": 0.10}


def health_score(parts: Mapping[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, weight in HEALTH_WEIGHTS.items():
        total = total + parts[name] * weight
    return F.greatest(F.lit(3.0), F.least(F.lit(99.0), round_even(total, 1)))


def health_issues(parts: Mapping[str, Column]) -> Column:
    """`low_<part>:<severity>` for every part below 45, 65 or 80."""
    out = [F.when(parts[name] < 45, f"low_{name}:high").when(parts[name] < 65, f"low_{name}:medium")
           .when(parts[name] < 80, f"low_{name}:low") for name in HEALTH_WEIGHTS]
    return F.array_compact(F.array(*out))


def decision_path(task: Column, n: Column, first_loss: Column, last_loss: Column, severity: Column, avg_train: Column,
                  test: Column, trend: Column, oscillating: Column, slow: Column, lr: Column, batch: Column) -> Column:
    """Answers of the five questions as (node, answer, severity), in order."""
    step = lambda node, answer, sev: F.struct(F.lit(node).alias("node"), answer.alias("answer"), sev.alias("severity"))
    lit = F.lit
    high = (F.when(task == "classification", last_loss > 2.0)
            .when(task == "regression", (last_loss > first_loss * 0.8) & (last_loss > 10)).otherwise(last_loss > 5.0))
    q1 = F.when(n >= 3, step("Q1", F.when(high, "YES").otherwise("NO"), F.when(high, "high").otherwise("none")))
    over = severity != "none"
    q2 = step("Q2", F.when(over, "YES").otherwise("NO"), severity)
    gap = F.abs(avg_train - test)
    under = (F.when(task == "classification", (avg_train < 0.55) & (test < 0.55) & (gap < 0.10) & (test > 0))
             .when(task == "regression", (avg_train < 0.25) & (test < 0.25) & (gap < 0.10)).otherwise(False))
    q3 = step("Q3", F.when(under, "YES").otherwise("NO"), F.when(under, "medium").otherwise("none"))
    q4 = (F.when((trend == "unknown") & (n < 3), step("Q4", lit("SKIP"), lit("none")))
          .when(oscillating, step("Q4", lit("YES"), lit("medium"))).when(slow, step("Q4", lit("SLOW"), lit("low")))
          .otherwise(step("Q4", lit("NO"), lit("none"))))
    wanted = 0.001 * (batch / 64)
    q5 = F.when((n >= 3) & (lr > wanted * 3), step("Q5", lit("LR_HIGH"), lit("medium"))) \
        .when((n >= 3) & (lr < wanted / 3), step("Q5", lit("LR_LOW"), lit("medium")))
    return F.array_compact(F.array(q1, q2, q3, q4, q5))


# Keys that are bookkeeping, not tuned parameters.
BOOKKEEPING = ("task_type", "algorithm", "target_column", "tuned", "tuning_method", "best_cv_score", "tuning_cv_folds")


def anti_patterns(params: Column, has_metrics: Column, reports_test: Column, n_epochs: Column) -> Column:
    """no_baseline, grid_search_high_dim, potential_test_leak."""
    tuned = F.coalesce(params["tuned"] == "true", F.lit(False))
    searched = F.size(F.filter(F.map_keys(params), lambda k: ~k.isin(*BOOKKEEPING)))
    return F.array_compact(F.array(
        F.when(~tuned & params["baseline_score"].isNull() & ~has_metrics & (n_epochs < 2), "no_baseline"),
        F.when((params["tuning_method"] == "grid") & tuned & (searched > 3), "grid_search_high_dim"),
        F.when(reports_test & (n_epochs > 10), "potential_test_leak")))
