"""Leaderboards, winners, histories and bounded top lists.

Winners and short top lists are windows that Spark cuts in every task before the
shuffle (row_number <= k), other single values `max_by`/`min_by` aggregates that
combine first. Neither moves a whole group to one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.values import round_even
from tallyloom.operators.ordered import neighbour, ranked, running_max


def top_n(df: DataFrame, order: Sequence[Column], n: int, by: Sequence[str] = ()) -> DataFrame:
    """First n rows in total, or per group."""
    if not by:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("place", rank).filter(F.col("place") <= n)


def leaderboard(df: DataFrame, metric: str, key: str, n: int = 5, by: Sequence[str] = (),
                higher_better: bool = True) -> DataFrame:
    """Best n by metric, nulls out; losses sort the other way round."""
    best = F.col(metric).desc() if higher_better else F.col(metric).asc()
    return top_n(df.filter(F.col(metric).isNotNull()), [best, F.col(key).asc()], n, by)


def mark_members(df: DataFrame, key: str, chosen: DataFrame, alias: str) -> DataFrame:
    """Boolean `alias`: row key is among the chosen ones (join on the row key,
    which is unique, so a hot group does not meet in one task)."""
    ids = chosen.select(F.col(key).alias("__chosen"))
    return (df.join(ids, F.col(key) == F.col("__chosen"), "left")
            .withColumn(alias, F.col("__chosen").isNotNull()).drop("__chosen"))


def winners(df: DataFrame, by: Sequence[str], order: Sequence[Column], key: str) -> DataFrame:
    """Row key of the best row per group: largest `order` (nulls last), smallest
    key on ties. Each task keeps one row per group before the shuffle."""
    ranked_by = [c.alias(f"__o{i}") for i, c in enumerate(order)]
    place = [F.col(f"__o{i}").desc_nulls_last() for i in range(len(order))]
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*place, F.col(key).asc()))
    return (df.select(*by, key, *ranked_by).withColumn("__r", rank).filter(F.col("__r") == 1)
            .select(*by, key))


def keep_best(df: DataFrame, by: Sequence[str], metrics: Sequence[str], key: str) -> DataFrame:
    """`verdict` keep/duplicate: the best (missing metrics count 0) is kept."""
    order = [F.coalesce(F.col(m), F.lit(0.0)) for m in metrics]
    return mark_members(df, key, winners(df, by, order, key), "__best") \
        .withColumn("verdict", F.when(F.col("__best"), "keep").otherwise("duplicate")).drop("__best")


def keep_latest_draft(df: DataFrame, by: Sequence[str], status: str, draft: str, trained: str,
                      created: str, key: str) -> DataFrame:
    """Drafts with a verdict: a group with a trained row keeps none, else the
    newest; a kept draft is counted after all rules."""
    drafts = df.filter(F.col(status) == draft)
    newest = winners(drafts, by, [F.col(created)], key)
    has = df.filter(F.col(status) == trained).select(*[F.col(b).alias(f"__t_{b}") for b in by]).distinct()
    cond = F.lit(True)
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"__t_{b}"))
    shadowed = newest.join(has, cond, "left").select(key, F.col(f"__t_{by[0]}").isNotNull().alias("__shadowed")) \
        .withColumnRenamed(key, "__new")
    return (drafts.join(shadowed, F.col(key) == F.col("__new"), "left")
            .withColumn("verdict", F.when(F.col("__new").isNull(), "draft_duplicate")
                        .when(F.col("__shadowed"), "draft_with_trained_exists").otherwise("keep"))
            .drop("__new", "__shadowed"))


def keep_best_by_task(df: DataFrame, by: Sequence[str], task: str, scores: Mapping[str, Column],
                      status: str, created: str, key: str) -> DataFrame:
    """Category of every removable row: newest draft and best trained row stay
    (ranked by the task's own score, then newest); other statuses go when the
    group has siblings."""
    score = F.lit(0.0)
    for name, value in scores.items():
        score = F.when(F.col(task) == name, value).otherwise(score)
    st = F.col(status)
    rows = df.withColumn("__class", F.when(st.isin("trained", "draft"), st).otherwise("other")) \
        .withColumn("__score", F.when(st == "trained", score).otherwise(0.0))
    best = winners(rows, [*by, "__class"], [F.col("__score"), F.col(created)], key)
    single = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min(key).alias(key)).filter(F.col("__n") == 1)
    marked = mark_members(mark_members(rows, key, best, "__best"), key, single, "__single")
    return (marked.filter(~F.col("__single") & (~F.col("__best") | (F.col("__class") == "other")))
            .withColumn("category", F.concat(F.lit("duplicate_"), "__class"))
            .drop("__class", "__score", "__best", "__single"))


def best_flags(df: DataFrame, key: str, metrics: Mapping[str, bool]) -> DataFrame:
    """(key, metric, value, is_best) for a handful of rows under comparison;
    the flag says whether higher is better, the smallest key wins ties."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"),
                                         F.lit(up).alias("up")) for m, up in metrics.items()]))
    long = df.select(key, cells.alias("c")).select(key, "c.*")
    score = F.when(F.col("up"), F.col("value")).otherwise(-F.col("value"))
    present = long.filter(F.col("value").isNotNull()).withColumn("__s", score)
    best = winners(present, ["metric"], [F.col("__s")], key).select(
        F.col("metric").alias("__m"), F.col(key).alias("__k"))
    return (long.join(best, (F.col("metric") == F.col("__m")) & (F.col(key) == F.col("__k")), "left")
            .select(key, "metric", "value", F.col("__k").isNotNull().alias("is_best")))


def rank_results(df: DataFrame, score: str, key: str, n: int = 20) -> DataFrame:
    """The n best results with their competition rank."""
    top = df.orderBy(F.desc(score), key).limit(n)
    return top.withColumn("rank", F.rank().over(W.orderBy(F.desc(score))))  # over n rows


def running_best(df: DataFrame, by: Sequence[str], order: str, ties: Sequence[str], score: str,
                 params: str) -> DataFrame:
    """Best score and its parameters so far; the earliest of equals stays."""
    early = F.struct(F.col(score).alias("score"), (-F.unix_micros(F.col(order).cast("timestamp"))).alias("t"),
                     F.col(params).alias("params"))
    out = running_max(df, by, order, early, "__best", ties)
    return out.withColumn("best_score", F.col("__best.score")) \
        .withColumn("best_params", F.col("__best.params")).drop("__best")


def progress(df: DataFrame, by: Sequence[str], order: str, ties: Sequence[str]) -> DataFrame:
    """Step number and percent of the group's steps, one decimal, at most 100."""
    out = ranked(df, by, order, ties, rank="step", total="__total")
    pct = F.least(F.lit(100.0), F.col("step") / F.col("__total") * 100)
    return out.withColumn("progress_percent", round_even(pct, 1)).drop("__total")


def recent_mean(df: DataFrame, by: Sequence[str], order: str, ties: Sequence[str], value: str) -> DataFrame:
    """Mean of the last third of the history (at least one row), the final value,
    and the gap between them."""
    r = ranked(df, by, order, ties, total="__n")
    recent = F.greatest(F.lit(1), F.floor(F.col("__n") / 3))
    return (r.groupBy(*by).agg(
        F.avg(F.when(F.col("rn") > F.col("__n") - recent, F.col(value))).alias("recent_mean"),
        F.max(F.when(F.col("rn") == F.col("__n"), F.col(value))).alias("final_value"))
        .withColumn("gap", F.col("recent_mean") - F.col("final_value")))


def closest_gap(df: DataFrame, by: Sequence[str], gap: str, key: str) -> DataFrame:
    """Per group the evaluation with the smallest absolute gap."""
    seen = df.filter(F.col(gap).isNotNull())
    return seen.groupBy(*by).agg(F.min_by(F.struct(key, gap), F.struct(F.abs(gap), F.col(key))).alias("__b")) \
        .select(*by, f"__b.{key}", f"__b.{gap}")


def state_duration(start: str, end: str, now: str) -> Column:
    """Seconds from start to end, or to `now` while open; null before the start."""
    finish = F.coalesce(F.col(end), F.to_timestamp_ntz(F.lit(now)))
    return F.timestamp_diff("MICROSECOND", F.col(start), finish) / 1e6


def next_gap(df: DataFrame, by: Sequence[str], ts: str, ties: Sequence[str], alias: str = "seconds") -> DataFrame:
    """Seconds each state lasted: time to the next row of the group."""
    out = neighbour(df, by, ts, F.col(ts), "__next", ties, ahead=True)
    return out.withColumn(alias, F.timestamp_diff("MICROSECOND", F.col(ts), F.col("__next")) / 1e6).drop("__next")
