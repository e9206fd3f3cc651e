"""Bindings for windows, ordered folds, sorts and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import filters, folds, features, ranking as op
from tallyloom.plans.registry import RUNS_SQL, query, r9, runs, sql_round, table


@query("W01_leaderboard", f"""
    WITH {RUNS_SQL}
    SELECT dataset_id, run_id, f1, place FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY f1 DESC, run_id) AS place
       FROM runs WHERE status = 'trained' AND f1 IS NOT NULL) WHERE place <= 3
""")
def leaderboard(spark, sf):
    trained = runs(spark, sf).filter(F.col("status") == "trained")
    return op.leaderboard(trained, "f1", "run_id", 3, ["dataset_id"]).select("dataset_id", "run_id", "f1", F.col("place").cast("long"))


@query("W02_keep_best", f"""
    WITH {RUNS_SQL}
    SELECT run_id, CASE WHEN row_number() OVER (PARTITION BY dataset_id, algorithm ORDER BY coalesce(acc, 0) DESC, coalesce(f1, 0) DESC, run_id) = 1
      THEN 'keep' ELSE 'duplicate' END AS verdict FROM runs
""")
def keep_best(spark, sf):
    return op.keep_best(runs(spark, sf), ["dataset_id", "algorithm"], ["acc", "f1"], "run_id").select("run_id", "verdict")


@query("W03_keep_latest", """
    WITH j AS (SELECT o_orderkey, o_custkey, o_orderstatus, max((o_orderstatus = 'F')::INT) OVER (PARTITION BY o_custkey) AS trained,
       row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders)
    SELECT o_orderkey, CASE WHEN r > 1 THEN 'draft_duplicate' WHEN trained = 1 THEN 'draft_with_trained_exists' ELSE 'keep' END AS verdict
    FROM j WHERE o_orderstatus = 'O'
""")
def keep_latest(spark, sf):
    return op.keep_latest_draft(table(spark, sf, "orders"), ["o_custkey"], "o_orderstatus", "O", "F",
                                "o_orderdate", "o_orderkey").select("o_orderkey", "verdict")


@query("W04_keep_best_by_task", f"""
    WITH {RUNS_SQL},
    s AS (SELECT *, CASE WHEN created >= TIMESTAMP '2001-01-01' THEN 'other' ELSE status END AS cls,
       CASE WHEN task = 'classification' THEN acc WHEN task = 'regression' THEN coalesce(f1, -999) ELSE coalesce(ind_acc, 0) END AS score FROM runs),
    r AS (SELECT *, count(*) OVER (PARTITION BY dataset_id, algorithm) AS n, row_number() OVER (PARTITION BY dataset_id, algorithm, cls
       ORDER BY CASE WHEN cls = 'trained' THEN score ELSE 0 END DESC, created DESC, run_id) AS rn FROM s)
    SELECT run_id, 'duplicate_' || cls AS category FROM r WHERE n > 1 AND (rn > 1 OR cls = 'other')
""")
def keep_best_by_task(spark, sf):
    df = runs(spark, sf).withColumn("status", F.when(F.col("created") >= F.to_timestamp_ntz(F.lit("2001-01-01 00:00:00")), "archived")
                                    .otherwise(F.col("status")))
    scores = {"classification": F.col("acc"), "regression": F.coalesce("f1", F.lit(-999.0)),
              "clustering": F.coalesce("ind_acc", F.lit(0.0))}
    return op.keep_best_by_task(df, ["dataset_id", "algorithm"], "task", scores, "status", "created", "run_id") \
        .select("run_id", "category")


@query("W05_tolerance_bands", f"""
    WITH RECURSIVE {RUNS_SQL},
    o AS (SELECT dataset_id, run_id, acc, row_number() OVER (PARTITION BY dataset_id ORDER BY acc DESC, coalesce(f1, 0) DESC, run_id) AS rn FROM runs),
    b AS (SELECT dataset_id, run_id, acc, rn, acc AS band, TRUE AS head FROM o WHERE rn = 1
      UNION ALL SELECT o.dataset_id, o.run_id, o.acc, o.rn, CASE WHEN abs(b.band - o.acc) < 0.0001 THEN b.band ELSE o.acc END, NOT abs(b.band - o.acc) < 0.0001
      FROM b JOIN o ON o.dataset_id = b.dataset_id AND o.rn = b.rn + 1)
    SELECT run_id, band, CASE WHEN band >= 0.999 AND min(band) OVER (PARTITION BY dataset_id) < 0.999 THEN 'definite_delete'
      WHEN head THEN 'keep' WHEN band >= 0.999 THEN 'definite_delete' ELSE 'duplicate' END AS action FROM b
""")
def tolerance_bands(spark, sf):
    df = runs(spark, sf).select("dataset_id", "run_id", "acc", "f1")
    return folds.tolerance_bands(df, ["dataset_id"], "acc", "f1", "run_id").select("run_id", "band", "action")


@query("W06_best_flag", f"""
    WITH {RUNS_SQL},
    t AS (SELECT run_id, acc, f1, round(1 - acc, 4) AS loss FROM runs),
    l AS (SELECT run_id, 'acc' AS metric, acc AS value, acc AS s FROM t UNION ALL SELECT run_id, 'f1', f1, f1 FROM t UNION ALL SELECT run_id, 'loss', loss, -loss FROM t)
    SELECT run_id, metric, value, value IS NOT NULL AND row_number() OVER (PARTITION BY metric ORDER BY s DESC NULLS LAST, run_id) = 1 AS is_best FROM l
""")
def best_flag(spark, sf):
    df = runs(spark, sf).withColumn("loss", F.round(1 - F.col("acc"), 4))
    return op.best_flags(df, "run_id", {"acc": True, "f1": True, "loss": False})


@query("W07_rank_results", """
    SELECT event_id, value, rank FROM (SELECT event_id, value, rank() OVER (ORDER BY value DESC) AS rank, row_number() OVER (ORDER BY value DESC, event_id) AS r FROM events)
    WHERE r <= 20
""")
def rank_results(spark, sf):
    return op.rank_results(table(spark, sf, "events").select("event_id", "value"), "value", "event_id") \
        .withColumn("rank", F.col("rank").cast("long"))


@query("W08_running_best", """
    SELECT event_id, max(value) OVER w AS best_score, arg_max(props, value) OVER w AS best_params FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def running_best(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts", "value", "props")
    return op.running_best(ev, ["user_id"], "ts", ["event_id"], "value", "props") \
        .select("event_id", "best_score", "best_params")


@query("W09_early_stop_epoch", """
    WITH RECURSIVE o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    f AS (SELECT user_id, rn, value AS best, 0 AS misses, NULL::BIGINT AS stop FROM o WHERE rn = 1
      UNION ALL SELECT o.user_id, o.rn, CASE WHEN f.stop IS NULL AND o.value < f.best - 0.0001 THEN o.value ELSE f.best END,
        CASE WHEN f.stop IS NOT NULL THEN f.misses WHEN o.value < f.best - 0.0001 THEN 0 ELSE f.misses + 1 END,
        CASE WHEN f.stop IS NOT NULL THEN f.stop WHEN o.value < f.best - 0.0001 THEN NULL WHEN f.misses + 1 >= 5 THEN o.rn END
      FROM f JOIN o ON o.user_id = f.user_id AND o.rn = f.rn + 1)
    SELECT user_id, max(rn) AS epochs, max(stop) AS stop_epoch, min(best) AS best_loss, max(stop) IS NOT NULL AS stopped_early FROM f GROUP BY user_id
""")
def early_stop_epoch(spark, sf):
    return folds.early_stop(table(spark, sf, "events"), ["user_id"], "ts", ["event_id"], "value")


@query("W10_progress_pct", f"""
    WITH p AS (SELECT event_id, row_number() OVER w AS step, least(100.0::DOUBLE, row_number() OVER w / count(*) OVER (PARTITION BY user_id) * 100.0::DOUBLE) AS pct
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT event_id, step, {sql_round("pct", 1)} AS progress_percent FROM p
""")
def progress_pct(spark, sf):
    return op.progress(table(spark, sf, "events").select("event_id", "user_id", "ts"), ["user_id"], "ts", ["event_id"]) \
        .select("event_id", "step", "progress_percent")


@query("W11_tail_n", """
    SELECT conv_id, turn, text, NULL AS tail FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations) WHERE r <= 2
    UNION ALL SELECT doc_id, NULL, NULL, array_to_string(list_slice(l, greatest(1, len(l) - 4), len(l)), chr(10))
    FROM (SELECT doc_id, string_split(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10)) AS l FROM documents)
""")
def tail_n(spark, sf):
    last = op.top_n(table(spark, sf, "conversations"), [F.desc("turn")], 2, ["conv_id"]) \
        .select("conv_id", "turn", "text", F.lit(None).cast("string").alias("tail"))
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("conv_id"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("text"), tx.tail_lines(F.col("text"), 5).alias("tail"))
    return last.unionByName(docs)


@query("W12_recent_mean", """
    WITH o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events)
    SELECT user_id, round(avg(value) FILTER (rn > n - greatest(1, n // 3)), 6) AS recent_mean, max(value) FILTER (rn = n) AS final_value,
      round(avg(value) FILTER (rn > n - greatest(1, n // 3)) - max(value) FILTER (rn = n), 6) AS gap FROM o GROUP BY user_id
""")
def recent_mean(spark, sf):
    out = op.recent_mean(table(spark, sf, "events").select("user_id", "ts", "event_id", "value"),
                         ["user_id"], "ts", ["event_id"], "value")
    return out.withColumns({c: F.round(c, 6) for c in ("recent_mean", "gap")})


@query("W13_first_occurrence", f"""
    WITH {RUNS_SQL}
    SELECT dataset_id, algorithm, run_id FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, algorithm ORDER BY acc, created, run_id) AS r FROM runs) WHERE r = 1
""")
def first_occurrence(spark, sf):
    return runs(spark, sf).groupBy("dataset_id", "algorithm").agg(
        F.min_by("run_id", F.struct("acc", "created", "run_id")).alias("run_id"))


@query("W14_closest_gap", f"""
    WITH {RUNS_SQL}, g AS (SELECT *, round(acc - ind_acc, 4) AS gap FROM runs WHERE ind_acc IS NOT NULL)
    SELECT dataset_id, run_id, gap FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY abs(gap), run_id) AS r FROM g) WHERE r = 1
""")
def closest_gap(spark, sf):
    df = runs(spark, sf).withColumn("gap", F.round(F.col("acc") - F.col("ind_acc"), 4))
    return op.closest_gap(df, ["dataset_id"], "gap", "run_id")


@query("W15_state_duration", """
    SELECT event_id, round(epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - ts) / 1000000.0, 6) AS seconds,
      round(epoch_us(CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-02-01' ELSE ts + INTERVAL 90 SECONDS END - ts) / 1000000.0, 6) AS open_seconds FROM events
""")
def state_duration(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts").withColumn(
        "done", F.when(F.col("event_id") % 3 != 0, F.col("ts") + F.expr("INTERVAL 90 SECONDS")))
    out = op.next_gap(ev, ["user_id"], "ts", ["event_id"])
    return out.select("event_id", F.round("seconds", 6).alias("seconds"),
                      F.round(op.state_duration("ts", "done", "2024-02-01 00:00:00"), 6).alias("open_seconds"))


@query("L01_sort_nulls_last", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS score FROM orders
""")
def sort_nulls_last(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("score"))
    return df.orderBy(*filters.checked_sort("score", ["score", "o_orderkey"], "o_orderkey", "asc", key="o_orderkey"))


@query("L02_topk_classes", """
    WITH v AS (SELECT vec_id, unnest(range(0, len(embedding))) AS class, unnest(list_transform(embedding, lambda x: x::DOUBLE)) AS p FROM embeddings)
    SELECT vec_id, place, class, round(p, 6) AS probability FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) AS place FROM v) WHERE place <= 3
""")
def topk_classes(spark, sf):
    from tallyloom.operators.learn import topk_classes as topk

    df = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("p"))
    return (df.select("vec_id", F.posexplode(topk(F.col("p"), 3)).alias("place", "t"))
            .select("vec_id", (F.col("place") + 1).cast("long").alias("place"), F.col("t.class").cast("long").alias("class"),
                    F.round("t.probability", 6).alias("probability")))


@query("L04_capped_sample", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y, g, round(y - g, 4) AS residual FROM (SELECT *, l_extendedprice AS y, 2000.0 * l_quantity AS g FROM lineitem)
    ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 500
""")
def capped_sample(spark, sf):
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    df = table(spark, sf, "lineitem").select(*keys, F.col("l_extendedprice").alias("y"), (2000.0 * F.col("l_quantity")).alias("g"))
    return op.top_n(df, [F.col(k) for k in keys], 500).withColumn("residual", F.round(F.col("y") - F.col("g"), 4))


@query("L05_recent_n", """
    SELECT o_custkey, o_orderkey, place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders) WHERE place <= 5
""")
def recent_n(spark, sf):
    out = op.top_n(table(spark, sf, "orders"), [F.desc("o_orderdate"), F.asc("o_orderkey")], 5, ["o_custkey"])
    return out.select("o_custkey", "o_orderkey", F.col("place").cast("long").alias("place"))


@query("L06_grouped_report_order", f"""
    WITH {RUNS_SQL}
    SELECT dataset_id, count(*) AS problems FROM runs WHERE acc < 0.93 GROUP BY dataset_id
""")
def grouped_report_order(spark, sf):
    return (runs(spark, sf).filter(F.col("acc") < 0.93).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("problems"))
            .orderBy(F.desc("problems"), "dataset_id"))
