"""Bindings for streaming: each runs the stream over all available files and is
compared with the batch statement; the folds are registered as batch twins too."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import folds, learn, ranking, sampling
from tallyloom.plans.registry import EVENTS_SQL, query, table
from tallyloom.plans.scalars import BANNED
from tallyloom.session import scratch_path
from tallyloom.sources.readers import union_all
from tallyloom.streaming import operators as op, run


def stream(spark, sf, name):
    return run.stream_table(spark, sf, f"{name}.parquet", table(spark, sf, name).schema, files_per_trigger=16)


@query("T01_metric_stream", f"WITH {EVENTS_SQL} SELECT event_id, user_id, k FROM ev")
def metric_stream(spark, sf):
    return run.collected(op.metric_stream(stream(spark, sf, "events"), "props", "k INT", ["event_id", "user_id"]), "t01")


@query("T02_latest_state", """
    SELECT user_id, count(*) AS n, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id
""")
def latest_state(spark, sf):
    states = op.latest_state(stream(spark, sf, "events"), "user_id", ["ts", "event_id"], ["event_type", "value"])
    return run.latest_version(run.versioned(states, "t02"), ["user_id"])


@query("T03_emit_on_change", """
    SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    WHERE p IS NULL OR p <> event_type OR event_type = 'purchase'
""")
def emit_on_change(spark, sf):
    ev = stream(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    out = op.emit_on_change(ev, ["user_id"], ["ts", "event_id"], "event_type", F.col("event_type") == "purchase")
    return run.collected(out, "t03").select("event_id", "user_id", "event_type")


@query("T04_idle_timeout", """
    WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR lag(ts) OVER w + INTERVAL 6 HOURS <= ts THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g),
    a AS (SELECT user_id, min(ts) AS started_at, max(ts) + INTERVAL 6 HOURS AS idle_at, count(*) AS n FROM i GROUP BY user_id, sid)
    SELECT * FROM a WHERE idle_at <= (SELECT date_trunc('milliseconds', max(ts)) FROM events)
""")
def idle_timeout(spark, sf):
    out = run.collected(op.idle_sessions(stream(spark, sf, "events"), "user_id", "ts", "6 hours"), "t04")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started_at", "idle_at")})


@query("T05_running_progress", """
    SELECT event_id, row_number() OVER w AS step, round(least(100.0::DOUBLE, row_number() OVER w / 40.0::DOUBLE * 100), 1) AS progress_percent, max(value) OVER w AS best_score,
      array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS 49 PRECEDING), chr(10)) AS log_tail
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def running_progress(spark, sf):
    ev = stream(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    out = op.running_progress(ev, ["user_id"], ["ts", "event_id"], "value", "event_type", 40)
    return run.collected(out, "t05").select("event_id", "step", "progress_percent", "best_score", "log_tail")


COOLDOWN_SQL = """
    WITH RECURSIVE e AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type = 'error'),
    f AS (SELECT event_id, user_id, rn, ts AS last, TRUE AS sent FROM e WHERE rn = 1
      UNION ALL SELECT e.event_id, e.user_id, e.rn, CASE WHEN e.ts - f.last >= INTERVAL 12 HOURS THEN e.ts ELSE f.last END, e.ts - f.last >= INTERVAL 12 HOURS
      FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, sent FROM f
"""


@query("T06_alert_cooldown", COOLDOWN_SQL)
def alert_cooldown(spark, sf):
    errors = stream(spark, sf, "events").filter("event_type = 'error'").select("event_id", "user_id", "ts")
    return run.collected(op.alert_cooldown(errors, ["user_id"], "ts", ["event_id"], 12 * 3600), "t06").select("event_id", "sent")


@query("T06_alert_cooldown_batch", COOLDOWN_SQL)
def alert_cooldown_batch(spark, sf):
    errors = table(spark, sf, "events").filter("event_type = 'error'").select("event_id", "user_id", "ts")
    return folds.alert_cooldown(errors, ["user_id"], "ts", ["event_id"], 12 * 3600).select("event_id", "sent")


LIMIT_SQL = """
    WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    f AS (SELECT event_id, user_id, rn, us, [us] AS calls, TRUE AS accepted, NULL::BIGINT AS first FROM e WHERE rn = 1
      UNION ALL SELECT e.event_id, e.user_id, e.rn, e.us,
        CASE WHEN len(list_filter(f.calls, lambda c: c > e.us - 86400000000)) >= 3 THEN list_filter(f.calls, lambda c: c > e.us - 86400000000)
             ELSE list_append(list_filter(f.calls, lambda c: c > e.us - 86400000000), e.us) END,
        len(list_filter(f.calls, lambda c: c > e.us - 86400000000)) < 3, list_filter(f.calls, lambda c: c > e.us - 86400000000)[1]
      FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, accepted, CASE WHEN NOT accepted THEN CAST(floor((first - us) / 1000000.0 + 86400) AS BIGINT) + 1 END AS retry_after FROM f
"""


@query("T07_rate_limit", LIMIT_SQL)
def rate_limit(spark, sf):
    ev = stream(spark, sf, "events").select("event_id", "user_id", "ts")
    return run.collected(op.rate_limit(ev, ["user_id"], "ts", ["event_id"], 3, 86400), "t07").select("event_id", "accepted", "retry_after")


@query("T07_rate_limit_batch", LIMIT_SQL)
def rate_limit_batch(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return folds.rate_limit(ev, ["user_id"], "ts", ["event_id"], 3, 86400).select("event_id", "accepted", "retry_after")


LOCK_SQL = """
    WITH RECURSIVE e AS (SELECT event_id, user_id, ts, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE event_type IN ('error', 'view', 'click')),
    f AS (SELECT event_id, user_id, rn, (event_type <> 'click')::INT AS fails, NULL::TIMESTAMP AS until, CASE WHEN event_type = 'click' THEN 'ok' ELSE 'failed' END AS outcome FROM e WHERE rn = 1
      UNION ALL SELECT e.event_id, e.user_id, e.rn,
        CASE WHEN f.until > e.ts THEN f.fails WHEN e.event_type = 'click' THEN 0 ELSE f.fails + 1 END,
        CASE WHEN f.until > e.ts THEN f.until WHEN e.event_type = 'click' THEN NULL WHEN f.fails + 1 >= 5 THEN e.ts + INTERVAL 900 MINUTES ELSE f.until END,
        CASE WHEN f.until > e.ts THEN 'rejected' WHEN e.event_type = 'click' THEN 'ok' WHEN f.fails + 1 >= 5 THEN 'locked' ELSE 'failed' END
      FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
    SELECT event_id, outcome FROM f
"""


def attempts(df):
    kept = df.filter(F.col("event_type").isin("error", "view", "click"))
    return kept.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "click", "success").otherwise("failure").alias("kind"))


@query("T08_lockout", LOCK_SQL)
def lockout(spark, sf):
    out = op.lockout(attempts(stream(spark, sf, "events")), ["user_id"], "ts", ["event_id"], "kind", "failure", minutes=900)
    return run.collected(out, "t08").select("event_id", "outcome")


@query("T08_lockout_batch", LOCK_SQL)
def lockout_batch(spark, sf):
    return folds.lockout(attempts(table(spark, sf, "events")), ["user_id"], "ts", ["event_id"], "kind", "failure", minutes=900) \
        .select("event_id", "outcome")


@query("T09_incremental_watchdog", """
    WITH e AS (SELECT event_type, value, 1 - value / 1000 AS acc FROM events)
    SELECT CASE WHEN acc = 1 OR (value < 5 AND event_type = 'error') THEN 'definite_delete'
      WHEN (acc - (acc - value / 500) > 0.15 OR acc >= 0.999) AND acc >= 0.95 THEN 'high_risk_delete'
      WHEN acc - (acc - value / 500) > 0.15 THEN 'warning_only' ELSE 'healthy' END AS tier, count(*) AS n FROM e GROUP BY 1
""")
def incremental_watchdog(spark, sf):
    """Runs arrive as events: accuracy 1 - value/1000, F1 lower by value/500;
    errors with a tiny value count as constant predictors."""
    acc = 1 - F.col("value") / 1000
    rows = stream(spark, sf, "events").select("event_id", acc.alias("acc"), (acc - F.col("value") / 500).alias("f1"), acc.alias("train_acc"),
                                              F.lit(1.0).alias("ind_acc"), ((F.col("value") < 5) & (F.col("event_type") == "error")).alias("constant"))
    out = scratch_path(spark, "t09")

    def sink(df, batch):
        df.select("event_id", "tier").write.mode("overwrite").parquet(f"{out}/batch={batch}")

    handler = op.watchdog(rows, {"constant": F.col("constant")}, sink)
    run.drain(rows, "t09", handler, path=out)
    return spark.read.schema("event_id BIGINT, tier STRING, batch BIGINT").parquet(out).groupBy("tier").agg(F.count(F.lit(1)).alias("n"))


@query("T10_stale_after", """
    WITH n AS (SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events)
    SELECT user_id, event_type, ts AS since FROM n WHERE event_type IN ('view', 'click') AND (nx - ts > INTERVAL 24 HOURS
      OR (nx IS NULL AND epoch_ms(ts) + 86400001 <= epoch_ms((SELECT max(ts) FROM events))))
""")
def stale_after(spark, sf):
    ev = stream(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return run.collected(op.expire_after(ev, "user_id", "ts", ["event_id"], "event_type", ["view", "click"], 86400), "t10")


@query("T11_expire_finished", """
    WITH n AS (SELECT user_id, event_type, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM events)
    SELECT user_id, event_type, ts AS since FROM n WHERE event_type = 'purchase' AND (nx - ts > INTERVAL 1 HOURS
      OR (nx IS NULL AND epoch_ms(ts) + 3600001 <= epoch_ms((SELECT max(ts) FROM events))))
""")
def expire_finished(spark, sf):
    ev = stream(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return run.collected(op.expire_after(ev, "user_id", "ts", ["event_id"], "event_type", ["purchase"], 3600), "t11")


@query("T12_stream_dedup", "SELECT event_id, user_id, value FROM events")
def stream_dedup(spark, sf):
    ev = stream(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    twice = ev.union(stream(spark, sf, "events").select("event_id", "user_id", "ts", "value"))
    return run.collected(op.stream_dedup(twice, "event_id", "ts"), "t12").select("event_id", "user_id", "value")


@query("T13_moderation_stream", """
    WITH t AS (SELECT conv_id, turn, regexp_replace(regexp_replace(text, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS content FROM conversations)
    SELECT conv_id, turn, content, CASE WHEN regexp_matches(content, '^\\s*$') THEN 'empty_content'
       WHEN regexp_matches(content, 'casino', 'i') THEN 'auto_filtered:casino' WHEN regexp_matches(content, 'cheap.{0,20}pills', 'i') THEN 'auto_filtered:cheap.{0,20}pills'
       WHEN regexp_matches(content, '[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}', 'i') THEN 'auto_filtered:[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}'
       WHEN regexp_matches(content, 'license', 'i') THEN 'auto_filtered:license' WHEN regexp_matches(content, 'tion.*tion', 'i') THEN 'auto_filtered:tion.*tion'
       WHEN regexp_matches(content, 'https?://', 'i') THEN 'auto_filtered:https?://' END AS reason FROM t
""")
def moderation_stream(spark, sf):
    rows = op.moderated(stream(spark, sf, "conversations"), "text", BANNED)
    base = scratch_path(spark, "t13")
    run.drain(rows, "t13", op.route(f"{base}/visible", f"{base}/hidden"), path=base)
    schema = rows.schema.add("batch", "long")
    return union_all([spark.read.schema(schema).parquet(f"{base}/{side}") for side in ("visible", "hidden")]) \
        .select("conv_id", "turn", "content", "reason")


@query("T14_streaming_scoring")
def streaming_scoring(spark, sf):
    v = learn.as_vectors(table(spark, sf, "embeddings"), "embedding")
    model = learn.make("logistic_regression", 10, maxIter=10).fit(v)
    arriving = learn.as_vectors(stream(spark, sf, "embeddings"), "embedding")
    return run.collected(model.transform(arriving).select("vec_id", "label", "prediction"), "t14")
