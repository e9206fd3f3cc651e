"""Streaming operators on job and event streams.

Stateful rules share their step functions with the batch folds, so a stream and
a batch over the same rows give the same answer. State per key is small (a count,
a time, at most `max_calls` times or `keep` lines) and is dropped when a key has been
silent for a stated time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from tallyloom.functions import text as tx
from tallyloom.operators import folds, governance
from tallyloom.operators.folds import Step


def metric_stream(stream: DataFrame, payload: str, schema: str, keep: Sequence[str]) -> DataFrame:
    """Typed metric rows from a JSON payload."""
    return stream.select(*keep, F.from_json(payload, schema).alias("__p")).select(*keep, "__p.*")


def latest_state(stream: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Current state per key (update mode): the row with the largest order."""
    return stream.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("__s"),
                                   F.count(F.lit(1)).alias("n")).select(key, "n", "__s.*")


def stateful(stream: DataFrame, keys: Sequence[str], sort: Sequence[str], inputs: Sequence[str], step: Step,
             added: str, forget: float = 7 * 86_400) -> DataFrame:
    """Apply a fold step along arrival: rows of a micro-batch are taken in the
    order of `sort`, whose first column is the event time; the state carries over
    between micro-batches. Rows older than the newest by more than `forget` seconds
    are late and dropped, and a key without rows for that long loses its state, so
    choose more than the rule looks back. The source's limit on files per trigger
    bounds a key's rows in a micro-batch."""
    fields = StructType(stream.schema.fields + StructType.fromDDL(added).fields)
    names = StructType.fromDDL(added).fieldNames()
    order, columns = list(sort), list(inputs)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        memory = json.loads(state.get[0]) if state.exists else {}
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        got = [step(memory, *values) for values in zip(*[rows[c].tolist() for c in columns], strict=True)]
        state.update((json.dumps(memory),))
        newest = int(rows["__t"].max().timestamp() * 1000) + int(forget * 1000)
        state.setTimeoutTimestamp(max(newest, state.getCurrentWatermarkMs() + 1))
        rows = rows.drop(columns="__t")
        yield pd.concat([rows, pd.DataFrame(got, columns=names, index=rows.index, dtype=object)], axis=1)

    timed = stream.withColumn("__t", F.col(order[0]).cast("timestamp")).withWatermark("__t", f"{int(forget)} seconds")
    return timed.groupBy(*keys).applyInPandasWithState(
        run, fields, StructType.fromDDL("memory string"), "append", GroupStateTimeout.EventTimeTimeout)


def emit_on_change(stream: DataFrame, keys: Sequence[str], sort: Sequence[str], step: str, terminal: Column) -> DataFrame:
    """Forward a row when its step differs from the last one, or is terminal."""
    def changed(state, value):
        new = state.get("last") != value
        state["last"] = value
        return (new,)

    rows = stateful(stream, keys, sort, [step], changed, "__changed boolean")
    return rows.filter(F.col("__changed") | terminal).drop("__changed")


def progress_step(total: int, keep: int = 50) -> Step:
    """step, percent, best score so far, and the last `keep` log lines."""
    def step(state, score, line):
        state["step"] = state.get("step", 0) + 1
        if "best" not in state or score > state["best"]:
            state["best"] = score
        state["log"] = (state.get("log", []) + [line])[-keep:]
        return state["step"], round(min(100.0, state["step"] / total * 100), 1), state["best"], "\n".join(state["log"])
    return step


def running_progress(stream: DataFrame, keys: Sequence[str], sort: Sequence[str], score: str, line: str, total: int,
                     keep: int = 50) -> DataFrame:
    return stateful(stream, keys, sort, [score, line], progress_step(total, keep),
                    "step bigint, progress_percent double, best_score double, log_tail string")


def with_micros(stream: DataFrame, ts: str) -> DataFrame:
    return stream.withColumn("__us", folds.micros(ts))


def alert_cooldown(stream: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], cooldown: float = 3600) -> DataFrame:
    return stateful(with_micros(stream, ts), keys, [ts, *ties], ["__us"], folds.cooldown_step(cooldown), "sent boolean").drop("__us")


def rate_limit(stream: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], max_calls: int = 60, period: float = 60) -> DataFrame:
    return stateful(with_micros(stream, ts), keys, [ts, *ties], ["__us"], folds.rate_limit_step(max_calls, period),
                    "accepted boolean, retry_after bigint").drop("__us")


def lockout(stream: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], kind: str, failure: str,
            max_failures: int = 5, minutes: float = 15) -> DataFrame:
    return stateful(with_micros(stream, ts), keys, [ts, *ties], ["__us", kind],
                    folds.lockout_step(failure, max_failures, minutes), "outcome string").drop("__us")


def idle_sessions(stream: DataFrame, key: str, ts: str, gap: str = "15 seconds", delay: str = "0 seconds") -> DataFrame:
    """Stretches of activity per key, closed when nothing arrives for `gap`; the
    heartbeat falls at `idle_at`."""
    timed = stream.withColumn("__t", F.col(ts).cast("timestamp")).withWatermark("__t", delay)
    return (timed.groupBy(F.session_window("__t", gap).alias("w"), F.col(key)).agg(F.count(F.lit(1)).alias("n"))
            .select(key, F.col("w.start").alias("started_at"), F.col("w.end").alias("idle_at"), "n"))


def expire_after(stream: DataFrame, key: str, ts: str, ties: Sequence[str], status: str, states: Sequence[str],
                 seconds: float, delay: str = "0 seconds") -> DataFrame:
    """(key, status, since) whenever a key stays in one of `states` for longer
    than `seconds`: seen at its next event, or by timer once the watermark passes.
    State is dropped with the timer, so finished keys do not pile up."""
    watch, limit = set(states), int(seconds * 1_000_000)
    names, order = [key, status, "since_us"], ["__us", *ties]

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        if state.hasTimedOut:
            last = json.loads(state.get[0])
            if last["status"] in watch:
                out.append((k[0], last["status"], last["us"]))
            state.remove()
        else:
            last = json.loads(state.get[0]) if state.exists else None
            rows = pd.concat(list(batches)).sort_values(order, kind="stable")
            for us, value in zip(rows["__us"].tolist(), rows[status].tolist(), strict=True):
                if last and last["status"] in watch and us - last["us"] > limit:
                    out.append((k[0], last["status"], last["us"]))
                last = {"us": us, "status": value}
            state.update((json.dumps(last),))
            due = last["us"] // 1000 + limit // 1000 + 1
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=names)

    key_type, status_type = stream.schema[key].dataType.simpleString(), stream.schema[status].dataType.simpleString()
    timed = with_micros(stream, ts).withColumn("__t", F.col(ts).cast("timestamp")).withWatermark("__t", delay)
    rows = timed.groupBy(key).applyInPandasWithState(
        run, StructType.fromDDL(f"`{key}` {key_type}, `{status}` {status_type}, since_us bigint"),
        StructType.fromDDL("memory string"), "append", GroupStateTimeout.EventTimeTimeout)
    return rows.select(key, status, F.timestamp_micros("since_us").cast("timestamp_ntz").alias("since"))


def stream_dedup(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """One event per id within the watermark delay."""
    return (stream.withColumn("__t", F.col(ts).cast("timestamp")).withWatermark("__t", delay)
            .dropDuplicatesWithinWatermark([key]).drop("__t"))


def watchdog(stream: DataFrame, columns: dict, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Batch handler: tier the changed runs and hand them to `sink`."""
    def handle(df: DataFrame, batch: int) -> None:
        sink(governance.with_tier(df, **columns), batch)
    return handle


def moderated(stream: DataFrame, text: str, patterns: Sequence[str]) -> DataFrame:
    """Clean text and moderation reason per message (null reason is visible); the
    whole text is judged and kept."""
    clean = stream.withColumn("content", tx.strip_html(F.col(text)))
    return clean.withColumn("reason", tx.moderate(F.col("content"), patterns)).withColumn("is_visible", F.col("reason").isNull())


def route(visible: str, hidden: str) -> Callable[[DataFrame, int], None]:
    """Batch handler writing visible and hidden messages to their own folders;
    a replayed batch overwrites itself."""
    def handle(df: DataFrame, batch: int) -> None:
        df.persist()
        df.filter("is_visible").write.mode("overwrite").parquet(f"{visible}/batch={batch}")
        df.filter("NOT is_visible").write.mode("overwrite").parquet(f"{hidden}/batch={batch}")
        df.unpersist()
    return handle


def windowed_counts(stream: DataFrame, ts: str, by: Sequence[str], width: str, slide: str | None = None,
                    delay: str = "10 minutes") -> DataFrame:
    """Tumbling or sliding event-time counts under a watermark (a convenience)."""
    timed = stream.withColumn("__t", F.col(ts).cast("timestamp")).withWatermark("__t", delay)
    return timed.groupBy(F.window("__t", width, slide), *by).agg(F.count(F.lit(1)).alias("n"))
