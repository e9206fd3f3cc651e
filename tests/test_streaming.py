"""Streams over several micro-batches give the batch answer."""

import time

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import folds, governance
from tallyloom.streaming import operators as op, run


@pytest.fixture(scope="module")
def folder(events, tmp_path_factory):
    """The events as four files in time order."""
    path = tmp_path_factory.mktemp("stream") / "events"
    cuts = ["2024-01-01", "2024-01-09", "2024-01-16", "2024-01-23", "2025-01-01"]
    for a, b in zip(cuts, cuts[1:]):
        part = events.filter((F.col("ts") >= F.lit(a).cast("timestamp_ntz")) & (F.col("ts") < F.lit(b).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.05)
    return str(path)


@pytest.fixture()
def stream(spark, folder, events):
    return run.stream_table(spark, folder, "*.parquet", events.schema, files_per_trigger=1)


def table(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_several_batches_ran(stream):
    versions = run.versioned(op.latest_state(stream, "user_id", ["ts", "event_id"], ["event_type", "value"]), "t")
    assert versions.select("batch").distinct().count() == 4


def test_latest_state(stream, events):
    out = run.latest_version(run.versioned(op.latest_state(stream, "user_id", ["ts", "event_id"], ["event_type", "value"]), "t"), ["user_id"])
    want = events.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.count(F.lit(1)).alias("n"))
    assert table(out, "user_id", "event_type", "n") == table(want, "user_id", "event_type", "n")


def test_folds_carry_state(stream, events):
    a = run.collected(op.alert_cooldown(stream, ["user_id"], "ts", ["event_id"], 100000), "t")
    assert table(a, "event_id", "sent") == table(folds.alert_cooldown(events, ["user_id"], "ts", ["event_id"], 100000), "event_id", "sent")


def test_rate_limit(stream, events):
    a = run.collected(op.rate_limit(stream, ["user_id"], "ts", ["event_id"], 2, 500000), "t")
    b = folds.rate_limit(events, ["user_id"], "ts", ["event_id"], 2, 500000)
    assert table(a, "event_id", "accepted") == table(b, "event_id", "accepted")


def test_lockout(stream, events):
    kind = F.when(F.col("event_type") == "click", "good").otherwise("bad").alias("kind")
    pick = lambda d: d.select("event_id", "user_id", "ts", kind)
    a = run.collected(op.lockout(pick(stream), ["user_id"], "ts", ["event_id"], "kind", "bad", 3, 5000), "t")
    b = folds.lockout(pick(events), ["user_id"], "ts", ["event_id"], "kind", "bad", 3, 5000)
    assert table(a, "event_id", "outcome") == table(b, "event_id", "outcome")


def test_progress_and_changes(stream, events):
    out = run.collected(op.running_progress(stream, ["user_id"], ["ts", "event_id"], "value", "event_type", 10, keep=3), "t")
    rows = sorted(out.collect(), key=lambda r: (r.user_id, r.step))
    best, last = {}, {}
    for r in rows:
        best[r.user_id] = max(best.get(r.user_id, -1), r.value)
        assert r.best_score == best[r.user_id] and r.progress_percent <= 100.0
        assert r.log_tail.split("\n")[-1] == r.event_type and len(r.log_tail.split("\n")) <= 3
    changed = run.collected(op.emit_on_change(stream, ["user_id"], ["ts", "event_id"], "event_type", F.lit(False)), "t")
    kept = {r.event_id for r in changed.collect()}
    for r in rows:
        assert (r.event_id in kept) == (last.get(r.user_id) != r.event_type)
        last[r.user_id] = r.event_type


def test_expiry_by_event_and_by_timer(stream, events):
    out = run.collected(op.expire_after(stream, "user_id", "ts", ["event_id"], "event_type", ["view", "click"], 86400), "t")
    want, limit = set(), 86400
    rows = sorted(events.collect(), key=lambda r: (r.user_id, r.ts, r.event_id))
    newest = max(r.ts for r in rows)
    for r, n in zip(rows, rows[1:] + [None]):
        if r.event_type in ("view", "click"):
            until = n.ts if n and n.user_id == r.user_id else newest
            if (until - r.ts).total_seconds() > limit + (0 if n and n.user_id == r.user_id else 0.002):
                want.add((r.user_id, r.event_type, r.ts))
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_dedup_across_batches(spark, stream, folder, events):
    twice = stream.union(run.stream_table(spark, folder, "*.parquet", events.schema, files_per_trigger=1))
    out = run.collected(op.stream_dedup(twice, "event_id", "ts", "40 days"), "t")
    assert out.count() == events.count() and out.select("event_id").distinct().count() == events.count()


def test_watchdog_equals_one_pass(stream, events):
    acc = 1 - F.col("value") / 1000
    pick = lambda d: d.select("event_id", acc.alias("acc"), (acc - F.col("value") / 500).alias("f1"), acc.alias("train_acc"), F.lit(1.0).alias("ind_acc"))
    seen = []
    run.drain(pick(stream), "t", op.watchdog(pick(stream), {}, lambda df, b: seen.extend(tuple(r) for r in df.select("event_id", "tier").collect())))
    assert sorted(seen) == table(governance.with_tier(pick(events)), "event_id", "tier")


def test_a_table_of_several_files_streams_whole(spark, tmp_path):
    """A table is a folder of files as often as one file, and may be without rows."""
    from tallyloom.plans import QUERIES, load_all

    load_all()
    said = [(i // 3, i % 3, f"<b>hello {i}</b>" if i % 2 else f"casino {i}") for i in range(30)]
    for name, rows in (("some", said), ("none", [])):
        spark.createDataFrame(rows, "conv_id long, turn int, text string").repartition(4).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
        got = QUERIES["T13_moderation_stream"](spark, f"{tmp_path}/{name}").collect()
        want = [(c, t, f"hello {3 * c + t}", None) if (3 * c + t) % 2 else (c, t, f"casino {3 * c + t}", "auto_filtered:casino") for c, t, _ in rows]
        assert sorted(map(tuple, got)) == sorted(want)
