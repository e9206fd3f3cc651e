"""Sliced ranks, scans and folds equal a plain sequential pass, hot keys included."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import folds, ordered, sampling

SCHEMA = "k string, id long, ts timestamp_ntz, v double, kind string"


@pytest.fixture(scope="module")
def rows():
    from datetime import datetime, timedelta

    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(1500):
        key = "hot" if i % 3 else f"cold{i % 17}"  # one key owns two thirds
        ts = start + timedelta(seconds=rng.randrange(0, 40000) // 3 * 3)  # with ties
        out.append((None if i % 100 == 0 else key, i, ts, round(rng.random(), 3), rng.choice(["ok", "bad", "bad", "bad"])))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def groups(rows, reverse=False):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("n", [1, 3, 16])
def test_ranked(df, rows, n):
    got = {r.id: (r.rn, r.n) for r in ordered.ranked(df, ["k"], "ts", ["id"], total="n", n=n).collect()}
    want = {r[1]: (i + 1, len(g)) for g in groups(rows).values() for i, r in enumerate(g)}
    assert got == want


def test_ranked_descending(df, rows):
    got = {r.id: r.rn for r in ordered.ranked(df, ["k"], "v", ["id"], descending=True, n=9).collect()}
    want = {}
    for g in groups(rows).values():
        for i, r in enumerate(sorted(g, key=lambda r: (-r[3], r[1]))):
            want[r[1]] = i + 1
    assert got == want


def test_running_max_and_neighbour(df, rows):
    run = {r.id: r.m for r in ordered.running_max(df, ["k"], "ts", F.col("v"), "m", ["id"], n=11).collect()}
    back = {r.id: r.p for r in ordered.neighbour(df, ["k"], "ts", F.col("id"), "p", ["id"], n=11).collect()}
    ahead = {r.id: r.p for r in ordered.neighbour(df, ["k"], "ts", F.col("id"), "p", ["id"], ahead=True, n=11).collect()}
    for g in groups(rows).values():
        best = 0.0
        for i, r in enumerate(g):
            best = max(best, r[3])
            assert run[r[1]] == best
            assert back[r[1]] == (g[i - 1][1] if i else None)
            assert ahead[r[1]] == (g[i + 1][1] if i + 1 < len(g) else None)


def test_first_by_hash_is_exact_and_stable(spark, df):
    quota = spark.createDataFrame([("hot", 333), ("cold3", 5), ("cold0", 10**6)], "k string, __limit long")
    picked = lambda d: sorted(r.id for r in sampling.first_by_hash(d, ["k"], "id", quota).filter("chosen").collect()
                              if r.k in ("hot", "cold3", "cold0"))
    first = picked(df)
    assert first == picked(df.repartition(13))
    keys = {r.id: r.k for r in df.collect()}
    assert sum(keys[i] == "hot" for i in first) == 333
    assert sum(keys[i] == "cold3" for i in first) == 5
    assert sum(keys[i] == "cold0" for i in first) == sum(k == "cold0" for k in keys.values())
    marked = sampling.first_by_hash(df, ["k"], "id", quota)
    assert marked.count() == df.count()


def sequential(rows, step, values):
    out = {}
    for g in groups(rows).values():
        state = {}
        for r in g:
            state = json.loads(json.dumps(state))
            out[r[1]] = step(state, *values(r))
    return out


def us(r):
    from datetime import datetime

    return int((r[2] - datetime(1970, 1, 1)).total_seconds()) * 1_000_000


@pytest.mark.parametrize("max_rows", [10**6, 100])
def test_folds_match_a_sequential_pass(df, rows, max_rows):
    kw = {"max_rows": max_rows, "slices": 7}
    cool = folds.alert_cooldown(df, ["k"], "ts", ["id"], 600, **kw)
    assert {r.id: (r.sent,) for r in cool.collect()} == sequential(rows, folds.cooldown_step(600), lambda r: (us(r),))
    rate = folds.rate_limit(df, ["k"], "ts", ["id"], 4, 120, **kw)
    assert {r.id: (r.accepted, r.retry_after) for r in rate.collect()} == \
        sequential(rows, folds.rate_limit_step(4, 120), lambda r: (us(r),))
    lock = folds.lockout(df, ["k"], "ts", ["id"], "kind", "bad", 3, 5, **kw)
    assert {r.id: (r.outcome,) for r in lock.collect()} == \
        sequential(rows, folds.lockout_step("bad", 3, 5), lambda r: (us(r), r[4]))


@pytest.mark.parametrize("max_rows", [10**6, 100])
def test_bands_and_early_stop(df, rows, max_rows):
    kw = {"max_rows": max_rows, "slices": 5}
    got = {r.id: (r.band, r.action) for r in
           folds.tolerance_bands(df.withColumn("f", F.lit(None).cast("double")), ["k"], "v", "f", "id", width=0.01, perfect=0.9, **kw).collect()}
    for g in groups(rows).values():
        head, heads, want = None, [], {}
        for r in sorted(g, key=lambda r: (-r[3], r[1])):
            new = head is None or not abs(head - r[3]) < 0.01
            head = r[3] if new else head
            heads.append(head)
            want[r[1]] = (head, new)
        lower = min(heads) < 0.9
        for i, (band, new) in want.items():
            action = "definite_delete" if band >= 0.9 and lower else "keep" if new else "definite_delete" if band >= 0.9 else "duplicate"
            assert got[i] == (band, action)
    stops = {r.k: (r.epochs, r.stop_epoch, r.best_loss) for r in folds.early_stop(df, ["k"], "ts", ["id"], "v", 3, **kw).collect()}
    for k, g in groups(rows).items():
        best, misses, stop = None, 0, None
        for i, r in enumerate(g, 1):
            if stop is None:
                if best is None or r[3] < best - 1e-4:
                    best, misses = r[3], 0
                else:
                    misses += 1
                    stop = i if misses >= 3 else None
        assert stops[k] == (len(g), stop, best)


def test_epochs_without_a_loss_do_not_stop_a_run(spark):
    rows = [("a", 1, 1, None), ("a", 2, 2, 0.5), ("a", 3, 3, float("nan")), ("a", 4, 4, 0.4), ("a", 5, 5, 0.3)]
    df = spark.createDataFrame(rows, "k string, t long, id long, v double")
    row = folds.early_stop(df, ["k"], "t", ["id"], "v", patience=2).first()
    assert (row.epochs, row.stop_epoch, row.best_loss) == (3, None, 0.3)


def test_hot_order_value_is_cut_along_its_ties(spark):
    rows = [("a", i, 5 if i % 4 else i % 50, float(i)) for i in range(2000)]  # one value owns three quarters
    df = spark.createDataFrame(rows, "k string, id long, o long, v double")
    up = {r.id: r.rn for r in ordered.ranked(df, ["k"], "o", ["id"], n=16).collect()}
    down = {r.id: r.rn for r in ordered.ranked(df, ["k"], "o", ["id"], descending=True, n=16).collect()}
    assert [i for _, i, _, _ in sorted(rows, key=lambda r: (r[2], r[1]))] == sorted(up, key=up.get)
    assert [i for _, i, _, _ in sorted(rows, key=lambda r: (-r[2], r[1]))] == sorted(down, key=down.get)
    largest = ordered.sliced(df, "o", n=16, ties=["id"]).groupBy(ordered.SLICE).count().agg(F.max("count")).first()[0]
    assert largest < 2000 / 16 * 3
    back = {r.id: r.p for r in ordered.neighbour(df, ["k"], "o", F.col("id"), "p", ["id"], n=16).collect()}
    order = sorted(up, key=up.get)
    assert all(back[b] == a for a, b in zip(order, order[1:])) and back[order[0]] is None
