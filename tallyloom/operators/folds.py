"""Sequential folds per key whose state depends on earlier decisions.

Rows are hash-partitioned by key and sorted; one Python pass per task walks
Arrow batches, keeping only the current key's state. Keys above MAX_ROWS rows are
cut into slices along the order first. All slices fold in parallel from a guessed
entry state, then only those whose guess differs from the end state of the slice
before are folded again, until nothing changes. The result equals a single pass;
states forget quickly, so a round or two is usual.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.ordered import SLICE, on_keys, sliced
from tallyloom.session import cut_lineage

MAX_ROWS = 500_000
Step = Callable[..., tuple]  # step(state, *inputs) -> added values; mutates state


def walk(df: DataFrame, keys: Sequence[str], sort: Sequence[Column], inputs: Sequence[str],
         step: Step, added: str, entry: str | None = None, ends: bool = False) -> DataFrame:
    """One pass over sorted groups. With `ends` only (group, exit state) comes
    out, else every row with the added columns."""
    tag = F.to_json(F.struct(*keys))
    rows = (df.withColumn("__tag", tag).repartition(*[F.col(k) for k in keys])
            .sortWithinPartitions("__tag", *sort))
    new = StructType.fromDDL(added)
    names = new.fieldNames()
    drop = ["__tag"] + ([entry] if entry else [])
    if ends:
        schema = StructType(rows.select(*keys, *([entry] if entry else [])).schema.fields).add("__exit", "string")
    else:
        schema = StructType(rows.drop(*drop).schema.fields + new.fields)

    def run(batches):
        current, state, first = None, {}, None
        for pdf in batches:
            tags = pdf["__tag"].tolist()
            starts = pdf[entry].tolist() if entry else None
            columns = [pdf[c].tolist() for c in inputs]
            out, closed = [], []
            for i, values in enumerate(zip(*columns, strict=True)):
                if tags[i] != current:
                    if ends and current is not None:
                        closed.append(first.assign(__exit=json.dumps(state, sort_keys=True)))
                    current = tags[i]
                    state = json.loads(starts[i]) if starts else {}
                    if ends:
                        first = pdf.iloc[i:i + 1][schema.fieldNames()[:-1]]
                got = step(state, *values)
                if not ends:
                    out.append(got)
            if not ends:
                extra = pd.DataFrame(out, columns=names, index=pdf.index, dtype=object)
                yield pd.concat([pdf.drop(columns=drop), extra], axis=1)
            elif closed:
                yield pd.concat(closed)
        if ends and current is not None:
            yield first.assign(__exit=json.dumps(state, sort_keys=True))

    return rows.mapInPandas(run, schema)


def fold_by_key(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], inputs: Sequence[str],
                step: Step, added: str, *, descending: bool = False, max_rows: int = MAX_ROWS,
                slices: int | None = None) -> DataFrame:
    """Rows of `df` plus the columns `step(state, *inputs)` returns along `order`,
    `ties`. `state` starts as {} and must survive JSON."""
    keys = list(keys)
    sort = [F.col(order).desc() if descending else F.col(order).asc(), *[F.col(t).asc() for t in ties]]
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > max_rows)
    if hot.isEmpty():
        return walk(df, keys, sort, inputs, step, added)

    marked = on_keys(sliced(df, order, n=slices, ties=ties, descending=descending), hot.select(*keys, F.lit(True).alias("__hot")), keys, "left")
    cold = marked.filter(F.col("__hot").isNull()).drop("__hot", SLICE)
    rows = cut_lineage(marked.filter(F.col("__hot")).drop("__hot"), "fold-rows")
    cell = keys + [SLICE]

    def fold_ends(entries: DataFrame) -> DataFrame:
        return walk(on_keys(rows, entries, cell), cell, sort, inputs, step, added, "__entry", ends=True)

    before = W.partitionBy(*keys).orderBy(F.col(SLICE).desc() if descending else F.col(SLICE))
    ends = cut_lineage(fold_ends(rows.select(*cell).distinct().withColumn("__entry", F.lit("{}"))), "fold-ends")
    while True:
        wanted = ends.withColumn("__want", F.coalesce(F.lag("__exit").over(before), F.lit("{}")))
        right = F.col("__want") == F.col("__entry")
        stale = wanted.filter(~right)
        if stale.isEmpty():
            break
        again = fold_ends(stale.select(*cell, F.col("__want").alias("__entry")))
        ends = cut_lineage(wanted.filter(right).drop("__want").unionByName(again), "fold-ends")
    done = walk(on_keys(rows, ends.select(*cell, "__entry"), cell), cell, sort, inputs, step, added, "__entry")
    return done.drop(SLICE).unionByName(walk(cold, keys, sort, inputs, step, added))


def micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def tolerance_bands(df: DataFrame, keys: Sequence[str], value: str, second: str, key: str,
                    width: float = 1e-4, perfect: float = 0.999, **kw) -> DataFrame:
    """Sort by value, open a new band when a row is at least `width` below the
    band's first row, keep one row per band; perfect bands go altogether when a
    lower band exists. Adds `band` (head value) and `action`."""
    def step(state, v):
        head = state.get("head")
        opens = head is None or not abs(head - v) < width
        if opens:
            state["head"] = v
        return state["head"], opens

    present = df.filter(F.col(value).isNotNull()).withColumn("__second", -F.coalesce(F.col(second), F.lit(0.0)))
    # written once: the rows and the lowest heads are both read from it
    banded = cut_lineage(fold_by_key(present, keys, value, ["__second", key], [value], step,
                                     "band double, is_head boolean", descending=True, **kw), "bands")
    # a lower band exists exactly when some value is not within `width` of a perfect head
    # and below `perfect`; the lowest head per key decides
    heads = banded.filter("is_head").groupBy(*keys).agg((F.min("band") < perfect).alias("__lower"))
    top = F.col("band") >= perfect
    return (on_keys(banded, heads, keys)
            .withColumn("action", F.when(top & F.col("__lower"), "definite_delete")
                        .when(F.col("is_head"), "keep").when(top, "definite_delete").otherwise("duplicate"))
            .drop("__lower", "is_head", "__second"))


def early_stop(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], loss: str,
               patience: int = 5, min_delta: float = 1e-4, **kw) -> DataFrame:
    """Per key: epochs run, whether it stopped early, the stop epoch and best loss.
    Epochs without a loss (null or NaN) are left out."""
    df = df.filter(F.col(loss).isNotNull() & ~F.isnan(F.col(loss).cast("double")))
    def step(state, v):
        state["epoch"] = state.get("epoch", 0) + 1
        if state.get("stop") is None:
            if "best" not in state or v < state["best"] - min_delta:
                state["best"], state["misses"] = v, 0
            else:
                state["misses"] += 1
                if state["misses"] >= patience:
                    state["stop"] = state["epoch"]
        return state["epoch"], state.get("stop"), state["best"]

    rows = fold_by_key(df.select(*keys, order, *ties, loss), keys, order, ties, [loss], step,
                       "epochs bigint, stop_epoch bigint, best_loss double", **kw)
    last = rows.groupBy(*keys).agg(F.max_by(F.struct("epochs", "stop_epoch", "best_loss"), "epochs").alias("s"))
    return last.select(*keys, "s.epochs", "s.stop_epoch", "s.best_loss",
                       F.col("s.stop_epoch").isNotNull().alias("stopped_early"))


def alert_cooldown(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], cooldown: float = 3600, **kw) -> DataFrame:
    """`sent`: the key's last sent alert is at least `cooldown` seconds old."""
    rows = df.withColumn("__us", micros(ts))
    return fold_by_key(rows, keys, ts, ties, ["__us"], cooldown_step(cooldown), "sent boolean", **kw).drop("__us")


def rate_limit(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], max_calls: int = 60,
               period: float = 60, **kw) -> DataFrame:
    """`accepted` while fewer than `max_calls` were accepted in the trailing
    period (rejected ones do not count), and `retry_after` seconds otherwise."""
    rows = df.withColumn("__us", micros(ts))
    return fold_by_key(rows, keys, ts, ties, ["__us"], rate_limit_step(max_calls, period),
                       "accepted boolean, retry_after bigint", **kw).drop("__us")


def lockout(df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], kind: str, failure: str,
            max_failures: int = 5, minutes: float = 15, **kw) -> DataFrame:
    """`outcome` per attempt: rejected while locked, failed, locked, or ok."""
    rows = df.withColumn("__us", micros(ts))
    return fold_by_key(rows, keys, ts, ties, ["__us", kind], lockout_step(failure, max_failures, minutes),
                       "outcome string", **kw).drop("__us")


def cooldown_step(cooldown: float) -> Step:
    def step(state, us):
        last = state.get("last")
        sent = last is None or us - last >= cooldown * 1_000_000
        if sent:
            state["last"] = us
        return (sent,)
    return step


def rate_limit_step(max_calls: int, period: float) -> Step:
    def step(state, us):
        calls = [c for c in state.get("calls", []) if c > us - period * 1_000_000]
        full = len(calls) >= max_calls
        retry = int((calls[0] - us) / 1_000_000 + period) + 1 if full else None
        state["calls"] = calls if full else calls + [us]
        return not full, retry
    return step


def lockout_step(failure: str, max_failures: int, minutes: float) -> Step:
    """A failure counts and locks at the limit; a success resets; the count
    outlives an expired lock."""
    def step(state, us, kind):
        if state.get("until") is not None and state["until"] > us:
            return ("rejected",)
        if kind != failure:
            state.update(fails=0, until=None)
            return ("ok",)
        state["fails"] = state.get("fails", 0) + 1
        if state["fails"] >= max_failures:
            state["until"] = us + int(minutes * 60_000_000)
            return ("locked",)
        return ("failed",)
    return step
