"""Typed parameters, maps, dates and small numeric helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_even(value: Column, decimals: int = 0) -> Column:
    """Round the binary value, ties to even, to `decimals` places.

    `F.round` rounds the shortest decimal text of a double half up, so 71.85,
    which is stored just below, would become 71.9. Number formatting rounds the
    stored value itself; the column is referenced once, so it nests cheaply.
    """
    return F.translate(F.format_number(value.cast("double"), decimals), ",", "").try_cast("double")


def typed_param(raw: Column, kind: str) -> Column:
    """Blank or badly formed values become null; `ints` is a comma list."""
    text = F.trim(raw)
    filled = F.when(text != "", text)
    if kind == "int":
        return F.when(filled.rlike(r"^[+-]?\d+$"), filled).try_cast("long")
    if kind == "float":
        return filled.try_cast("double")
    if kind == "ints":
        parts = F.filter(F.transform(F.split(filled, ","), lambda p: F.trim(p)), lambda p: p != "")
        parsed = F.transform(parts, lambda p: F.when(p.rlike(r"^[+-]?\d+$"), p).try_cast("long"))
        return F.when((F.size(parsed) > 0) & ~F.exists(parsed, lambda p: p.isNull()), parsed)
    return F.when(raw != "", raw)


def merge_params(best: Column, existing: Column, conflicting: Sequence[str],
                 protected: Sequence[str] = ("hidden_layers", "dropout", "test_size")) -> Column:
    """Best parameters without conflicting keys, plus protected keys that only
    the existing map has."""
    kept = F.map_filter(best, lambda k, v: ~k.isin(*conflicting))
    extra = F.map_filter(existing, lambda k, v: k.isin(*protected) & ~F.map_contains_key(kept, k))
    return F.map_concat(kept, extra)


def pick_metric(metrics: Column, name: str, fallback: str | None = None) -> Column:
    """`test_<name>`, `test_<fallback>`, `<name>`, `<fallback>` in this order."""
    keys = [f"{p}{n}" for p in ("test_", "") for n in (name, fallback) if n]
    return F.coalesce(*[metrics[k] for k in keys])


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday = 0) and month."""
    return {"hour": F.hour(ts), "weekday": F.weekday(ts), "month": F.month(ts)}


def to_utc8(ts: Column) -> Column:
    return ts + F.expr("INTERVAL 8 HOURS")


def file_extension(path: Column) -> Column:
    """Lower-case ending of the last path segment; none is null."""
    bare = F.regexp_replace(path, r"[?#].*$", "")
    return F.nullif(F.lower(F.regexp_extract(bare, r"[^/]\.([A-Za-z0-9]+)$", 1)), F.lit(""))


def in_domain(value: Column, allowed: Sequence) -> Column:
    return F.coalesce(value.isin(*allowed), F.lit(False))


def clip(value: Column, low: float, high: float, decimals: int | None = None) -> Column:
    out = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return round_even(out, decimals) if decimals is not None else out


def log_scale(n: Column) -> Column:
    """0 at 100 rows, 1 at a million, linear in log10 between."""
    bounded = F.greatest(F.lit(100), F.least(F.lit(1_000_000), n))
    return clip((F.log10(bounded) - 2.0) / 4.0, 0.0, 1.0)


def lerp(low: float, high: float, t: Column) -> Column:
    return F.lit(low) + F.lit(high - low) * t


def size_scaled_settings(n: Column) -> dict[str, Column]:
    """Settings that move smoothly with the row count."""
    t = log_scale(n)
    # End points at 100 rows and at a million rows.
    return {
        "epochs": round_even(lerp(35, 4, t)).cast("int"),
        "batch_size": (round_even(lerp(12, 160, t) / 8) * 8).cast("int"),
        "learning_rate": round_even(lerp(3e-4, 2e-3, t), 6),
        "dropout": round_even(lerp(0.55, 0.15, t), 2),
        "weight_decay": F.pow(F.lit(10.0), lerp(-2.5, -5.0, t)),
        "val_size": round_even(lerp(0.22, 0.08, t), 2),
    }


def replace_inf(value: Column, tokens: Mapping[str, str] | None = None) -> Column:
    """Value as text with infinities as reserved labels."""
    t = tokens or {"pos": "inf", "neg": "-inf"}
    inf = F.lit(float("inf"))
    return F.when(value == inf, t["pos"]).when(value == -inf, t["neg"]).otherwise(value.cast("string"))
