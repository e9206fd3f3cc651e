"""Catalogue searches, access rules and row predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_any(columns: Sequence[str], needle: str) -> Column:
    """Case-insensitive substring over several columns (needle taken literally)."""
    low = needle.lower()
    return reduce(Column.__or__, [F.lower(F.col(c)).contains(low) for c in columns])


def mine_or_public(owner: str, public: str, owner_id) -> Column:
    return (F.col(owner) == F.lit(owner_id)) | F.col(public)


def catalog_search(df: DataFrame, *, equals: Mapping[str, object] | None = None,
                   owner: str | None = None, owner_id=None, public: str | None = None,
                   public_only: bool = False, include_public: bool = False,
                   search: str | None = None, search_in: Sequence[str] = ()) -> DataFrame:
    """Optional filters in one conjunction, so all of them reach the scan."""
    rules: list[Column] = [F.col(c) == F.lit(v) for c, v in (equals or {}).items() if v is not None]
    if public_only and public:
        rules.append(F.col(public))
    if owner_id is not None and owner:
        rules.append(mine_or_public(owner, public, owner_id) if include_public and public
                     else F.col(owner) == F.lit(owner_id))
    if search:
        rules.append(contains_any(search_in, search))
    return df.filter(reduce(Column.__and__, rules)) if rules else df


def nulls_last(column: str, direction: str = "desc") -> Column:
    return F.col(column).asc_nulls_last() if direction == "asc" else F.col(column).desc_nulls_last()


def checked_sort(sort_by: str, allowed: Sequence[str], default: str,
                 direction: str = "desc", key: str | None = None) -> list[Column]:
    """Sort expressions from user input: whitelist the column, nulls last, key last."""
    column = sort_by if sort_by in allowed else default
    direction = direction if direction in ("asc", "desc") else "desc"
    return [nulls_last(column, direction)] + ([F.col(key).asc()] if key else [])


def row_access(owner: str, public: str, user: str, role: str, admin: str = "admin") -> tuple[Column, Column]:
    """(viewable, editable): public, own, or admin; edit needs own or admin."""
    editable = (F.col(owner) == F.col(user)) | (F.col(role) == F.lit(admin))
    return F.col(public) | editable, editable


def status_in_and_present(status: str, allowed: Sequence[str], *required: str) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in required],
                  F.col(status).isin(*allowed))


def stale(status: str, created: str, now: str, terminal: Sequence[str],
          waiting: Sequence[str], hours: int = 24) -> Column:
    """Terminal rows, or rows that have waited longer than `hours` before `now`."""
    limit = F.to_timestamp_ntz(F.lit(now)) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return F.col(status).isin(*terminal) | (F.col(status).isin(*waiting) & (F.col(created) < limit))


def low_quality(task: str, acc: str, r2: str, silhouette: str) -> Column:
    """Threshold per task: accuracy < 0.5, r2 < 0, silhouette < 0.3; null is not low."""
    return F.coalesce(
        F.when(F.col(task) == "classification", F.col(acc) < 0.5)
        .when(F.col(task) == "regression", F.col(r2) < 0)
        .when(F.col(task) == "clustering", F.col(silhouette) < 0.3), F.lit(False))


def keys_subset(column: str, allowed: Sequence[str]) -> Column:
    """JSON object has keys, and all of them are allowed."""
    keys = F.json_object_keys(F.col(column))
    extra = F.array_except(keys, F.array(*[F.lit(k) for k in allowed]))
    return F.coalesce((F.size(keys) > 0) & (F.size(extra) == 0), F.lit(False))


def finite(column: str) -> Column:
    """Neither null, NaN nor infinite."""
    c = F.col(column)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def length_band(column: str, low: int = 5, high: int = 500) -> Column:
    return F.length(column).between(low, high)


def strip(column: str) -> Column:
    """Trim all leading and trailing whitespace, line breaks included."""
    return F.regexp_replace(F.col(column), r"^\s+|\s+$", "")


def nonblank_pair(df: DataFrame, text: str, label: str) -> DataFrame:
    """Trim both columns and keep rows where neither is empty."""
    return (df.withColumn(text, strip(text)).withColumn(label, strip(label))
            .filter((F.col(text) != "") & (F.col(label) != "")))


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = (),
                   zero_fill: bool = False) -> DataFrame:
    """Select the model's features in its order; extra columns go, missing ones
    are an error unless `zero_fill` (text-only input)."""
    missing = [c for c in expected if c not in df.columns]
    if missing and not zero_fill:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*keep, *[F.lit(0.0).alias(c) if c in missing else F.col(c) for c in expected])


NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the numeric / string / boolean columns."""
    match = {"numeric": lambda t: t.startswith(NUMERIC_TYPES) and not t.startswith("interval"),
             "string": lambda t: t == "string", "boolean": lambda t: t == "boolean"}[kind]
    return [c for c, t in df.dtypes if match(t)]


def page_slice(df: DataFrame, order: Sequence[Column | str], page: int, per_page: int) -> DataFrame:
    """One page in a total order, each row carrying total, pages, has_next, has_prev."""
    if page < 1 or per_page < 1:
        raise ValueError("page and per_page start at 1")
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df.orderBy(*order).offset((page - 1) * per_page).limit(per_page)
    pages = F.ceil(F.col("total") / per_page)
    return (rows.withColumn("total", total).withColumn("pages", pages)
            .withColumn("has_next", F.lit(page) < F.col("pages"))
            .withColumn("has_prev", F.lit(page > 1)))
