"""Row order inside groups without one task per group.

A plain window puts a whole group into one task. Here every group is first cut
into slices that keep the order (a hash prefix, or quantile cut points of the
order column); windows run per (group, slice) and the slices are stitched with
their small per-slice summaries. A slice holds about 1/n of the table even when
a single key owns a third of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE = "__slice"


def slice_count(df: DataFrame) -> int:
    """Slices per group: as many as the session's shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def hash_order(*columns: str, seed: int = 42) -> Column:
    """Seeded pseudo-random order key, the same on every run and partitioning."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns],
                             F.lit(str(seed))))


def hash_slice(digest: str | Column, n: int) -> Column:
    """Order-preserving slice of a hex digest: its first 16 bits scaled to n."""
    col = F.col(digest) if isinstance(digest, str) else digest
    head = F.conv(F.substring(col, 1, 4), 16, 10).cast("long")
    return F.floor(head * F.lit(min(n, 65536)) / F.lit(65536)).cast("int")


def _cut_points(df: DataFrame, column: str, n: int) -> Column:
    """n - 1 quantiles of a column, repeated values kept (a scalar subquery)."""
    points = F.array(*[F.lit(i / n) for i in range(1, n)])
    return df.agg(F.percentile_approx(column, points, max(10000, 20 * n))).scalar()


def _position(cuts: Column, value: Column, n: int) -> Column:
    """How many cut points are at or below `value` (binary search)."""
    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        above = (acc["lo"] < acc["hi"]) & (F.get(cuts, mid) <= value)
        return F.struct(F.when(above, mid + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(above | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    steps = max(1, (n - 1).bit_length())
    found = F.aggregate(F.sequence(F.lit(0), F.lit(steps)),
                        F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi")), halve, lambda acc: acc["lo"])
    return F.when(value.isNull(), -1).otherwise(found)


def value_sliced(df: DataFrame, column: str, n: int, tie: str | None = None, tie_down: bool = False) -> DataFrame:
    """Slice by quantile cut points of `column`.

    A value that fills two or more cut points by itself gets a slice of its own,
    cut further along the tie column when that is a number or a timestamp, so
    neither a hot key nor a hot order value ends up in one task.
    """
    if n <= 1:
        return df.withColumn(SLICE, F.lit(0).cast("long"))
    out = df.withColumn("__cuts", _cut_points(df, column, n))
    value = F.col(column)
    heavy = F.filter(F.col("__cuts"), lambda c, i: c == F.get(F.col("__cuts"), i + 1))
    out = out.withColumn("__heavy", F.coalesce(F.array_contains(heavy, value), F.lit(False)))
    place = _position(F.col("__cuts"), value, n).cast("long")
    kind = dict(df.dtypes)[tie] if tie else ""
    if kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")):
        out = out.withColumn("__tie_cuts", _cut_points(df, tie, n))
        within = F.when(F.col("__heavy"), _position(F.col("__tie_cuts"), F.col(tie), n) + 1).otherwise(0)
        # along a descending order the slices of one value still follow the ascending ties
        within = F.when(F.col("__heavy"), n + 1 - within).otherwise(0) if tie_down else within
    else:
        within = F.lit(0)
    rest = F.when(F.col("__heavy"), 0).otherwise(1)
    return out.withColumn(SLICE, (place * 2 + rest) * (n + 2) + within).drop("__cuts", "__heavy", "__tie_cuts")


def sliced(df: DataFrame, order: str, *, hashed: bool = False, n: int | None = None, ties: Sequence[str] = (),
           descending: bool = False) -> DataFrame:
    n = n or slice_count(df)
    if hashed:
        return df.withColumn(SLICE, hash_slice(order, n))
    return value_sliced(df, order, n, ties[0] if ties else None, descending)


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame (a scalar subquery, not a join)."""
    packed = row.select(F.struct(*row.columns).alias("__row")).scalar()
    return df.withColumn("__row", packed).select("*", "__row.*").drop("__row")


def on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left copy of the keys."""
    names = {k: f"__r_{k}" for k in keys}
    renamed = right.withColumnsRenamed(names)
    cond = [F.col(k).eqNullSafe(F.col(names[k])) for k in keys]
    return left.join(renamed, cond, how).drop(*names.values())


CELL = "__cell"


def celled(df: DataFrame, keys: Sequence[str], order: str, **how) -> DataFrame:
    """Rows with their (keys, slice) as one struct. Struct equality treats nulls
    as equal, so windows and joins share the partitioning by this column and the
    rows are shuffled once."""
    return sliced(df, order, **how).withColumn(CELL, F.struct(*keys, SLICE)).drop(SLICE)


def cell_window(keys: Sequence[str]) -> tuple:
    """Window over the cells of a group, and the slice to order them by."""
    fields = [F.col(CELL).getField(k) for k in keys]
    return (W.partitionBy(*fields) if fields else W.partitionBy(F.lit(0))), F.col(CELL).getField(SLICE)


def ranked(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (), *,
           descending: bool = False, hashed: bool = False, rank: str = "rn",
           total: str | None = None, n: int | None = None) -> DataFrame:
    """Exact row_number within `keys` by `order` then `ties`, from 1.

    `order` is an md5 column when `hashed`, else a number or a timestamp. Ties
    sort ascending. Nulls come first ascending and last descending.
    """
    keys = list(keys)
    rows = celled(df, keys, order, hashed=hashed, n=n, ties=ties, descending=descending)
    sizes = rows.groupBy(CELL).agg(F.count(F.lit(1)).alias("__n"))
    w, place = cell_window(keys)
    before = w.orderBy(place.desc() if descending else place.asc()).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(CELL, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                           *([F.sum("__n").over(w).alias(total)] if total else []))
    first = F.col(order).desc() if descending else F.col(order).asc()
    local = F.row_number().over(W.partitionBy(CELL).orderBy(first, *[F.col(t).asc() for t in ties]))
    return (rows.withColumn("__local", local).join(offsets, CELL)
            .withColumn(rank, F.col("__before") + F.col("__local")).drop(CELL, "__local", "__before"))


def running_max(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str,
                ties: Sequence[str] = (), n: int | None = None) -> DataFrame:
    """Largest `value` (a struct works too) up to and including each row."""
    keys = list(keys)
    rows = celled(df.withColumn("__v", value), keys, order, n=n, ties=ties)
    tops = rows.groupBy(CELL).agg(F.max("__v").alias("__top"))
    w, place = cell_window(keys)
    carried = tops.select(CELL, F.max("__top").over(
        w.orderBy(place).rowsBetween(W.unboundedPreceding, -1)).alias("__carried"))
    local = W.partitionBy(CELL).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, 0)
    return (rows.withColumn("__run", F.max("__v").over(local)).join(carried, CELL)
            .withColumn(name, F.when(F.col("__carried").isNull() | (F.col("__run") > F.col("__carried")),
                                     F.col("__run")).otherwise(F.col("__carried")))
            .drop("__v", "__run", "__carried", CELL))


def neighbour(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str,
              ties: Sequence[str] = (), *, ahead: bool = False, n: int | None = None) -> DataFrame:
    """`value` of the previous (or next, with `ahead`) row of the group."""
    keys = list(keys)
    rows = celled(df.withColumn("__v", F.struct(value.alias("v"))), keys, order, n=n, ties=ties)
    at = F.struct(order, *ties)
    edges = rows.groupBy(CELL).agg((F.min_by("__v", at) if ahead else F.max_by("__v", at)).alias("__edge"))
    w, place = cell_window(keys)
    step = F.lead if ahead else F.lag
    carried = edges.select(CELL, step("__edge").over(w.orderBy(place)).alias("__carried"))
    local = step("__v").over(W.partitionBy(CELL).orderBy(order, *ties))
    return (rows.withColumn("__near", local).join(carried, CELL)
            .withColumn(name, F.coalesce("__near", "__carried").getField("v"))
            .drop("__v", "__near", "__carried", CELL))
