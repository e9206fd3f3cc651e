"""Cells for joins on a largest distance: every row with all rows within `eps` of it in one place.

A cell of more than `limit` rows is cut across the line from one of its rows (least hash) to the row
farthest from that one, at the mean of the rows' places on the line. Places on a line differ by no more
than the rows do, so a row within `eps` of the cut is copied to the other side as a guest. Rows are compared
at home only, with all rows of the home cell; each pair within `eps` meets in the home cell of either
row. Where a cut would leave nine tenths of a cell on one side, as where all rows are about as far apart as
`eps`, the cell stays whole and is joined in blocks of bounded size.

A round of cuts reads the rows a few times and writes them once to the shared folder; the rounds grow with
the logarithm of the rows.

The blocks of a cell are cut by hash, so the first ones are a fair part of it. A caller that needs only some
neighbours of a row joins in `rounds` and asks again only for rows that are still open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

LIMIT = 4096
KEEP = 0.9
GROW = 4


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def gap(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def cells(rows: DataFrame, eps: float, limit: int = LIMIT) -> DataFrame:
    """`rows` (id, v and others, but no cell or home) with `cell` and `home`; guests are further copies."""
    if eps < 0:
        raise ValueError("eps is not negative")
    now = cut_lineage(rows.select("*", F.lit(0).cast("long").alias("cell"), F.lit(True).alias("home"), F.lit(False).alias("__done")), "cells")
    # rounding of places on a line
    reach = eps * (1 + 1e-9) + 1e-9
    while True:
        large = now.where("NOT __done").groupBy("cell").agg(F.count("*").alias("__n"), F.min_by("v", F.xxhash64("id")).alias("__a")) \
            .where(F.col("__n") > limit)
        large = cut_lineage(large, "large")
        if large.isEmpty():
            return now.drop("__done")
        open_ = now.join(large.drop("__n"), "cell")
        far = open_.groupBy("cell").agg(F.max_by("v", F.struct(gap(F.col("v"), F.col("__a")), "id")).alias("__b"))
        line = large.join(far, "cell").withColumn("__w", F.zip_with("__b", "__a", lambda x, y: x - y)) \
            .withColumn("__size", F.sqrt(dot(F.col("__w"), F.col("__w")))) \
            .select("cell", "__n", F.when(F.col("__size") > 0, F.transform("__w", lambda x: x / F.col("__size"))).otherwise(F.col("__w")).alias("__w"))
        line = cut_lineage(line, "lines")
        at = dot(F.col("v"), F.col("__w"))
        placed = now.join(line, "cell").withColumn("__at", at)
        mean = placed.groupBy("cell").agg(F.avg("__at").alias("__cut"))
        sides = placed.join(mean, "cell").groupBy("cell", "__n", "__w", "__cut").agg(
            F.count(F.when(F.col("__at") <= F.col("__cut") + reach, 1)).alias("__low"),
            F.count(F.when(F.col("__at") >= F.col("__cut") - reach, 1)).alias("__high"))
        cuts = sides.select("cell", "__w", "__cut", (F.greatest("__low", "__high") < KEEP * F.col("__n")).alias("__good"))
        cuts = cut_lineage(cuts, "cuts")
        # a cell's halves are numbered by hash, so that no counter is shared
        half = lambda side: F.xxhash64("cell", F.lit(side))
        joined = now.join(cuts, "cell", "left").withColumn("__at", F.when(F.col("__good"), dot(F.col("v"), F.col("__w"))))
        left = F.col("__at") < F.col("__cut")
        near = F.abs(F.col("__at") - F.col("__cut")) <= reach
        own = F.struct(F.when(left, half(0)).otherwise(half(1)).alias("cell"), F.col("home").alias("home"))
        other = F.struct(F.when(left, half(1)).otherwise(half(0)).alias("cell"), F.lit(False).alias("home"))
        stay = F.struct(F.col("cell").alias("cell"), F.col("home").alias("home"))
        places = F.when(~F.coalesce("__good", F.lit(False)), F.array(stay)).when(near, F.array(own, other)).otherwise(F.array(own))
        kept = [c for c in rows.columns]
        now = cut_lineage(joined.withColumn("__done", F.col("__done") | F.coalesce(~F.col("__good"), F.lit(False)))
                          .withColumn("__place", F.explode(places)).select(*kept, "__place.cell", "__place.home", "__done"), "cells")


def compared(placed: DataFrame) -> int:
    """How many pairs a join of the cells compares."""
    per = placed.groupBy("cell").agg((F.count("*") * F.count(F.when(F.col("home"), 1))).alias("__pairs"))
    return per.agg(F.sum("__pairs")).first()[0] or 0


def block_join(placed: DataFrame, fn: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, limit: int = LIMIT,
               asked: DataFrame | None = None, first: int = 0, last: int | None = None) -> DataFrame:
    """`fn(rows at home, rows of the cell)` for every pair of blocks of a cell. `asked` gives other rows
    instead of all at home; they meet the blocks of their cell from `first` up to, but not with, `last`."""
    asked = placed.where("home") if asked is None else asked
    parts = asked.groupBy("cell").agg(F.ceil(F.count("*") / limit).cast("long").alias("__parts"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / limit).cast("long").alias("__blocks")).where(F.col("__blocks") > first)
    sizes = cut_lineage(sizes.join(parts, "cell"), "sizes")
    until = F.col("__blocks") if last is None else F.least("__blocks", F.lit(last).cast("long"))
    left = asked.join(sizes, "cell").withColumn("__part", F.pmod(F.xxhash64("id"), F.col("__parts"))) \
        .withColumn("__block", F.explode(F.sequence(F.lit(first).cast("long"), until - 1)))
    # read again: the two sides of a cogroup are different tables
    right = placed.select("*").join(sizes.select("cell", F.col("__blocks").alias("__b"), F.col("__parts").alias("__p")), "cell") \
        .withColumn("__block", F.pmod(F.xxhash64("id"), F.col("__b")))
    right = right.where(F.col("__block") >= first) if last is None else right.where(F.col("__block").between(first, last - 1))
    right = right.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__p") - 1)))
    left = left.select(*[F.col(c).alias(c) for c in asked.columns], F.col("__part").alias("__part"), F.col("__block").alias("__block"))
    right = right.select(*[F.col(c).alias(c) for c in placed.columns], F.col("__part").alias("__part"), F.col("__block").alias("__block"))

    def pair(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return fn(q, c) if len(q) and len(c) else pd.DataFrame()

    on = ["cell", "__part", "__block"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(pair, schema)


def rounds(placed: DataFrame, limit: int = LIMIT) -> Iterator[tuple[int, int]]:
    """Bounds (first, last) of the blocks that each round of joins meets: one block of every cell, then
    each time `GROW` times as many, up to all blocks of the largest cell."""
    most = placed.groupBy("cell").agg(F.count("*").alias("__n")).agg(F.max("__n")).first()[0] or 0
    first, last = 0, 1
    while first * limit < most:
        yield first, last
        first, last = last, last * GROW
