"""Exact nearest neighbours.

Vectors are grouped into cells around pivots. A cell's radius bounds how close
its members can be, so a query visits only cells that can still hold a closer
row; the result is exact. Large cells are cut into blocks, and a task handles
one (query block, candidate block) pair with a matrix product, so no pair of
rows is ever materialised and no group is unbounded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PIVOTS = 2048
BLOCK_ROWS = 4096
# a distance taken from squared lengths is off by at most about 1e-8 of the vectors' length
SLACK = 1e-7


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 0))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of two matrices."""
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


def unit(v: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm == 0, 1.0, norm)


def as_double(df: DataFrame, key: str, vec: str, metric: str, keep: dict | None = None) -> DataFrame:
    """(id, v, kept columns): double vectors, unit length for the cosine metric."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    kept = [F.col(c).alias(name) for name, c in (keep or {}).items()]
    names = list(keep or {})
    out = df.select(F.col(key).alias("id"), v.alias("v"), *kept)
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
        out = out.select("id", norm.alias("__n"), "v", *names).select(
            "id", *names, F.when(F.col("__n") == 0, F.col("v"))
            .otherwise(F.transform("v", lambda x: x / F.col("__n"))).alias("v"))
    elif metric != "euclidean":
        raise ValueError(f"unknown metric {metric!r}")
    return out


class Cells:
    """Pivots, radii and sizes of the candidate cells (at most MAX_PIVOTS rows
    on the driver), and the candidates tagged with cell and block."""

    def __init__(self, cands: DataFrame, block_rows: int = BLOCK_ROWS, pivots: int | None = None):
        self.block_rows = block_rows
        total = cands.count()
        if total == 0:
            raise ValueError("no candidate vectors")
        want = pivots or int(min(MAX_PIVOTS, max(1, round(total ** 0.5 / 2))))
        # the pivots with the smallest hashes: a fixed sample whatever the partitioning
        picked = cands.orderBy(F.md5(F.col("id").cast("string")), "id").limit(want).collect()
        # copies of one vector make one pivot
        self.pivots = np.unique(np.array([r["v"] for r in picked], dtype=np.float64), axis=0)
        spark = cands.sparkSession
        self.shared = spark.sparkContext.broadcast(self.pivots)
        tagged = self.tag(cands)
        facts = tagged.groupBy("cell").agg(F.max("gap").alias("r"), F.count(F.lit(1)).alias("n")).collect()
        self.radius = np.full(len(self.pivots), -1.0)
        self.size = np.zeros(len(self.pivots), dtype=np.int64)
        for row in facts:
            self.radius[row["cell"]], self.size[row["cell"]] = row["r"], row["n"]
        self.blocks = np.maximum(1, -(-self.size // block_rows)).astype(int)
        n_blocks = F.array(*[F.lit(int(b)) for b in self.blocks])
        self.cands = tagged.withColumn("block", F.pmod(F.xxhash64("id"), F.get(n_blocks, F.col("cell"))))
        self.n_blocks = n_blocks

    def tag(self, df: DataFrame) -> DataFrame:
        """Nearest pivot and the distance to it."""
        shared = self.shared

        def nearest_pivot(batches):
            for pdf in batches:
                d = distances(matrix(pdf["v"]), shared.value) if len(pdf) else np.zeros((0, 1))
                yield pdf.assign(cell=d.argmin(1).astype("int32") if len(pdf) else np.array([], dtype="int32"),
                                 gap=d.min(1) if len(pdf) else np.array([], dtype="float64"))

        schema = T.StructType(df.schema.fields + [T.StructField("cell", T.IntegerType()),
                                                  T.StructField("gap", T.DoubleType())])
        return df.mapInPandas(nearest_pivot, schema)

    def reach(self, queries: DataFrame, radius_col: str, skip_home: bool) -> DataFrame:
        """One row per (query, cell) whose cell may hold a row within the radius."""
        shared, radius = self.shared, self.radius
        reach = float(np.sqrt((self.pivots ** 2).sum(1)).max() + max(radius.max(), 0.0))

        def visit(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                d = distances(matrix(pdf["v"]), shared.value)
                slack = SLACK * (1.0 + np.sqrt((matrix(pdf["v"]) ** 2).sum(1, keepdims=True)) + reach)
                near = (d - radius[None, :] <= pdf[radius_col].to_numpy()[:, None] + slack) & (radius >= 0)[None, :]
                if skip_home:
                    near[np.arange(len(pdf)), pdf["cell"].to_numpy()] = False
                yield pdf.assign(visits=[np.flatnonzero(r).astype("int32") for r in near])

        schema = T.StructType(queries.schema.fields + [T.StructField("visits", T.ArrayType(T.IntegerType()))])
        return (queries.mapInPandas(visit, schema)
                .withColumn("cell", F.explode("visits")).drop("visits"))

    def probe(self, queries: DataFrame, n: int) -> DataFrame:
        """One row per (query, cell) for the n cells whose pivots are nearest."""
        shared, used = self.shared, np.flatnonzero(self.size > 0)

        def visit(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                d = distances(matrix(pdf["v"]), shared.value[used])
                yield pdf.assign(visits=list(used[np.argsort(d, axis=1, kind="stable")[:, :n]].astype("int32")))

        schema = T.StructType(queries.schema.fields + [T.StructField("visits", T.ArrayType(T.IntegerType()))])
        return queries.mapInPandas(visit, schema).withColumn("cell", F.explode("visits")).drop("visits")

    def block_join(self, visits: DataFrame, fn: Callable, schema: str) -> DataFrame:
        """Run `fn(query block, candidate block)` for every block pair of a cell.

        Both sides are cut: candidates by the size of their cell, queries by a
        hash into as many parts as the visits of that cell need.
        """
        per_cell = {r["cell"]: r["n"] for r in
                    visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = [max(1, -(-per_cell.get(i, 0) // self.block_rows)) for i in range(len(self.size))]
        n_parts = F.array(*[F.lit(int(p)) for p in parts])
        queries = (visits.withColumn("part", F.pmod(F.xxhash64("id"), F.get(n_parts, F.col("cell"))))
                   .withColumn("block", F.explode(F.sequence(
                       F.lit(0).cast("long"), F.get(self.n_blocks, F.col("cell")).cast("long") - 1))))
        used = [i for i in range(len(self.size)) if per_cell.get(i, 0)]
        cands = (self.cands.filter(F.col("cell").isin(used) if len(used) < len(self.size) else F.lit(True))
                 .withColumn("part", F.explode(F.sequence(
                     F.lit(0).cast("long"), F.get(n_parts, F.col("cell")).cast("long") - 1))))
        on = ["cell", "block", "part"]

        def pair(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            return fn(q, c) if len(q) and len(c) else pd.DataFrame()

        return queries.groupBy(*on).cogroup(cands.groupBy(*on)).applyInPandas(pair, schema)


def nearest(queries: DataFrame, candidates: DataFrame, key: str, vec: str, k: int = 5,
            metric: str = "euclidean", exclude_self: bool = False,
            block_rows: int = BLOCK_ROWS, pivots: int | None = None, probes: int | None = None) -> DataFrame:
    """The k nearest candidates of every query; ties by candidate id.

    Exact without `probes`: every cell that may hold a nearer row is visited, which
    in many dimensions can be all of them, so ask a stated set of queries. With
    `probes`, each query visits that many cells and distances inside them are exact;
    the work is then linear in the rows.

    Returns (query_id, candidate_id, distance, place). Cosine distance is that
    of the unit vectors, so similarity = 1 - distance² / 2.
    """
    cells = Cells(as_double(candidates, key, vec, metric), block_rows, pivots)
    home = cells.tag(as_double(queries, key, vec, metric)).drop("gap")
    id_type = home.schema["id"].dataType.simpleString()

    def top(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        c = c.sort_values("id", kind="stable")
        ids = c["id"].to_numpy()
        left, right = matrix(q["v"]), matrix(c["v"])
        d = distances(left, right)
        if exclude_self:
            d[q["id"].to_numpy()[:, None] == ids[None, :]] = np.inf
        # exactly k per block, ties to the smaller id (columns are sorted by id), so
        # a crowd of equal vectors never leaves the task as pairs
        take = min(k, d.shape[1])
        bound = np.partition(d, take - 1, axis=1)[:, take - 1][:, None]
        less, tied = d < bound, d == bound
        room = take - less.sum(axis=1, keepdims=True)
        rows, cols = np.nonzero((less | (tied & (np.cumsum(tied, axis=1) <= room))) & np.isfinite(d))
        return pd.DataFrame({"query_id": q["id"].to_numpy()[rows], "candidate_id": ids[cols],
                             "distance": np.sqrt(((left[rows] - right[cols]) ** 2).sum(1))})

    out_schema = f"query_id {id_type}, candidate_id {id_type}, distance double"
    rank = W.partitionBy("query_id").orderBy("distance", "candidate_id")
    if probes is not None:
        found = cells.block_join(cells.probe(home.drop("cell"), probes), top, out_schema)
        return found.withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= k)
    first = cells.block_join(home, top, out_schema)
    best = first.withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= k)
    bound = (best.groupBy("query_id").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("n"))
             .select(F.col("query_id").alias("__q"),
                     F.when(F.col("n") >= k, F.col("far")).otherwise(float("inf")).alias("far")))
    asked = (home.join(bound, F.col("id") == F.col("__q"), "left")
             .withColumn("far", F.coalesce("far", F.lit(float("inf")))).drop("__q"))
    more = cells.block_join(cells.reach(asked, "far", skip_home=True).drop("far"), top, out_schema)
    return (best.drop("place").unionByName(more)
            .withColumn("place", F.row_number().over(rank)).filter(F.col("place") <= k))
