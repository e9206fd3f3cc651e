"""Hard negatives by exact maximum inner product with lists shared by clusters of anchors.

Anchors are clustered by direction. For each cluster the candidates are sorted once by an upper
bound: an anchor u in a cone of angle t around the cluster's centre scores at most
|u| * |i| * cos(max(0, angle(i, centre) - t)) with candidate i. Every member of the cluster walks
that one list from its head and stops when the next bound cannot reach its results any more, so
what it returns is certified to be exact.

1. Positives: each anchor's best rows of its own label.
2. Negatives: for each positive, the best rows of other labels whose score lies between two
   shares of the positive's score.

Both walks run for every pair of a bounded group of anchors (whole clusters, cut where a cluster is
large) and a bounded block of candidates; the best of each block meet by anchor.

Vectors are arrays of whole numbers and scores are their integer inner products; a missing
component at the end of a shorter vector counts as zero, and scores must stay below 2**44.
Higher scores come first, ties by smaller id.

Defined results: rows with a null id, label, vector or component take no part; rows that repeat
an id count as one, the one with the least (label, vector); an anchor without another row of its
label gives no rows, a positive without a row in its range gives none; without anchors the
result is empty. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

# clusters of anchors at most, and rows of a cluster's part
CLUSTERS, PART = 256, 512
NONE = np.int64(-(2**62))
# arc cosines near one are off by about 1e-8
SLACK = 1e-6


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    if column.num_chunks == 0 or not len(column):
        return np.zeros((0, width))
    rows = column.combine_chunks()
    n = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(rows), width))
    at = np.repeat(np.arange(len(rows)), n)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([1] + [int(np.diff(c.offsets.to_numpy()).max(initial=0)) for x in columns for c in x.chunks])


def shared_list(members: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `items` by descending bound, and these bounds for a member of length one."""
    size = np.sqrt((items * items).sum(1))
    length = np.sqrt((members * members).sum(1))
    units = members / np.where(length == 0, 1.0, length)[:, None]
    centre = units.mean(0)
    long = math.sqrt(float(centre @ centre))
    if long < 1e-12:
        bound = size
    else:
        centre = centre / long
        angle = np.arccos(np.clip(items @ centre / np.where(size == 0, 1.0, size), -1.0, 1.0))
        near = np.where(length == 0, 1.0, np.clip(units @ centre, -1.0, 1.0)).min()
        bound = size * np.cos(np.maximum(0.0, angle - (math.acos(near) + SLACK)))
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(members: np.ndarray, items: np.ndarray, fits, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The best k items of every member and slot, and how many items were read.

    `fits(rows, places, scores, slot)` tells which items a slot takes; `least` (members x slots) is
    the lowest score it takes. Items come in ascending order of id. Returns scores and places,
    members x slots x k, filled up with NONE, not sorted."""
    n, m = len(items), len(members)
    top = np.full((m, least.shape[1], k), NONE)
    order, bound = shared_list(members, items)
    length = np.sqrt((members * members).sum(1))
    active, at, step, read = np.arange(m), 0, 256, 0
    while at < n and len(active):
        places = order[at:at + step]
        scores = np.rint(members[active] @ items[places].T).astype(np.int64)
        read += scores.size
        keys = scores * n + (n - 1 - places)
        for slot in range(least.shape[1]):
            taken = np.where(fits(active, places, scores, slot), keys, NONE)
            better = np.flatnonzero(taken.max(1) > top[active, slot, 0])
            if len(better):
                both = np.concatenate([top[active[better], slot], taken[better]], axis=1)
                top[active[better], slot] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        at += step
        step = min(2 * step, 4096)
        if at < n:
            # done where the next bound is below what every slot holds or takes
            floor = np.maximum(np.where(top[active, :, 0] == NONE, NONE, top[active, :, 0] // n), least[active])
            reach = length[active] * bound[at] * (1 + 1e-9) + 1e-3
            active = active[(floor <= reach[:, None]).any(1)]
    return np.where(top == NONE, NONE, top // n), np.where(top == NONE, -1, n - 1 - top % n), read


def _parts(anchors: pa.Table) -> list[np.ndarray]:
    """Rows of each cluster part."""
    cluster = np.stack([anchors.column(c).to_numpy() for c in ("cluster", "part")])
    order = np.lexsort(cluster)
    edges = np.flatnonzero((np.diff(cluster[:, order], axis=1) != 0).any(0)) + 1
    return np.split(order, edges)


def _positives(k: int):
    out = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("score", pa.int64())])

    def best(anchors: pa.Table, items: pa.Table) -> pa.Table:
        if not anchors.num_rows or not items.num_rows:
            return out.empty_table()
        items = items.sort_by([("id", "ascending")])
        width = _width(anchors.column("v"), items.column("v"))
        a, b = _matrix(anchors.column("v"), width), _matrix(items.column("v"), width)
        ids, label = items.column("id").to_numpy(), items.column("label").to_numpy()
        own, own_label = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        found = []
        for rows in _parts(anchors):
            def fits(act, places, scores, slot, rows=rows):
                return (label[places] == own_label[rows[act], None]) & (ids[places] != own[rows[act], None])

            score, place, _ = walk(a[rows], b, fits, np.full((len(rows), 1), NONE), k)
            r, _, j = np.nonzero(place >= 0)
            found.append((own[rows[r]], ids[place[r, 0, j]], score[r, 0, j]))
        return pa.table([np.concatenate(x) for x in zip(*found)], schema=out)

    return best


def _negatives(k: int, low: int, high: int):
    out = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("negative", pa.int64()), ("score", pa.int64())])

    def best(anchors: pa.Table, items: pa.Table) -> pa.Table:
        if not anchors.num_rows or not items.num_rows:
            return out.empty_table()
        items = items.sort_by([("id", "ascending")])
        width = _width(anchors.column("v"), items.column("v"))
        a, b = _matrix(anchors.column("v"), width), _matrix(items.column("v"), width)
        ids, label = items.column("id").to_numpy(), items.column("label").to_numpy()
        own, own_label = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        scores_of = anchors.column("scores").to_pylist()
        slots = max(len(x) for x in scores_of)
        # low * positive <= 100 * negative <= high * positive, as whole numbers; no range: nothing fits
        least, most = np.full((len(own), slots), -NONE), np.full((len(own), slots), NONE)
        for i, x in enumerate(scores_of):
            least[i, :len(x)] = [-(-low * s // 100) for s in x]
            most[i, :len(x)] = [high * s // 100 for s in x]
        empty = least > most
        least[empty], most[empty] = -NONE, NONE
        found = []
        for rows in _parts(anchors):
            def fits(act, places, scores, slot, rows=rows):
                r = rows[act]
                return ((label[places] != own_label[r, None]) & (scores >= least[r, slot][:, None])
                        & (scores <= most[r, slot][:, None]))

            score, place, _ = walk(a[rows], b, fits, least[rows], k)
            r, s, j = np.nonzero(place >= 0)
            found.append((own[rows[r]], s.astype(np.int32), ids[place[r, s, j]], score[r, s, j]))
        return pa.table([np.concatenate(x) for x in zip(*found)], schema=out)

    return best


def cluster_anchors(anchors: DataFrame, group_rows: int) -> DataFrame:
    """Anchors with their cluster by direction, a part of at most about PART rows, and the group of
    about `group_rows` rows that is sent to the blocks together."""
    n = anchors.count()
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    width = anchors.agg(F.max(F.size("v"))).first()[0] or 1
    padded = F.transform(F.sequence(F.lit(0), F.lit(max(width, 1) - 1)), lambda i: F.coalesce(F.get("v", i).cast("double"), F.lit(0.0)))
    units = anchors.withColumn("size", size).withColumn("unit", array_to_vector(
        F.transform(padded, lambda x: F.when(F.col("size") == 0, 0.0).otherwise(x / F.col("size")))))
    k = min(CLUSTERS, max(1, math.ceil(n / 64)))
    if k > 1:
        model = KMeans(k=k, maxIter=4, seed=13, initMode="random", featuresCol="unit", predictionCol="cluster").fit(units)
        placed = model.transform(units)
    else:
        placed = units.withColumn("cluster", F.lit(0))
    sizes = placed.groupBy("cluster").agg(F.ceil(F.count("*") / PART).cast("long").alias("parts"))
    placed = placed.join(sizes, "cluster").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    groups = max(1, math.ceil(n / group_rows))
    return placed.select("id", "label", "v", F.col("cluster").cast("int").alias("cluster"), "part",
                         F.pmod(F.xxhash64("cluster", "part"), F.lit(groups)).cast("int").alias("grp"))


def hard_negatives(rows: DataFrame, *, id: str, vector: str, label: str, anchor: str, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90, group_rows: int = 4096,
                   block_rows: int = 1 << 16) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where the
    boolean column `anchor` holds; `low` and `high` are hundredths of the positive's score."""
    if not 0 <= low <= high or positives < 1 or negatives < 1:
        raise ValueError("low and high are hundredths in ascending order, positives and negatives at least one")
    label_code = F.xxhash64(F.col(label))
    v = F.col(vector).cast("array<long>")
    known = rows.select(F.col(id).cast("long").alias("id"), F.when(F.col(label).isNotNull(), label_code).alias("label"),
                        v.alias("v"), F.coalesce(F.col(anchor), F.lit(False)).alias("anchor")) \
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
               & ~F.coalesce(F.exists("v", lambda x: x.isNull()), F.lit(True)))
    known = known.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"), F.max("anchor").alias("anchor"))
    items = cut_lineage(known.select("id", "r.label", "r.v", "anchor"), "items")
    blocks = max(1, math.ceil(items.count() / block_rows))
    items = items.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    anchors = cut_lineage(cluster_anchors(items.where("anchor"), group_rows), "anchors")
    groups = anchors.groupBy(F.col("grp").alias("of")).agg(F.count("*").alias("rows")).select(F.col("of").alias("grp"))

    def meet(side: DataFrame, fn, schema: str) -> DataFrame:
        """Every group of anchors with every block: a stated set of queries against all rows."""
        asked = side.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        listed = items.drop("anchor").join(groups)
        return asked.groupBy("grp", "block").cogroup(listed.groupBy("grp", "block")).applyInArrow(fn, schema)

    near = meet(anchors, _positives(positives), "anchor long, positive long, score long")
    first = W.partitionBy("anchor").orderBy(F.desc("score"), "positive")
    near = cut_lineage(near.withColumn("place", F.row_number().over(first) - 1).where(F.col("place") < positives), "positives")
    lists = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "score"))).alias("p")) \
        .select("anchor", F.col("p.score").alias("scores"))
    asked = cut_lineage(anchors.join(lists, anchors.id == lists.anchor).drop("anchor"), "asked")
    far = meet(asked, _negatives(negatives, low, high), "anchor long, place int, negative long, score long")
    order = W.partitionBy("anchor", "place").orderBy(F.desc("score"), "negative")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return far.join(near.withColumnRenamed("score", "positive_score"), ["anchor", "place"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank"),
        F.col("negative").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
