"""Cells with copies of border rows: all pairs within a distance, and few others."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import cluster, eps_cells, knn


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")


def pairs_of(spark, x, eps, limit):
    placed = eps_cells.cells(frame(spark, x), eps, limit)

    def near(q, c):
        d = knn.distances(knn.matrix(q["v"]), knn.matrix(c["v"]))
        r, k = np.nonzero(d <= eps)
        return pd.DataFrame({"a": q["id"].to_numpy()[r], "b": c["id"].to_numpy()[k]})

    found = [(r["a"], r["b"]) for r in eps_cells.block_join(placed, near, "a long, b long", limit).collect()]
    return placed, found


@pytest.mark.parametrize("seed, spread, eps, limit", [(1, 6.0, 1.0, 40), (2, 1.0, 0.8, 25), (3, 0.2, 1.5, 30)])
def test_every_pair_is_met_once_from_each_side(spark, seed, spread, eps, limit):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, spread, (12, 3))[rng.integers(0, 12, 300)] + rng.normal(0, 0.4, (300, 3))
    x[50:90] = x[0]  # copies
    placed, found = pairs_of(spark, x, eps, limit)
    assert placed.where("home").select("id").distinct().count() == placed.where("home").count() == 300
    a, b = np.nonzero(knn.distances(x, x) <= eps)
    assert len(found) == len(a) and set(found) == set(zip(a.tolist(), b.tolist()))


def test_compared_pairs_grow_with_the_rows_of_clustered_data(spark):
    rng = np.random.default_rng(5)
    share = []
    for clusters in (40, 160):
        n = clusters * 50
        x = rng.normal(0, 20, (clusters, 8))[np.arange(n) % clusters] + rng.normal(0, 0.5, (n, 8))
        placed = eps_cells.cells(frame(spark, x), 2.0, 200)
        share.append(eps_cells.compared(placed) / n)
        assert placed.count() < 2 * n
    assert share[1] < 1.5 * share[0] and share[1] < 0.1 * 8000


def test_rows_that_no_cut_parts_stay_in_one_cell(spark):
    x = np.random.default_rng(6).normal(0, 1, (200, 32))
    placed = eps_cells.cells(frame(spark, x / np.linalg.norm(x, axis=1, keepdims=True)), 1.3, 20)
    assert placed.count() == 200 and placed.select("cell").distinct().count() == 1
    empty = eps_cells.cells(frame(spark, x).where("id < 0"), 1.0, 20)
    assert empty.count() == 0 and eps_cells.compared(empty) == 0


def test_clusters_across_many_cells(spark):
    rng = np.random.default_rng(7)
    ring = rng.uniform(0, 2 * np.pi, 900)
    x = np.concatenate([np.stack([10 * np.cos(ring), 10 * np.sin(ring)], 1), rng.normal(0, 0.5, (100, 2)), rng.uniform(20, 90, (30, 2))])
    got = {r["id"]: r["cluster"] for r in cluster.dbscan(frame(spark, x), "id", "v", 0.8, 4, block_rows=60).collect()}
    near = knn.distances(x, x) <= 0.8
    core = near.sum(1) >= 4
    assert len(set(got[i] for i in range(900) if core[i])) == 1 and all(got[i] == -1 for i in range(1000, 1030) if not near[i][core].any())
    assert len({got[i] for i in range(900, 1000) if core[i]}) == 1 and got[900] != got[0]
    assert frame(spark, x).where(F.col("id") >= 0).count() == len(got)


def by_pairs(x, eps, least):
    """Clusters from all distances."""
    near = knn.distances(x, x) <= eps
    core = near.sum(1) >= least
    label = np.arange(len(x))
    while True:
        new = np.where(core, np.where(near & core[None, :], label[None, :], len(x)).min(1), label)
        if (new == label).all():
            break
        label = new
    names = {c: k for k, c in enumerate(sorted(set(label[core].tolist())))}
    return {i: names[label[i]] if core[i] else min((names[label[j]] for j in np.flatnonzero(near[i] & core)), default=-1)
            for i in range(len(x))}


def ball(rng, n, radius):
    v = rng.normal(0, 1, (n, 3))
    return v / np.linalg.norm(v, axis=1, keepdims=True) * radius * rng.uniform(0, 1, (n, 1)) ** (1 / 3)


@pytest.mark.parametrize("case", ["spread", "touching", "apart"])
def test_clusters_of_cells_that_stay_whole(spark, case):
    rng = np.random.default_rng(8)
    if case == "spread":
        x = rng.normal(0, 1, (260, 24))
        x, eps = x / np.linalg.norm(x, axis=1, keepdims=True), 0.95
        x[200:205] = x[7]  # copies: a core by themselves
    else:
        # two balls that no cut parts, with one pair of rows in reach of each other, or none
        gap = 0.99 if case == "touching" else 1.01
        x, eps = np.concatenate([ball(rng, 130, 0.79), ball(rng, 130, 0.79) + [1.6 + gap, 0, 0], [[0.8, 0, 0], [0.8 + gap, 0, 0]]]), 1.0
    got = {r["id"]: r["cluster"] for r in cluster.dbscan(frame(spark, x), "id", "v", eps, 4, block_rows=40).collect()}
    want = by_pairs(x, eps, 4)
    assert got == want
    assert len(set(want.values()) - {-1}) == {"touching": 1, "apart": 2}.get(case, len(set(want.values()) - {-1}))


def test_compared_pairs_of_a_whole_cell_grow_with_its_rows(spark, monkeypatch):
    """Rows about as far apart as the distance, with many neighbours: not each is compared with each."""
    pairs = []
    join = eps_cells.block_join

    def counted(placed, fn, schema, limit=eps_cells.LIMIT, **some):
        asked, all_ = some.get("asked", placed.where("home")).count(), placed.count()
        met = min(all_, some.get("last", all_) * limit) - min(all_, some.get("first", 0) * limit)
        pairs.append(asked * met)
        return join(placed, fn, schema, limit, **some)

    monkeypatch.setattr(eps_cells, "block_join", counted)
    per_row = []
    for n in (400, 1600):
        x = np.random.default_rng(9).normal(0, 1, (n, 24))
        pairs.clear()
        got = cluster.dbscan(frame(spark, x / np.linalg.norm(x, axis=1, keepdims=True)), "id", "v", 1.13, 4, block_rows=100)
        assert got.where("cluster = 0").count() == n
        per_row.append(sum(pairs) / n)
    assert per_row[1] < 1.5 * per_row[0] and per_row[1] < 0.5 * 2 * 1600
