"""Block joins against brute force, with blocks far smaller than the cells."""

import numpy as np
import pytest

from tallyloom.operators import cluster, features, knn, stats


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6)) * 4
    at = np.r_[np.zeros(90, int), rng.integers(0, 4, 60)]  # one crowded group
    return np.arange(150), centres[at] + rng.normal(size=(150, 6)), at


@pytest.fixture(scope="module")
def df(spark, points):
    return spark.createDataFrame([(int(i), v.tolist(), int(c)) for i, v, c in zip(*points)], "id long, v array<double>, c int")


def test_nearest_is_exact(df, points):
    ids, x, _ = points
    got = {}
    for r in knn.nearest(df, df, "id", "v", k=4, exclude_self=True, block_rows=16).collect():
        got.setdefault(r.query_id, {})[r.place] = r.candidate_id
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in ids:
        assert [got[i][p] for p in (1, 2, 3, 4)] == np.argsort(d[i], kind="stable")[:4].tolist()


def test_more_neighbours_than_candidates(spark, df):
    few = df.filter("id < 3")
    assert knn.nearest(df, few, "id", "v", k=5, block_rows=16).count() == 150 * 3


def dbscan_reference(x, eps, min_points):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    near = d <= eps
    core = near.sum(1) >= min_points
    label, nxt = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] == -1:
            todo = [i]
            while todo:
                j = todo.pop()
                if label[j] == -1:
                    label[j] = nxt
                    if core[j]:
                        todo += [k for k in np.flatnonzero(near[j]) if label[k] == -1]
            nxt += 1
    return label


@pytest.mark.parametrize("eps", [1.5, 2.2])
def test_dbscan(df, points, eps):
    got = {r.id: r.cluster for r in cluster.dbscan(df, "id", "v", eps, 4, block_rows=16).collect()}
    want = dbscan_reference(points[1], eps, 4)
    assert [got[i] for i in points[0]] == want.tolist()


def test_silhouette(df, points):
    ids, x, c = points
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    got = {r.id: r.silhouette for r in stats.silhouette(df, "id", "v", "c").collect()}
    for i in ids:
        a = d[i][c == c[i]].sum() / ((c == c[i]).sum() - 1)
        b = min(d[i][c == o].mean() for o in set(c) - {c[i]})
        assert got[i] == pytest.approx((b - a) / max(a, b), abs=1e-9)


def test_knn_vote_weights(spark):
    train = spark.createDataFrame([(1, [0.0], 0), (2, [1.0], 1), (3, [1.1], 1), (4, [0.05], 0)], "id long, v array<double>, y int")
    query = spark.createDataFrame([(10, [0.0]), (11, [0.9])], "id long, v array<double>")
    got = {r.id: r.prediction for r in cluster.knn_vote(train, query, "id", "v", "y", k=3, weights="distance").collect()}
    assert got == {10: 0, 11: 1}
    mean = {r.id: r.prediction for r in cluster.knn_vote(train, query, "id", "v", "y", k=4, regression=True).collect()}
    assert mean == {10: 0.5, 11: 0.5}


def test_vector_helpers(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(features.l2_normalise(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    assert df.select(features.pad_or_truncate(F.col("v"), 3)).first()[0] == [3.0, 4.0, 0.0]
    assert df.select(features.pad_or_truncate(F.col("v"), 1)).first()[0] == [3.0]


def test_crowd_of_copies(spark):
    """A third of the rows are one vector: k neighbours each, one cluster."""
    rows = [(i, [0.0, 0.0] if i % 3 == 0 else [float(i % 17), float(i % 13) + 5.0]) for i in range(240)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    near = knn.nearest(df, df, "id", "v", k=3, exclude_self=True, block_rows=16)
    assert near.count() == 240 * 3
    zero = {}
    for r in near.collect():
        zero.setdefault(r.query_id, []).append((r.place, r.candidate_id))
    assert [c for _, c in sorted(zero[0])] == [3, 6, 9] and [c for _, c in sorted(zero[9])] == [0, 3, 6]
    x = np.array([v for _, v in rows])
    got = {r.id: r.cluster for r in cluster.dbscan(df, "id", "v", 1.2, 5, block_rows=16).collect()}
    assert [got[i] for i, _ in rows] == dbscan_reference(x, 1.2, 5).tolist()


def test_probing_reads_few_cells_and_finds_most_neighbours(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(200, 16)) * 4
    x = centres[rng.integers(200, size=20000)] + rng.normal(size=(20000, 16)) * 0.3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    asked = df.filter("id % 100 = 0")
    cells = knn.Cells(knn.as_double(df, "id", "v", "euclidean"))
    home = cells.tag(knn.as_double(asked, "id", "v", "euclidean")).drop("gap", "cell")
    assert cells.probe(home, 8).count() == 200 * 8 and 8 < 0.2 * len(cells.pivots)
    got = {}
    for r in knn.nearest(asked, df, "id", "v", k=5, exclude_self=True, probes=8).collect():
        got.setdefault(r.query_id, set()).add(r.candidate_id)
    hits = 0
    for i in range(0, 20000, 100):
        d = ((x - x[i]) ** 2).sum(1)
        d[i] = np.inf
        hits += len(got[i] & set(np.argsort(d)[:5].tolist()))
    assert hits >= 0.9 * 5 * 200


def test_a_vector_is_at_no_distance_from_itself(spark):
    v = np.random.default_rng(2).normal(size=(50, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "id long, v array<double>")
    assert {r.distance for r in knn.nearest(df, df, "id", "v", k=1).collect()} == {0.0}


def test_knn_predict_is_exact_with_many_cells(spark, tmp_path):
    """M03 has exact SQL: with more cells than it once probed, every prediction equals brute force."""
    from tallyloom.plans import QUERIES, load_all

    load_all()
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(16000, 24)), rng.integers(6, size=16000)
    rows = [(i if i < 4000 else 4 * i + 1, int(c), v.tolist()) for i, (v, c) in enumerate(zip(x, y))]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r["prediction"] for r in QUERIES["M03_knn_predict"](spark, str(tmp_path)).collect()}
    held = np.array([r[0] % 4 == 0 for r in rows])
    ids, labels, known = np.array([r[0] for r in rows])[~held], y[~held], x[~held]
    want = {}
    for i in np.flatnonzero(held):
        near = np.lexsort((ids, ((known - x[i]) ** 2).sum(1)))[:7]
        want[rows[i][0]] = int(np.bincount(labels[near]).argmax())
    assert len(known) > 4 * 33**2 and got == want
