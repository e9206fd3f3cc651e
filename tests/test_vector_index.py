"""The neighbour index against all pairs, and balancing that uses it."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import knn, sampling, vector_index


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 5, (150, 24))
    v = centres[rng.integers(0, 150, 9000)] + rng.normal(0, 1, (9000, 24))
    return v, spark.createDataFrame([(i, x.tolist(), "ab"[i % 2]) for i, x in enumerate(v)], "id long, v array<double>, g string").cache()


def test_recall_on_the_embeddings(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    asked = v.where("vec_id % 5 = 0")
    index = vector_index.build(v, "vec_id", "embedding")
    found = vector_index.search(index, asked, "vec_id", "embedding", k=7, probes=math.ceil(index.cells / 2), exclude_self=True)
    exact = knn.nearest(asked, v, "vec_id", "embedding", k=7, exclude_self=True)
    assert vector_index.recall(found, exact) >= 0.9
    assert found.groupBy("query_id").count().where("count <> 7").count() == 0


def test_few_cells_find_clustered_neighbours(clustered):
    v, rows = clustered
    asked = rows.where("id % 20 = 0")
    index = vector_index.build(rows, "id", "v", block_rows=50)
    found = vector_index.search(index, asked, "id", "v", k=5, probes=12, block_rows=100, exclude_self=True).cache()
    assert index.codes.count() == 9000 and index.cells == 190
    ids = np.arange(0, 9000, 20)
    d = np.sqrt(((v[ids][:, None] - v[None]) ** 2).sum(-1))
    d[np.arange(len(ids)), ids] = np.inf
    want = {(int(q), int(c)) for q, row in zip(ids, np.argsort(d, axis=1)[:, :5]) for c in row}
    got = {(r["query_id"], r["candidate_id"]): r for r in found.collect()}
    assert len(want & set(got)) / len(want) >= 0.95
    # what is found has true distances, in order
    for (q, c), r in list(got.items())[:300]:
        assert r["distance"] == pytest.approx(d[q // 20, c])
    by = {}
    for r in got.values():
        by.setdefault(r["query_id"], []).append((r["place"], r["distance"]))
    assert all([d for _, d in sorted(x)] == sorted(d for _, d in x) for x in by.values())
    # the codes of visited rows are a small part of all
    visited = index.codes.groupBy("cell").count().agg(F.avg("count")).first()[0] * 12
    assert visited < 0.1 * 9000


def test_groups_are_kept_apart_and_nulls_left_out(spark, clustered):
    _, rows = clustered
    more = rows.unionByName(spark.createDataFrame([(-1, None, "a")], "id long, v array<double>, g string"))
    index = vector_index.build(more, "id", "v", group="g")
    found = vector_index.search(index, more.where("id < 40"), "id", "v", k=3, probes=index.cells, group="g")
    assert found.where((F.col("query_id") - F.col("candidate_id")) % 2 != 0).count() == 0
    assert found.count() == 40 * 3 and found.where("place = 1 AND query_id <> candidate_id").count() == 0


def test_copies_of_one_vector_and_small_tables(spark):
    rows = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(500)] + [(900, [5.0, 5.0])], "id long, v array<double>")
    index = vector_index.build(rows, "id", "v", block_rows=60)
    found = vector_index.search(index, rows.where("id IN (3, 900)"), "id", "v", k=4, probes=9, exclude_self=True)
    got = {(r["query_id"], r["distance"]) for r in found.collect()}
    assert got == {(3, 0.0), (900, 5.0)} and found.count() == 8
    with pytest.raises(ValueError, match="no vectors"):
        vector_index.build(rows.where("id < 0"), "id", "v")


@pytest.mark.parametrize("share", [None, 1.0, 0.6])
def test_balanced_rows_lie_between_neighbours_of_their_class(spark, share):
    rng = np.random.default_rng(8)
    sizes = {"big": 120, "mid": 60, "one": 1, None: 4}
    rows = [(i, c, rng.normal(0, 1, 6).tolist()) for i, c in enumerate([c for c, n in sizes.items() for _ in range(n)])]
    df = spark.createDataFrame(rows, "id long, y string, v array<double>")
    out = sampling.smote(df, "id", "v", "y", k=3, share=share).collect()
    assert {c: sum(r["y"] == c for r in out) for c in sizes} == dict.fromkeys(sizes, 120)
    by = {c: np.array([v for _, x, v in rows if x == c]) for c in sizes}
    for r in out:
        if not r["synthetic"]:
            continue
        own, x, fits = by[r["y"]], np.array(r["v"]), False
        d = np.sqrt(((own[:, None] - own[None]) ** 2).sum(-1))
        for i in range(len(own)):
            near = np.argsort(d[i], kind="stable")[1:4] if share != 0.6 else np.arange(len(own))
            for j in near if len(own) > 1 else [i]:
                way = own[j] - own[i]
                t = (x - own[i]) @ way / (way @ way) if i != j else 0.0
                fits |= bool(-1e-9 <= t <= 1 + 1e-9 and np.allclose(own[i] + t * way, x))
        assert fits
