"""Neighbours of sparse rows against all pairs, and balancing of text rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.operators import sampling
from tallyloom.operators.sparse_topk import nearest_rows


def sparse(seed, n=120):
    """{key: {term: weight}} of unit length, with common and rare terms, copies and a lonely row."""
    rng = random.Random(seed)
    rows = {}
    for i in range(n):
        row = {f"t{int(rng.paretovariate(0.6))}" if rng.random() < 0.8 else f"t{rng.randrange(9)}": rng.random() + 0.1 for _ in range(rng.randint(1, 14))}
        size = math.sqrt(sum(w * w for w in row.values()))
        rows[i] = {t: w / size for t, w in row.items()}
    rows[n] = dict(rows[3])
    rows[n + 1] = dict(rows[3])
    rows[n + 2] = {"lonely": 1.0}
    return rows


def frame(spark, rows, groups=None):
    return spark.createDataFrame([(i, t, w, (groups or {}).get(i)) for i, r in rows.items() for t, w in r.items()],
                                 "id long, term string, weight double, y string")


def brute(rows, query, k, groups=None):
    scored = []
    for i, row in rows.items():
        if i != query and (groups is None or groups[i] == groups[query]):
            shared = row.keys() & rows[query].keys()
            if shared:
                scored.append((-round(sum(row[t] * rows[query][t] for t in shared), 12), i))
    return [i for _, i in sorted(scored)[:k]]


@pytest.mark.parametrize("postings", [1, 6, 1000])
def test_neighbours_are_those_of_all_pairs(spark, postings):
    rows = sparse(postings)
    df = frame(spark, rows)
    found = {}
    for r in nearest_rows(df.where("id % 3 = 0 OR id > 118"), df, "id", k=4, postings=postings).collect():
        found.setdefault(r["query_id"], []).append((r["place"], r["candidate_id"], r["score"]))
    asked = [i for i in rows if i % 3 == 0 or i > 118]
    for q in asked:
        got = sorted(found.get(q, []))
        assert [c for _, c, _ in got] == brute(rows, q, 4), q
        assert all(s == pytest.approx(sum(rows[q][t] * rows[c].get(t, 0.0) for t in rows[q])) for _, c, s in got)
    assert 122 not in found
    assert nearest_rows(df.where("id < 0"), df, "id").count() == 0


def test_groups_are_kept_apart(spark):
    rows = sparse(9)
    groups = {i: "ab"[i % 2] for i in rows}
    df = frame(spark, rows, groups)
    for r in nearest_rows(df.where("id < 30"), df, "id", k=3, group="y", postings=4).collect():
        assert r["candidate_id"] in brute(rows, r["query_id"], 3, groups)


def test_balanced_text_rows_lie_between_neighbours_of_their_class(spark):
    rows = sparse(4)
    groups = {i: "big" if i < 80 else "small" if i < 110 else None if i < 122 else "one" for i in rows}
    docs = spark.createDataFrame([(i, g) for i, g in groups.items()] + [(500, "small")], "id long, y string")
    made = {}
    for r in sampling.smote_sparse(docs, frame(spark, rows).drop("y"), "id", "y", k=3, postings=4).collect():
        made.setdefault((r["y"], r["draw"]), []).append(r)
    sizes = {g: sum(x == g for x in groups.values()) + (g == "small") for g in ("big", "small", None, "one")}
    assert {g: sum(y == g for y, _ in made) for g in sizes} == {g: 80 - n for g, n in sizes.items()}
    for (y, _), lines in made.items():
        base, other, step = lines[0]["base"], lines[0]["other"], lines[0]["step"]
        own = rows.get(base, {})
        near = brute(rows, base, 3, groups) if own else []
        assert (other in near and 0 <= step < 1) if near else other is None
        want = {t: (1 - step) * w for t, w in own.items()}
        for t, w in rows.get(other, {}).items():
            want[t] = want.get(t, 0.0) + step * w
        assert {x["term"]: x["weight"] for x in lines if x["term"] is not None} == pytest.approx(want)


def test_pairs_of_rows_are_not_written(spark, monkeypatch):
    """Terms that every row has give no table of pairs: what is written grows with the rows."""
    from tallyloom.operators import sparse_topk

    written = []
    keep = sparse_topk.cut_lineage

    def watched(df, label="stage"):
        out = keep(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(sparse_topk, "cut_lineage", watched)
    rows = {i: {f"t{j}": 0.1 + ((i * 7 + j * 3) % 11) / 10 for j in range(6)} for i in range(300)}
    df = frame(spark, rows)
    got = nearest_rows(df, df, "id", k=2).collect()
    assert len(got) == 600 and max(written) <= 300 * 6
    found = {}
    for r in sorted(got, key=lambda r: r["place"]):
        found.setdefault(r["query_id"], []).append(r["candidate_id"])
    assert all(found[q] == brute(rows, q, 2) for q in rows)


def test_synthetic_rows_meet_each_weight_once(spark, monkeypatch):
    """The weights of the drawn rows travel as one array a row, not as lines."""
    rows = sparse(4, 60)
    df = frame(spark, rows)
    docs = spark.createDataFrame([(i, "a" if i % 5 else "b") for i in rows], "id long, y string")
    written = {}
    keep = sampling.cut_lineage

    def watched(df, label="stage"):
        out = keep(df, label)
        written[label] = out.count()
        return out

    monkeypatch.setattr(sampling, "cut_lineage", watched)
    made = sampling.smote_sparse(docs, df.select("id", "term", "weight"), "id", "y", k=3).collect()
    assert 0 < written["packed"] <= len(rows)
    for line in made:
        a, b, s, t = rows[line["base"]], rows.get(line["other"], {}), line["step"], line["term"]
        assert line["weight"] == pytest.approx((1 - s) * a.get(t, 0.0) + s * b.get(t, 0.0))


def on_disk(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    size = 0
    while files.hasNext():
        size += files.next().length()
    return size


def test_queries_and_rows_are_not_copied_for_each_other(spark):
    rows = {i: {f"t{j}": 0.1 + ((i * 7 + j * 3) % 11) / 10 for j in range(6)} for i in range(400)}
    df = frame(spark, rows)
    before = on_disk(spark)
    got = nearest_rows(df, df, "id", k=2, postings=6).collect()
    assert len(got) == 800 and on_disk(spark) - before < 1_000_000


@pytest.mark.parametrize("scattered", [False, True])
def test_lots_and_scattered_rows_with_odd_terms(spark, monkeypatch, scattered):
    from tallyloom.operators import sparse_topk

    monkeypatch.setattr(sparse_topk, "LOT_BYTES", 400)
    rows = {f"k{i}": {t + "é\x00|:"[n % 4]: w for n, (t, w) in enumerate(r.items())} for i, r in sparse(7, 60).items()}
    df = spark.createDataFrame([(i, t, w) for i, r in rows.items() for t, w in r.items()] + [
        ("k1", "", 0.0), ("k2", None, 1.0), (None, "t1", 1.0), ("k3", "t1", -1.0)], "id string, term string, weight double")
    df = df.repartition(7, "term") if scattered else df
    found = {}
    for r in nearest_rows(df.where("id <> 'k5'"), df, "id", k=3).collect():
        found.setdefault(r["query_id"], []).append((r["place"], r["candidate_id"]))
    assert "k5" not in found
    for q in rows.keys() - {"k5"}:
        assert [c for _, c in sorted(found.get(q, []))] == brute(rows, q, 3), q


def test_a_task_keeps_the_best_of_its_blocks(monkeypatch):
    from tallyloom.operators import sparse_topk

    monkeypatch.setattr(sparse_topk, "SCORES", 50)
    rows = sparse(11)

    def table(names):
        names = [i for i in names if rows[i]]
        return pa.table({"id": names, "terms": pa.array([b"".join(t.encode() + b"\xff" for t in rows[i]) for i in names], pa.binary()),
                         "weights": pa.array([np.array([*rows[i].values()]).tobytes() for i in names], pa.binary())})

    class Shared:
        value = sparse_topk.lot_of(table([i for i in rows if i % 3 == 0]))

    order = random.Random(2).sample([*rows], len(rows))
    whole = pa.Table.from_batches(sparse_topk.searched(Shared, 4, 9)(iter(table(order).combine_chunks().to_batches(max_chunksize=11)))).to_pylist()
    found = {}
    for r in whole:
        found.setdefault(r["q"], []).append((-r["score"], r["c"]))
    for q in rows:
        if q % 3 == 0:
            assert [c for _, c in sorted(found.get(q, []))] == brute(rows, q, 4), q


def test_terms_of_documents_are_counted_where_they_are(spark, sf_dir, monkeypatch):
    """A document's texts travel once; parts of a bounded size count them."""
    from tallyloom.operators import features
    from tallyloom.plans import QUERIES, joins, load_all

    load_all()
    seen, keep = [], features.term_counts
    monkeypatch.setattr(joins, "TEXT_PART", 1000)
    monkeypatch.setattr(features, "term_counts", lambda *a: (seen.append(keep(*a)), seen[-1])[1])
    got = QUERIES["J11_sparse_similarity_topk"](spark, sf_dir).collect()
    assert got and seen[0]._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    size = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]
    assert seen[0].rdd.getNumPartitions() == max(8, size // 1000)
