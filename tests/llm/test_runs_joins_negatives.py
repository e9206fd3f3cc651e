"""Periodic runs, the bitmap join and hard negatives, against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import brute
from pyspark.sql import functions as F
from tallyloom.llm import bitmap_tiles, kruskal_runs, shared_lists
from tallyloom.llm import words as tw
from tallyloom.llm.queries import QUERIES, looped

SCHEMA = "doc_id long, text string, id string, runs int, n_words int, `Key` string, band int"


def docs(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "x", 1, 2, "y", 3) for d, t in rows], SCHEMA)


def periodic_texts(seed):
    rng = random.Random(seed)
    out = [None, "", " \n", "a", "a a", "x " * 400, "x " * 11, "x " * 12, "ab ba " * 6, "a b c " * 4, ("a b c " * 4)[:-2]]
    for _ in range(120):
        letters = rng.choice([["a"], ["a", "b"], ["a", "b", "c"], [f"w{i}" for i in range(30)]])
        say = lambda k: [rng.choice(letters) for _ in range(k)]
        parts = []
        for _ in range(rng.randint(1, 5)):
            unit = say(rng.randint(1, 14))
            parts += rng.choice([say(rng.randint(0, 25)), unit * rng.randint(1, 6) + unit[:rng.randint(0, len(unit))]])
        out.append(" \t\n"[rng.randrange(3)].join(parts))
    # nested runs: Fibonacci and repeated repetitions
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    return out + [" ".join(b), " ".join((["u", "u", "u", "v"] * 5 + ["z"]) * 6), out[20], out[20]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_are_all_found(spark, seed):
    rows = list(enumerate(periodic_texts(seed)))
    got = kruskal_runs.collapse_runs(docs(spark, rows), id="doc_id", text="text").collect()
    assert len(got) == len(rows)
    for r in got:
        ws = brute.words(rows[r["doc_id"]][1])
        runs = brute.periodic_runs(ws)
        assert [tuple(x) for x in r["runs"]] == runs, rows[r["doc_id"]]
        assert (r["n_words"], r["collapsed_text"]) == (len(ws), brute.collapsed(ws, runs))


@pytest.mark.parametrize("least", [2, 3, 7])
def test_shorter_runs(least):
    rng = random.Random(least)
    for _ in range(60):
        ws = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        piece = tw.Texts(np.frombuffer(" ".join(ws).encode(), np.uint8), np.array([0, max(0, 2 * len(ws) - 1)]), np.zeros(1, bool))
        parts = tw.split(piece)
        h = tw.hash_spans(piece.data, parts.start, parts.end)
        assert [tuple(x) for x in kruskal_runs.runs_of(h, parts, least).tolist()] == brute.periodic_runs(ws, least)


def test_runs_of_a_long_text_and_odd_ids(spark):
    rng = random.Random(5)
    unit = [f"w{rng.randrange(50)}" for _ in range(700)]
    text = " ".join([f"v{i}" for i in range(200_000)] + unit * 300 + ["end"])
    rows = [(None, text), (1, "a b " * 9), (1, "a b " * 9)]
    got = kruskal_runs.collapse_runs(docs(spark, rows), id="doc_id", text="text").collect()
    long = next(r for r in got if r["doc_id"] is None)
    assert [tuple(x) for x in long["runs"]] == [(200_000, 210_000, 700)] and long["n_words"] == 410_001
    assert [[tuple(x) for x in r["runs"]] for r in got if r["doc_id"] == 1] == [[(0, 18, 2)]] * 2
    assert kruskal_runs.collapse_runs(docs(spark, []), id="doc_id", text="text").count() == 0


def test_the_query_loops_every_tenth_document(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op11_kruskal_runs"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ws, h = brute.words(texts[r["doc_id"]]), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and ws:
            a = h // 10 % len(ws)
            p = 1 + (len(ws) - a) // (3 + h // 10 % 8)
            ws = [ws[a + (i - a) % p] if i >= a else w for i, w in enumerate(ws)]
        if len(ws) > 1500:
            continue  # plain Python is quadratic
        runs = brute.periodic_runs(ws)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], (r["start"], r["length"], r["period"])) == (len(runs), best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(brute.collapsed(ws, runs).encode()).hexdigest()


def test_looped_keeps_empty_and_null_texts(spark):
    rows = [(i, t) for i in range(60) for t in (None, "", " ")]
    assert {r["text"] for r in looped(docs(spark, rows)).collect()} <= {None, "", " "}


def near_texts(seed, n=40):
    rng = random.Random(seed)
    say = lambda k: [f"w{rng.randrange(300)}" for _ in range(k)]
    out = [None, "", " \n", "one", "ONE", "a b c d e", "A b c d e", "a b c d"]
    for size in (12, 40, 90, 200):
        base = say(size)
        for _ in range(n // 2):
            t = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                t[rng.randrange(len(t))] = f"w{rng.randrange(300)}"
            if rng.random() < 0.3:
                t = t[:rng.randint(int(0.7 * size), size)] + say(rng.randint(0, size // 8))
            out.append(" ".join(t).upper() if rng.random() < 0.2 else " ".join(t))
    licence = " ".join(say(20))
    out += [" ".join(say(rng.randint(5, 60)) + [licence]) for _ in range(n)]
    return out + [out[10], out[10], " ".join(say(5000))]


@pytest.mark.parametrize("seed, tile_rows, block_shingles", [(1, 4096, 2_000_000), (2, 4, 400), (3, 3, 150)])
def test_classes_are_those_of_all_pairs(spark, seed, tile_rows, block_shingles, monkeypatch):
    rng = random.Random(seed)
    texts = near_texts(seed)
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    got = bitmap_tiles.jaccard_classes(docs(spark, rows), id="doc_id", text="text", tile_rows=tile_rows,
                                       block_shingles=block_shingles).collect()
    want = brute.near_classes(rows, 5)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(brute.shingles(t, 5)) for d, t in rows}


def test_common_shingles_only_move_in_the_order(spark, monkeypatch):
    texts = near_texts(7)
    rows = list(enumerate(texts))
    every = np.unique(np.concatenate([_hashes(t) for t in texts]))
    monkeypatch.setattr(bitmap_tiles, "common_shingles", lambda _: np.sort(every[::3]))
    got = bitmap_tiles.jaccard_classes(docs(spark, rows), id="doc_id", text="text").collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute.near_classes(rows, 5)


def _hashes(text):
    body = (text or "").encode()
    piece = tw.Texts(np.frombuffer(body, np.uint8), np.array([0, len(body)]), np.zeros(1, bool))
    return bitmap_tiles.shingle_sets(piece, 5)[0]


def test_join_with_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(5, text), (5, text), (2, text + " more"), (None, text), (None, None), (7, None), (8, "")]
    got = bitmap_tiles.jaccard_classes(docs(spark, rows), id="doc_id", text="text").collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=str) == sorted(
        [(5, 2), (5, 2), (2, 2), (None, None), (None, None), (7, 7), (8, 8)], key=str)
    assert bitmap_tiles.jaccard_classes(docs(spark, []), id="doc_id", text="text").count() == 0


def test_bit_counts_bound_the_difference():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64))
    for drop in (0, 5, 60, 300):
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, drop, dtype=np.uint64)]))
        both = np.concatenate([a, b])
        x, y = (np.frombuffer(m.tobytes(), np.uint64) for m in bitmap_tiles.bitmaps(
            both, np.array([0, len(a), len(both)]), np.array([1024, 1024])))
        differ = int(np.bitwise_count(x ^ y).sum())
        assert differ <= len(np.setxor1d(a, b)) and (drop == 0) == (differ == 0)


VECTORS = "vec_id long, label int, v array<long>, ask boolean, id string, score int, `place` string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)


@pytest.mark.parametrize("seed, group_rows, block_rows", [(1, 4096, 1 << 16), (2, 5, 40)])
def test_negatives_are_those_of_all_pairs(spark, seed, group_rows, block_rows):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 60, (6, 12))
    rows = [(i, int(rng.integers(0, 5)), np.floor(centres[rng.integers(0, 6)] + rng.normal(0, 25, 12)).astype(int).tolist(), i % 3 == 0)
            for i in range(260)]
    rows += [(300 + i, i % 2, rows[3][2], i % 2 == 0) for i in range(30)]  # ties
    rows += [(400, 1, [0] * 12, True), (401, 9, [1] * 12, True)]  # no direction; no other row of its label
    got = shared_lists.hard_negatives(vectors(spark, rows), id="vec_id", vector="v", label="label", anchor="ask",
                                      group_rows=group_rows, block_rows=block_rows).collect()
    assert {tuple(r) for r in got} == brute.mined(rows) and len(got) == len(brute.mined(rows))


def test_negatives_with_nulls_repeats_and_short_vectors(spark):
    rows = [(0, 1, [4, 4], True), (1, 1, [4, 2], False), (2, 2, [2, 2], False), (3, 2, [1], False), (4, 1, None, True),
            (5, None, [9, 9], True), (None, 2, [2, 2], False), (6, 2, [2, None], False), (7, 2, [2, 1], None)]
    whole = [r for r in rows if r[0] in (0, 1, 2, 7)] + [(3, 2, [1, 0], False)]
    got = shared_lists.hard_negatives(vectors(spark, rows + [rows[1]]), id="vec_id", vector="v", label="label", anchor="ask")
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.mined(whole))
    ask = {"id": "vec_id", "vector": "v", "label": "label", "anchor": "ask"}
    assert shared_lists.hard_negatives(vectors(spark, []), **ask).count() == 0
    assert shared_lists.hard_negatives(vectors(spark, [(1, 1, [1], False)]), **ask).count() == 0


def test_walks_stop_early_and_stay_exact():
    rng = np.random.default_rng(3)
    items = rng.normal(0, 10, (20_000, 8)) * rng.lognormal(0, 0.7, (20_000, 1))
    items = np.rint(items)
    members = np.rint(items[np.argsort(-items[:, 0])[:20]])
    score, place, read = shared_lists.walk(members, items, lambda a, p, s, slot: np.ones(s.shape, bool),
                                           np.full((20, 1), shared_lists.NONE), 5)
    want = np.sort(members @ items.T, axis=1)[:, -5:]
    assert np.array_equal(np.sort(score[:, 0], axis=1), want) and read < 0.5 * 20 * len(items)
