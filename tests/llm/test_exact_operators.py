"""Operators with an exact definition, against plain Python."""

import random

import numpy as np
import pytest

import brute
from pyspark.sql import functions as F
from tallyloom.llm import length_buckets, line_frequency, lsh_forest, prefix_join, substring_dedup
from tallyloom.llm.components import components

SCHEMA = "doc_id long, text string, source string, words int, id string, `_text` string, a int"


def table(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, s, 1, "x", "y", 2) for d, t, s in rows], SCHEMA)


def passages(seed, n=60):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(40)] + ["Éa", "ß-x", "THE", "the", "a.b"]
    say = lambda k: " ".join(rng.choice(pool) for _ in range(k))
    shared = [say(rng.randint(15, 60)) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = [say(rng.randint(0, 30)) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.7:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        docs.append(rng.choice([" ", "\n", "\t  \x0b"]).join(parts))
    docs += [None, "", " \n\t", "one", docs[0], docs[0], docs[3].upper(), say(3000), "x " * 500, "  \x1c   \n"]
    ids = list(range(len(docs)))
    rng.shuffle(ids)
    return [(i, t, rng.choice(["h0", "h0", "h1", None])) for i, t in zip(ids, docs)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_are_removed(spark, seed):
    rows = passages(seed)
    out = substring_dedup.remove_repeats(table(spark, rows), id="doc_id", text="text", window=20, block_bytes=4000)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["digest"])
           for r in out.withColumn("digest", F.sha2("kept_text", 256)).collect()}
    assert got == brute.without_repeats([(d, t) for d, t, _ in rows])


def test_repeats_with_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(1, text, ""), (1, text, ""), (2, text, ""), (None, text, ""), (None, text, "")]
    out = substring_dedup.remove_repeats(table(spark, rows), id="doc_id", text="text").collect()
    assert sorted(((r["doc_id"] or -1), r["n_removed"]) for r in out) == [(-1, 0), (-1, 0), (1, 0), (1, 0), (2, 50)]


@pytest.mark.parametrize("seed", [4, 5])
def test_benchmark_windows_are_found(spark, seed):
    rows = passages(seed)
    rng = random.Random(seed)
    texts = [t for _, t, _ in rows if t and len(t.split()) > 30]
    items = [(i, " ".join(rng.choice(texts).split()[5:5 + rng.choice([1, 2, 3, 9, 10, 14])]).lower()) for i in range(8)]
    items += [(90, None), (91, ""), (None, texts[0]), (8, items[0][1]), (8, items[0][1])]
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, window int")
    out = prefix_join.decontaminate(table(spark, rows), bench, id="doc_id", text="text", item="item_id", item_text="text",
                                    block_windows=7).collect()
    want = brute.contamination([(d, t) for d, t, _ in rows], [(i, t) for i, t in items if i is not None])
    null = brute.contamination([(d, t) for d, t, _ in rows], [(0, t) for i, t in items])
    for r in out:
        assert (r["n_words"], r["items"]) == (want[r["doc_id"]][0], want[r["doc_id"]][2])
        assert len(r["hits"]) == null[r["doc_id"]][1] and r["contaminated"] == bool(r["hits"])
    kept = prefix_join.clean_documents(table(spark, rows), bench, text="text", item="item_id", item_text="text")
    assert kept.columns == table(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if not r["contaminated"]}


@pytest.mark.parametrize("seed", [6, 7])
def test_line_rules(spark, seed):
    rng = random.Random(seed)
    common = ["Licensed Under 12", "licensed  under 99", "Menu", "#a | b"]
    rows = []
    for i in range(80):
        lines = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randint(0, 25))) for _ in range(5)]
        lines += rng.sample(common, rng.randint(0, 4)) * rng.choice([1, 2])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "a", "b", None])))
    rows += [(80, None, "a"), (81, "", "a"), (82, "\n\n", None), (83, "x y z " * 40, "b"), (84, rows[0][1], rows[0][2])]
    docs = table(spark, rows)
    got = {r["doc_id"]: r for r in line_frequency.line_rules(docs, id="doc_id", text="text", host="source", max_docs=9,
                                                             min_left=0.3).collect()}
    fold = lambda x: tuple(brute.words("".join("0" if c in "0123456789" else c for c in x.translate(brute.FOLD))))
    holders = {}
    for _, t, s in rows:
        for line in (t or "").split("\n"):
            holders.setdefault((fold(line), s), set()).add(t)
    for d, t, s in rows:
        facts, r = brute.line_facts(t), got[d]
        assert facts == tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        gone = [i for i, x in enumerate((t or "").split("\n")) if fold(x) and len(holders[fold(x), s]) > 9]
        left = facts[0] - sum(len(brute.words(t.split("\n")[i])) for i in gone)
        failed = facts[0] < 50 or 100 * facts[4] > 50 * facts[0]
        assert (r["removed_lines"], r["words_left"], r["base_failed"]) == (gone, left, failed)
        assert r["kept"] == (not failed and left >= 0.3 * facts[0])
    clean = line_frequency.clean_documents(docs, id="doc_id", text="text", host="source", max_docs=9)
    assert clean.columns == docs.columns
    for r in clean.collect():
        source = dict((d, t) for d, t, _ in rows)[r["doc_id"]].split("\n")
        assert r["text"] == "\n".join(x for i, x in enumerate(source) if i not in got[r["doc_id"]]["removed_lines"])


def edited(seed):
    """Texts with exact copies, chains of edits around the threshold, and short ones."""
    rng = random.Random(seed)
    say = lambda k: [f"v{rng.randrange(5000)}" for _ in range(k)]
    docs = []
    for _ in range(12):
        base = say(rng.choice([1, 2, 3, 4, 5, 30, 120, 300]))
        for _ in range(rng.randint(1, 12)):
            docs.append(list(base))
            for _ in range(rng.randint(0, 1 + len(base) // 25)):
                base[rng.randrange(len(base))] = f"v{rng.randrange(5000)}"
    texts = [" ".join(x) for x in docs] + [None, "", " ", "v1", "V1", docs[0][0].upper()]
    ids = rng.sample(range(1000), len(texts))
    return list(zip(ids, texts, ["s"] * len(texts)))


@pytest.mark.parametrize("seed,size,block", [(1, 4, 2_000_000), (2, 5, 2_000_000), (3, 4, 400), (4, 5, 1)])
def test_near_duplicates(spark, seed, size, block):
    rows = edited(seed)
    out = lsh_forest.near_duplicates(table(spark, rows), id="doc_id", text="text", shingle=size, crowd=3 if seed == 3 else 10_000,
                                     block_shingles=block).collect()
    want = brute.near_classes([(d, t) for d, t, _ in rows], size)
    text = {d: t for d, t, _ in rows}
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    for r in out:
        assert r["n_shingles"] == len(brute.shingles(text[r["doc_id"]], size))
        assert r["kept"] == (r["doc_id"] == want[r["doc_id"]])


def test_near_duplicates_with_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(7, text, ""), (7, text, ""), (9, text, ""), (None, text, ""), (3, None, ""), (None, None, "")]
    out = lsh_forest.near_duplicates(table(spark, rows), id="doc_id", text="text").collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in out) == sorted(
        [("7", "7", True), ("7", "7", True), ("9", "7", False), ("None", "None", True), ("3", "3", True), ("None", "None", True)])
    kept = lsh_forest.keep_first(table(spark, rows), id="doc_id", text="text")
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["3", "7", "None", "None"]
    assert kept.columns == table(spark, rows).columns


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (2001, 2000)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {2000: 2000, 2001: 2000}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_bounds_are_optimal(seed):
    import itertools

    rng = np.random.default_rng(seed)
    longest = np.sort(rng.choice(200, 9, replace=False)) + 1
    n, k = rng.integers(1, 30, 9), 3
    total = n * longest

    def padding(bounds):
        return sum(int(c) * (min(b for b in bounds if b >= x) - int(x)) for x, c in zip(longest, n))

    best = min(padding([*c, longest[-1]]) for r in range(k) for c in itertools.combinations(longest[:-1].tolist(), r))
    assert padding(length_buckets.best_bounds(longest, n, total, k)) == best


def test_batches_hold_every_document_within_the_budget(spark):
    rows = passages(8, 200)
    rows += rows[:3]
    out = length_buckets.pack(table(spark, rows), id="doc_id", text="text", tokens_per_batch=300, buckets=5, slice_rows=17)
    got = out.toPandas()
    assert sorted(got.doc_id) == sorted(d for d, _, _ in rows)
    want = {d: len(brute.words(t)) for d, t, _ in rows}
    assert (got.n_words == got.doc_id.map(want)).all() and (got.padding >= 0).all()
    assert (got.bucket_length - got.n_words.clip(lower=1) == got.padding).all()
    assert not got.duplicated(["bucket", "batch", "slot"]).any()
    per = got.groupby(["bucket", "batch"]).agg(n=("slot", "size"), length=("bucket_length", "first"), last=("slot", "max"))
    assert ((per.n * per.length <= 300) | (per.n == 1)).all() and (per["last"] == per.n - 1).all()
    for bucket, own in per.groupby(level=0):
        assert (own.n.iloc[:-1] == max(1, 300 // own.length.iloc[0])).all()


def test_empty_tables(spark):
    docs = table(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    some = table(spark, [(1, "a b", "s")])
    assert substring_dedup.remove_repeats(docs, id="doc_id", text="text").count() == 0
    assert prefix_join.decontaminate(docs, bench, id="doc_id", text="text", item="item_id", item_text="text").count() == 0
    assert not prefix_join.decontaminate(some, bench, id="doc_id", text="text", item="item_id", item_text="text").first()["contaminated"]
    assert line_frequency.line_rules(docs, id="doc_id", text="text", host="source").count() == 0
    assert lsh_forest.near_duplicates(docs, id="doc_id", text="text").count() == 0
    assert length_buckets.pack(docs, id="doc_id", text="text").count() == 0
