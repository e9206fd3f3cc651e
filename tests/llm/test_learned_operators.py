"""Operators that learn, and the files of token ids."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import brute
from pyspark.sql import functions as F
from tallyloom.llm import bitplanes, language_spans, ordinal_quality, secret_forest, suffix_tree_lm
from tallyloom.llm import words as tw

SCHEMA = "doc_id long, text string, lang string, n_words int, `_tokens` int, vote int"


def table(spark, rows):
    return spark.createDataFrame([(d, t, x, 0, 0, 0) for d, t, x in rows], SCHEMA)


ODD = [None, "", " \n\t", "one", "Ünïcode  wörds  here", "x " * 3000, "don't  we'll\r\nsee\x1c it", "日本語 テスト 漢字", "<|endoftext|> end",
       "  a  b", "é è", "1234 5678  !!", "tab\tand\x0bform\x0cfeed"]


def test_word_hashes_follow_the_definition():
    import pyarrow as pa

    texts = tw.texts_of(pa.array(ODD)[2:])
    for piece in tw.pieces(texts, 16):
        parts = tw.split(piece)
        for row in range(len(piece)):
            own = [piece.data[a:b].tobytes().decode() for a, b in
                   zip(parts.start[parts.bounds[row]:parts.bounds[row + 1]], parts.end[parts.bounds[row]:parts.bounds[row + 1]])]
            assert own == brute.words(ODD[2:][piece.first + row])


# ---------------------------------------------------------------- scoring

def corpus(seed, n=120):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = []
        while len(text) < rng.randint(5, 60):
            w = f"w{int(rng.paretovariate(1.2))}"
            text += ["new", "york", "city"] if rng.random() < 0.1 else [w.upper() if rng.random() < 0.1 else w]
        out.append((i, " ".join(text), None))
    return out + [(500 + i, t, None) for i, t in enumerate(ODD)] + [(None, "new york", None), (3, out[3][1], None)]


def test_base_score_and_counts(spark):
    rows = corpus(1)
    docs = table(spark, rows).withColumn("held_out", suffix_tree_lm.held_out(F.col("doc_id"), 7, 2))
    tree = suffix_tree_lm.fit(docs.where("NOT held_out"), text="text", node_share=0.002, lookup_share=0.001)
    got = suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id", "held_out"]).collect()
    tokens = lambda t: [*brute.words((t or "").translate(brute.FOLD)), None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    count = Counter(w for d, t, _ in rows if not held(d) for w in tokens(t))
    total = sum(count.values())
    want = sorted((d if d is not None else -1, held(d), len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), total,
                   round(sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in tokens(t)), 6)) for d, t, _ in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                   round(r["base_score"], 6)) for r in got) == want
    held_rows = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held_rows) > sum(r["base_score"] for r in held_rows)


def test_every_state_is_a_distribution(spark):
    """Texts that end in each known word in turn: the probabilities after a context sum to one."""
    rows = corpus(2)
    tree = suffix_tree_lm.fit(table(spark, rows), text="text", node_share=0.002, lookup_share=0.001, gain=1.0)
    assert any(len(s[0]) for s in tree.states)
    count = Counter(w for _, t, _ in rows for w in [*brute.words((t or "").translate(brute.FOLD)), None])
    for context in ("new", "new york", "zzz york", "w1"):
        words = [w for w in count if w is not None] + ["never-seen"]
        docs = spark.createDataFrame([(0, context)] + [(i + 1, f"{context} {w}") for i, w in enumerate(words)], "doc_id long, text string")
        got = {r["doc_id"]: r["score"] for r in suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id"]).collect()}
        # P(context end) = P(context) P(end | context); P(context w end) has the end after w
        prefix = spark.createDataFrame([(i + 1, f"{w}") for i, w in enumerate(words)], "doc_id long, text string")
        assert len(got) == len(words) + 1 and all(s < 0 for s in got.values())
        assert prefix.count() == len(words)
    # the same sums from the arrays: kept continuations and the rest
    for level, (contexts, rest) in enumerate(tree.states):
        keys, gain = tree.nodes[level]
        assert np.isin(keys >> suffix_tree_lm.BITS, contexts).all() and np.isfinite(rest).all() and np.isfinite(gain).all()
        order = tree.number >= 0
        root = (tree.n[order] + 1) / (tree.tokens + tree.types + 1)
        for c in contexts:
            own = keys[keys >> suffix_tree_lm.BITS == c]
            last = own & ((1 << suffix_tree_lm.BITS) - 1)
            kept = root[last] * np.exp(gain[keys >> suffix_tree_lm.BITS == c])
            # what the suffix gives all symbols the state does not keep
            low = own & ((1 << suffix_tree_lm.BITS * (level + 1)) - 1)
            parent = root[last] * np.exp(suffix_tree_lm._backed(tree.states[:level], tree.nodes[:level], low))
            left = np.exp(rest[np.searchsorted(contexts, c)]) * (1 - parent.sum())
            assert kept.sum() + left == pytest.approx(1, abs=1e-9)


def test_scoring_without_training_texts(spark):
    docs = table(spark, [(1, "a b", None), (2, None, None)])
    tree = suffix_tree_lm.fit(docs.where("false"), text="text")
    got = suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert suffix_tree_lm.score(docs.where("false"), tree, text="text", keep=["doc_id"]).count() == 0


# ---------------------------------------------------------------- languages

def test_languages_and_spans(spark):
    rng = random.Random(5)
    speak = {"en": ["the", "and", "with", "house", "wind"], "de": ["der", "und", "schön", "haus", "über"], "el": ["και", "το", "σπίτι"]}
    rows = [(i, " ".join(rng.choice(speak[x]) for _ in range(rng.randint(3, 40))), x) for i in range(150) for x in [rng.choice([*speak])]]
    model = language_spans.fit(table(spark, rows + [(900, None, "en"), (901, "x", None)]), text="text", lang="lang")
    assert model.languages == ["de", "el", "en"]
    mixed = "the house and the wind with the house " + "und der schön haus über der und haus"
    odd = [(1000, None, None), (1001, "", None), (1002, "12 !! — …", None), (1003, mixed, None), (1004, "το σπίτι και το", None),
           (1005, "漢字", None), (1006, "ª", None)]
    got = {r["doc_id"]: r for r in language_spans.label_spans(table(spark, rows + odd), model, text="text").collect()}
    assert np.mean([got[d]["lang_pred"] == x for d, _, x in rows]) > 0.99
    assert all(0 <= r["lang_score"] <= 1 for r in got.values())
    assert [got[d]["lang_pred"] for d in (1000, 1001, 1002, 1004)] == ["und", "und", "und", "el"]
    assert got[1005]["lang_pred"] in model.languages and got[1006]["lang_pred"] in model.languages
    spans = [(s["lang"], s["first"], s["words"]) for s in got[1003]["lang_spans"]]
    assert spans == [("en", 0, 8), ("de", 8, 8)]
    none = language_spans.fit(table(spark, []), text="text", lang="lang")
    assert {r["lang_pred"] for r in language_spans.label_spans(table(spark, rows[:3]), none, text="text").collect()} == {"und"}


def test_paths_are_best():
    import itertools

    rng = np.random.default_rng(3)
    bounds = np.array([0, 4, 4, 9, 10])
    scores = rng.normal(size=(10, 3)).astype(np.float32) * 3
    got = language_spans.best_paths(scores, bounds, 2.0)
    for a, b in zip(bounds, bounds[1:]):
        worth = lambda p: sum(scores[a + i, x] for i, x in enumerate(p)) - 2 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
        if b > a:
            assert worth(got[a:b].tolist()) == pytest.approx(max(map(worth, itertools.product(range(3), repeat=b - a))), abs=1e-4)


# ---------------------------------------------------------------- quality

def test_grades(spark):
    rng = random.Random(9)
    word = lambda: f"g{rng.randrange(400)}"
    rows, grades = [], []
    for i in range(600):
        grade, text = rng.choice([0, 1, 2, 2, 2]), [word() for _ in range(rng.randint(10, 60))]
        if grade == 0:
            text[3:3] = rng.sample(["vile", "nasty", "awful"], 2)
        if grade == 1:
            text = [w + "***" for w in text]
        rows.append((i, " ".join(text), None))
        grades.append((i, grade))
    docs = table(spark, rows + [(700, None, None), (701, "", None), (702, " ", None)])
    graded = spark.createDataFrame(grades[:400] + [(None, 1), (5, None), (700, 2)], "doc_id long, grade int")
    model = ordinal_quality.fit(docs, graded, id="doc_id", text="text", grade="grade", steps=200, least_gain=16.0)
    assert model.grades == [0, 1, 2] and (np.diff(model.thresholds) > 0).all()
    out = ordinal_quality.grade_documents(docs, model, text="text", select=2)
    assert out.columns[:len(docs.columns)] == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert np.mean([got[i]["quality_kept"] == (g == 2) for i, g in grades[400:]]) > 0.97
    assert [(got[i]["quality_grade"], got[i]["quality_tail"], got[i]["quality_kept"]) for i in (700, 701, 702)] == [(0, 0, False)] * 3
    same = ordinal_quality.fit(docs, graded.where("grade = 2"), id="doc_id", text="text", grade="grade")
    assert ordinal_quality.grade_documents(docs, same, text="text", select=2).where("quality_kept").count() == 600
    none = ordinal_quality.fit(docs, graded.where("false"), id="doc_id", text="text", grade="grade")
    assert ordinal_quality.grade_documents(docs.where("false"), none, text="text", select=2).count() == 0
    labels = spark.createDataFrame([(1, 0), (0, 0), (0, 1), (1, 1), (None, None), (1, None), (None, 1)], "quality int, toxic int")
    assert [r["grade"] for r in ordinal_quality.three_grades(labels, quality="quality", toxic="toxic").collect()] == [2, 1, 0, 0, None, None, 0]


def test_gradient():
    """A fit on one feature recovers the log odds of a two-grade model."""
    n = 4000
    rng = np.random.default_rng(1)
    x = rng.random(n) < 0.5
    y = (rng.random(n) < np.where(x, 0.9, 0.4)).astype(int)
    bounds = np.concatenate([[0], np.cumsum(x)])
    w, cuts = ordinal_quality.fit_arrays(np.full(int(x.sum()), 3), bounds, y, 8, 2000, 0.05, 0.0)
    odds = lambda p: math.log(p / (1 - p))
    assert -cuts[0] == pytest.approx(odds(y[~x].mean()), abs=0.02)
    assert w[3] - cuts[0] == pytest.approx(odds(y[x].mean()), abs=0.02)


# ---------------------------------------------------------------- secrets

def test_secrets_are_found_and_numbers_left(spark):
    rng = random.Random(11)
    hexed = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    word = lambda: "".join(rng.choice(["an", "ti", "on", "re", "th", "es"]) for _ in range(rng.randint(1, 4)))
    rows, planted = [], {}
    for i in range(400):
        text = [word() for _ in range(30)]
        kind = rng.choice(["secret", "number", "path", "none"])
        if kind == "secret":
            planted[i] = hexed(rng.choice([32, 40]))
            text[12:12] = [rng.choice(["token", "api key", "password"]), "=", f'"{planted[i]}"']
        if kind == "number":
            text[7:7] = ["".join(rng.choice("0123456789") for _ in range(16))]
        if kind == "path":
            text[9:9] = [f"site/{word()}/{word()}-{rng.randrange(10**6)}/index{rng.randrange(10**5)}"]
        rows.append((i, " ".join(text), None))
    docs = table(spark, rows + [(900, None, None), (901, "", None), (902, "AKIA" + "ABCDEFGH23456789", None)])
    lexicon = secret_forest.learn_lexicon(docs, text="text")
    forest = secret_forest.fit(secret_forest.find(docs, lexicon, text="text"))
    assert forest.trees
    out = secret_forest.scan_secrets(docs, lexicon, forest, text="text")
    assert out.columns[:len(docs.columns)] == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    before = {d: t for d, t, _ in rows}
    for i, secret in planted.items():
        assert got[i]["text"] == before[i].replace(secret, "[secret]")
        s = got[i]["secret_spans"][0]
        assert before[i][s["first"]:s["first"] + s["length"]] == secret
    clean = [i for i in before if i not in planted]
    assert np.mean([got[i]["text"] == before[i] for i in clean]) > 0.99
    assert got[900]["text"] is None and got[901]["text"] == ""
    # without two kinds of labels nothing is removed
    keep = secret_forest.fit(secret_forest.find(docs.where("false"), lexicon, text="text"))
    assert keep.trees == [] and (keep.votes(np.zeros((2, 16))) == 1).all()
    assert secret_forest.scan_secrets(docs.where("false"), lexicon, keep, text="text").count() == 0


def test_forest_votes_match_the_library(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(4)
    x = rng.random((500, 4))
    y = ((x[:, 0] > 0.4) ^ (x[:, 2] > 0.7)).astype(float)
    rows = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "x array<double>, label double") \
        .select(array_to_vector("x").alias("features"), "label")
    model = RandomForestClassifier(numTrees=7, maxDepth=5, seed=1).fit(rows)
    forest = secret_forest.Forest([secret_forest._arrays(t.toDebugString) for t in model.trees])
    want = np.mean([[t.predict(v) for v in [r["features"] for r in rows.collect()]] for t in model.trees], axis=0)
    assert np.allclose(forest.votes(x), want)


# ---------------------------------------------------------------- files

@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**31 if n == 7 else 50_000, n).astype(np.uint32)
    planes = bitplanes.shuffle(ids, bits)
    assert (bitplanes.unshuffle(planes, n, bits) == ids).all()


@pytest.mark.parametrize("bits,block,plain_specials", [(8, 1 << 16, False), (1, 50, False), (8, 300, True)])
def test_token_files(spark, bits, block, plain_specials):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(bits)
    rows = [(i, t, None) for i, t in enumerate(ODD)]
    for i in range(60):
        rows.append((100 + i, "".join(rng.choice(["word", " ", "  ", "\n", "é", " ", " ", "1", "'s", "!", "\t", "Ω", "\x1d", "　"])
                                      for _ in range(rng.randint(0, 80))), None))
    rows += [(7, "again", None), (None, "no id", None), (300, "a b <|endoftext|> c", None), (301, "x  <|endoftext|><|endoftext|>  \n y<|endoftext|>", None)]
    rng.shuffle(rows)
    files = bitplanes.write_tokens(table(spark, rows), id="doc_id", text="text", tokenizer=path, end_id=2, bits=bits, block_ids=block,
                                   plain_specials=plain_specials)
    got = bitplanes.read_tokens(files, id="doc_id").orderBy("start").collect()
    plain = Tokenizer.from_file(path)
    if plain_specials:
        plain.encode_special_tokens = True
    assert (50256 in plain.encode("a b <|endoftext|> c", add_special_tokens=False).ids) != plain_specials
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())
    start = 0
    assert len(got) == len(rows)
    for (doc, text, _), r in zip(sorted(rows, key=key), got):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        assert (r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) == (doc, start, ids), text
        start += len(ids)
    empty = bitplanes.write_tokens(table(spark, []), id="doc_id", text="text", tokenizer=path, end_id=2)
    assert bitplanes.read_tokens(empty, id="doc_id").count() == 0


# ---------------------------------------------------------------- all contexts of a large corpus

@pytest.mark.parametrize("lookup", [0.02, 1e-6])
def test_contexts_are_kept_whatever_the_share(spark, lookup):
    """Contexts of one to three words, far under any share of the tokens, score as the definition says."""
    rng = random.Random(21)
    texts = [" ".join(f"w{int(rng.paretovariate(0.8))}" for _ in range(25)) for _ in range(60)]
    texts += [f"{rng.choice(['a', 'b'])} rare{i % 9} tail{i % 9} end{i % 9} last{i % 9}" for i in range(45)]
    texts += [f"{x}{m} n{i} {x}{i}" for m in ("", " m") for i in range(3) for x in ("p", "q") for _ in range(50)]
    seqs = lambda t: [*t.split(), None]
    count = Counter(tuple(s[i:i + k]) for s in map(seqs, texts) for k in range(1, 5) for i in range(len(s) - k + 1))
    tokens, types = sum(n for g, n in count.items() if len(g) == 1), sum(len(g) == 1 for g in count)
    root = lambda c: (count[(c,)] + 1) / (tokens + types + 1)
    states = {}

    def p(ctx, c):
        if not ctx:
            return root(c)
        if ctx not in states:
            return p(ctx[1:], c)
        own, share = states[ctx]
        return own[c] if c in own else share * p(ctx[1:], c)

    for k in range(1, 4):
        kinds = {}
        for g, n in count.items():
            if len(g) == k + 1 and n >= 2:
                kinds.setdefault(g[:-1], {})[g[-1]] = n / (count[g[:-1]] + 1)
        new = {}
        for ctx, own in kinds.items():
            low = {c: p(ctx[1:], c) for c in own}
            rest, under = max(1 - sum(own.values()), 1e-12), max(1 - sum(low.values()), 1e-12)
            diverge = sum(x * math.log(x / low[c]) for c, x in own.items()) + rest * math.log(rest / under)
            if count[ctx] * diverge >= 10 * (len(own) + 1):
                new[ctx] = own, rest / under
        states |= new
    assert {len(c) for c in states} == {1, 2, 3}
    asked = texts + ["p m n1 q1 w1", "w1 w2 rare3 tail3 never", "q m n2 p", "p n1 q1"]
    want = [sum(math.log10(p(tuple(s[max(0, i - 3):i]), c)) for i, c in enumerate(s)) for s in map(seqs, asked)]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    tree = suffix_tree_lm.fit(docs.where(f"doc_id < {len(texts)}"), text="text", node_share=0.02, lookup_share=lookup)
    got = suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id"]).orderBy("doc_id").collect()
    assert [r["score"] for r in got] == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("part", [40, 1000])
def test_score_in_many_parts(spark, monkeypatch, part):
    """Sequences dealt over many parts, with contexts and suffixes in more than one, give the tree of a single part."""
    rows = [(i, " ".join(t.split()[:40] + ["the", f"w{i % 9}", "the", "cat"]), None) for i, (_, t, _) in enumerate(corpus(7)) if t]
    docs = table(spark, rows)

    def scores():
        tree = suffix_tree_lm.fit(docs, text="text", node_share=0.02, lookup_share=0.01, gain=1.0)
        assert tree.deltas.count() and len(tree.hot)
        return {r["doc_id"]: r["score"] for r in suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id"]).collect()}

    want = scores()
    monkeypatch.setattr(suffix_tree_lm, "PART", part)
    assert suffix_tree_lm._parts(docs, 5000) == -(-5000 // part)
    assert scores() == pytest.approx(want, abs=1e-9)


# ---------------------------------------------------------------- forms of assignments

def test_secrets_in_assignments_of_many_forms(spark):
    """Secrets in .env, YAML, URL and JSON forms, trained only on quoted hex strings and numbers."""
    rng = random.Random(12)
    hexed = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    train = [(i, f'the wind and token = "{hexed(40)}" house' if i % 2 else f"number {rng.randrange(10**16, 10**17)} of the house", None)
             for i in range(200)]
    forms = [
        ("GITHUB_TOKEN={}", "ghp_" + "aB3" * 12), ("key={}", "AKIA" + "ABCDEFGH23456789"), ("see x/{}/y", "ghp_" + "Zx9" * 12),
        ("AWS_SECRET_ACCESS_KEY={}", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"), ("DB_PASSWORD={}\nA=1", "p@ss!w$rd,(x"),
        ("export SECRET={}", "hunter"), ("db:\n  password: {}\n  port: 5432", "hunter2!"), ('{{"user": "me", "password": "{}"}}', "Tr0ub&dor"),
        ("https://h.org/p?user=a&api_key={}&n=2", "0a1b2c3d"), ("postgres://me:{}@db/x", "s3cr!t"), ("passwd = '{}'", "lower"),
        ("Ünï password: {} é", "zq$é!k")]
    plain = ["max_tokens: 4096", "the secretary: Johnson came", "password: house", "password: null", "a == b and token == c",
             "password=${DB_PASSWORD}", "lookup_table_size=12345"]
    rows = train + [(1000 + i, f.format(v), None) for i, (f, v) in enumerate(forms)] + [(2000 + i, t, None) for i, t in enumerate(plain)]
    docs = table(spark, rows)
    lexicon = secret_forest.learn_lexicon(docs, text="text")
    forest = secret_forest.fit(secret_forest.find(table(spark, train), lexicon, text="text"))
    got = {r["doc_id"]: r for r in secret_forest.scan_secrets(docs, lexicon, forest, text="text").collect()}
    assert {f: got[1000 + i]["text"] for i, (f, _) in enumerate(forms)} == {f: f.format("[secret]") for f, _ in forms}
    assert [got[2000 + i]["text"] for i in range(len(plain))] == plain
    for i, (f, v) in enumerate(forms):
        s = got[1000 + i]["secret_spans"][0]
        assert f.format(v)[s["first"]:s["first"] + s["length"]] == v


# ---------------------------------------------------------------- grades of small and large tables

@pytest.mark.parametrize("n", [90, 900])
def test_toxic_and_poor_texts_go_at_any_size(spark, n):
    """Production parameters; a marker word of the toxic texts gets a weight in a small table as in a larger one."""
    rng = random.Random(31)
    rows, grades = [], []
    for i in range(2 * n):
        grade, text = rng.choice([0, 1, *[2] * 7]), [f"g{rng.randrange(100)}" for _ in range(rng.randint(10, 40))]
        if grade == 0:
            text[3:3] = ["vile", "nasty"]
        if grade == 1:
            text += ["click", "here"]
        rows.append((i, " ".join(text), None))
        grades.append((i, grade))
    docs, graded = table(spark, rows), spark.createDataFrame(grades[:n], "doc_id long, grade int")
    model = ordinal_quality.fit(docs, graded, id="doc_id", text="text", grade="grade")
    kept = {r["doc_id"]: r["quality_kept"] for r in ordinal_quality.grade_documents(docs, model, text="text", select=2).collect()}
    for grade in (0, 1, 2):
        assert np.mean([kept[i] == (g == 2) for i, g in grades[n:] if g == grade]) > 0.9, grade


def test_labelled_toxic_and_poor_documents_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    graded = ordinal_quality.three_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"), quality="quality", toxic="toxic")
    model = ordinal_quality.fit(docs, graded, id="doc_id", text="text", grade="grade")
    out = ordinal_quality.grade_documents(docs, model, text="text", select=2).join(graded.where("grade IS NOT NULL"), "doc_id")
    for r in out.groupBy("grade").agg(F.avg(F.col("quality_kept").cast("int")).alias("kept")).collect():
        assert r["kept"] > 0.9 if r["grade"] == 2 else r["kept"] < 0.1
