"""Text, value and profile rules on small frames, CJK included."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import patterns
from tallyloom.functions import text as tx
from tallyloom.functions import values as vl
from tallyloom.operators import features, filters, governance, profile, sets, stats
from tallyloom.sources import readers, writers


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


def test_mixed_tokens_split_cjk_characters(spark):
    assert one(spark, "Spark 很好用 v2", tx.mixed_tokens) == ["spark", "v2", "很", "好", "用"]


def test_ngrams(spark):
    assert one(spark, "垃圾一", lambda c: tx.ngram_array(c, (1, 2, 3))) == ["垃", "圾", "一", "垃圾", "圾一", "垃圾一"]
    assert one(spark, "a", lambda c: tx.char_ngrams(c, 2)) == []


def test_sentiment_and_negation(spark):
    lexicon = spark.createDataFrame([("好", 1), ("开心", 1), ("差", -1)], "word string, weight int")
    rows = [(1, "很好"), (2, "不好"), (3, "好差"), (4, "天气"), (5, ""), (6, "不开心了"), (7, "差")]
    got = {r.id: (r.label, r.confidence) for r in tx.lexicon_sentiment(
        spark.createDataFrame(rows, "id long, t string"), "id", "t", lexicon, "word", "weight", ["不"]).collect()}
    assert got == {1: ("positive", 1.0), 2: ("negative", 1.0), 3: ("neutral", 0.5), 4: ("neutral", 0.0),
                   5: ("neutral", 0.0), 6: ("negative", 1.0), 7: ("negative", 1.0)}


def test_lexicons_of_any_size(spark, monkeypatch, sf_dir):
    """Words sent to the tasks, and words joined with the texts' windows, give the same hits as plain Python."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(-1, "😀no tion😀un able 😀😀tion"), (-2, "tion"), (-3, "untion tiontion"), (-4, None), (-5, "")], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(odd).cache()
    lexicon = spark.createDataFrame([("tion", 1), ("able", 1), ("ing", -1), ("e", -1), ("ti", 2)], "word string, weight int")
    run = lambda: (sorted(tx.lexicon_sentiment(docs, "doc_id", "text", lexicon, "word", "weight", ["un", "no"]).collect()),
                   sorted(tx.lexicon_hits(docs, "doc_id", "text", lexicon, "word", "weight", (1, 3, 4)).collect()))
    whole = run()
    monkeypatch.setattr(patterns, "LOOKUP_WORDS", 3)
    assert whole == run()
    weights = {"tion": 1, "able": 1, "ing": -1, "e": -1}
    want = []
    for r in docs.collect():
        for w, x in weights.items():
            n = sum((r["text"] or "").startswith(w, i) for i in range(len(r["text"] or "")))
            want += [(r["doc_id"], w, n, n * x)] if n else []
    assert [tuple(r) for r in whole[1]] == sorted(want)


@pytest.mark.parametrize("group", [1 << 20, 7])
def test_window_counts(spark, monkeypatch, group):
    rng = random.Random(group)
    texts = ["".join(rng.choice("ab\n😀é中") for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, "", "a", "ab"]
    monkeypatch.setattr(patterns, "GROUP_CHARS", group)
    want = {}
    for t in texts:
        for w in (1, 2, 3, 4, 6):
            for i in range(len(t or "") - w + 1):
                want[t[i:i + w]] = want.get(t[i:i + w], 0) + 1
    df = spark.createDataFrame([(t,) for t in texts], "said string")
    assert {r["gram"]: r["n"] for r in patterns.window_counts(df, "said", (1, 2, 3, 4, 6)).collect()} == want
    # the expression finds the same windows
    grams = df.select(F.explode(tx.ngram_array(F.col("said"), (2, 3, 4))).alias("g")).groupBy("g").count().collect()
    assert {r["g"]: r["count"] for r in grams} == {g: n for g, n in want.items() if len(g) in (2, 3, 4)}


@pytest.mark.parametrize("lot", [2_000_000, 50])
def test_contained_passages(spark, monkeypatch, lot):
    rng = random.Random(lot)
    say = lambda n: "".join(rng.choice("abcde é😀\n") for _ in range(n))
    texts = {i: say(rng.randint(0, 400)) for i in range(60)} | {60: None, 61: "", 62: "abc", 63: "a" * 3000}
    passages = {i: (texts[i % 60] or "x")[5:5 + rng.choice([1, 3, 30, 120])] for i in range(50)}
    passages |= {50: "never in there, not at all, no", 51: "", 52: None, 53: "a" * 40, 54: "abc"}
    monkeypatch.setattr(patterns, "LOOKUP_WINDOWS", lot)
    got = sets.leakage_contained(spark.createDataFrame(list(passages.items()), "p long, said string"), "p", "said",
                                 spark.createDataFrame(list(texts.items()), "d long, body string"), "d", "body")
    want = {(p, d) for p, x in passages.items() for d, t in texts.items() if x and t and x in t}
    rows = [tuple(r) for r in got.select("p", "d").collect()]
    assert set(rows) == want and len(rows) == len(want)


@pytest.mark.parametrize("size,want", [(0, "0 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1152, "1.12 KB"), (5 * 1024 ** 3, "5.00 GB"), (3 * 1024 ** 5, "3072.00 TB")])
def test_format_bytes(spark, size, want):
    assert one(spark, size, tx.format_bytes, "long") == want


@pytest.mark.parametrize("secs,want", [(5.9, "5秒"), (61.0, "1分1秒"), (3700.0, "1小时1分钟"), (None, None)])
def test_format_duration(spark, secs, want):
    assert one(spark, secs, tx.format_duration, "double") == want


@pytest.mark.parametrize("name,want", [("0123456789abcdef0123456789abcdef_my_model-v2.pkl", "my model v2"), ("x.pt", None), ("a_b.ONNX", "a b"), ("", None)])
def test_clean_filename(spark, name, want):
    assert one(spark, name, tx.clean_filename) == want


@pytest.mark.parametrize("url,want", [
    ("https://example.com/a", True), ("ftp://example.com", False), ("http://10.1.2.3/", False), ("http://8.8.8.8:80/x", True),
    ("http://172.32.0.1", True), ("http://172.16.0.1", False), ("http://[::1]/", False), ("http://[fe80::1]/", False),
    ("http://user@169.254.0.9/", False), ("https:///x", False), ("nonsense", False), (None, False)])
def test_url_admissible(spark, url, want):
    assert one(spark, url, tx.url_admissible) is want


def test_moderation(spark):
    patterns = ["buy now", "win.*prize"]
    assert one(spark, "hello", lambda c: tx.moderate(c, patterns)) is None
    assert one(spark, " \n", lambda c: tx.moderate(c, patterns)) == "empty_content"
    assert one(spark, "WIN a prize, BUY NOW", lambda c: tx.moderate(c, patterns)) == "auto_filtered:buy now"
    assert one(spark, "WIN " + "a" * 60, lambda c: tx.moderate(c, ["win " + "a" * 60])) == "auto_filtered:win " + "a" * 60
    assert one(spark, " <b>x</b> " + "y" * 3000, tx.strip_html) == "x " + "y" * 3000
    assert one(spark, " <b>x</b> " + "y" * 3000, lambda c: tx.strip_html(c, 2000)) == "x " + "y" * 1998


def test_moderation_reads_whole_messages(spark):
    from tallyloom.streaming import operators

    row = operators.moderated(spark.createDataFrame([("y " * 1250 + "buy now",)], "t string"), "t", ["buy now"]).first()
    assert row.reason == "auto_filtered:buy now" and not row.is_visible and len(row.content) > 2000


def test_wide_predictions_keep_every_class(spark):
    df = spark.createDataFrame([(1, "c9", [0.01] * 9 + [0.91])], "id long, p string, probs array<double>")
    row = writers.predictions_wide(df, ["id"], "p", "probs", [f"c{i}" for i in range(10)]).first()
    assert row.prob_c9 == 0.91 and row.confidence == 0.91


def test_correlation_leaves_missing_values_out(spark):
    nan = float("nan")
    rows = [(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.5, 5.0), (4.0, nan, 5.0), (None, 1.0, 5.0)]
    got = {(r.left, r.right): r.r for r in profile.correlations(spark.createDataFrame(rows, "a double, b double, c double")).collect()}
    assert got["a", "b"] == pytest.approx(0.97072534) and got["a", "c"] is None


def test_label_codes_of_a_common_prefix(spark):
    urls = spark.range(20000).select(F.concat(F.lit("https://example.org/"), F.sha1(F.col("id").cast("string"))).alias("u"))
    codes = features.label_codes(urls, "u").orderBy("code").collect()
    assert [r.code for r in codes] == list(range(20000)) and [r.label for r in codes] == sorted(r.label for r in codes)


@pytest.mark.parametrize("raw,kind,want", [("12", "int", 12), ("1.5", "int", None), ("1.5", "float", 1.5), ("x", "float", None), ("", "int", None),
                                           ("64, 32,", "ints", [64, 32]), ("64,x", "ints", None), ("007", "str", "007")])
def test_typed_param(spark, raw, kind, want):
    assert one(spark, raw, lambda c: vl.typed_param(c, kind)) == want


def test_round_even_follows_the_binary_value(spark):
    for v, d in [(71.85, 1), (2.675, 2), (0.0625, 3), (0.5, 0), (1.5, 0), (12345.675, 2), (-2.5, 0)]:
        assert one(spark, v, lambda c: vl.round_even(c, d), "double") == round(v, d)


NAMES = [("customer_churn", "tabular"), ("Movie-Reviews", "nlp"), ("stock prices", "finance")]


@pytest.mark.parametrize("name,want", NAMES)
def test_infer_category_by_name(spark, name, want):
    rules = [(["review", "tweet"], "nlp"), (["stock"], "finance")]
    assert one(spark, name, lambda c: profile.infer_category(c, rules, ["a"], "csv")) == want


@pytest.mark.parametrize("cols,ext,want", [([f"pixel_{i}" for i in range(12)], "csv", "vision"), (["a"], "png", "vision"), (["a"], "jsonl", "nlp"),
                                           (["a"], "parquet", "tabular"), (["a"], "bin", "other"), (["id", "review_text"], "bin", "nlp")])
def test_infer_category_fallbacks(spark, cols, ext, want):
    assert one(spark, "thing", lambda c: profile.infer_category(c, [(["review"], "nlp")], cols, ext)) == want


def test_missing_feature_is_an_error(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "col_a double, col_b double")
    with pytest.raises(ValueError, match="col_c"):
        filters.align_features(df, ["col_a", "col_b", "col_c"])


def test_impute_uses_training_rows_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "f double")
    test = spark.createDataFrame([(None,), (float("nan"),), (7.0,)], "f double")
    assert sorted(r.f for r in features.impute_mean(test, ["f"], train).collect()) == [2.0, 2.0, 7.0]


def test_tfidf_cap_and_bands(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b"), (3, "a d"), (4, "a")], "id long, t string")
    counts = features.term_counts(docs, "id", tx.mixed_tokens(F.col("t")))
    vocab = {r.term: r for r in features.fit_tfidf(counts, 4, 10).collect()}
    assert set(vocab) == {"b"}  # a is in every text, c and d in one
    assert vocab["b"].idf == pytest.approx(math.log(5 / 3) + 1)
    assert {r.term for r in features.fit_tfidf(counts, 4, min_df=1).collect()} == {"b", "c", "d"}


def test_single_class_is_infinitely_imbalanced(spark):
    df = spark.createDataFrame([("x", "a"), ("y", "a")], "t string, l string")
    row = stats.quality_report(df, "t", "l").first()
    assert row.imbalance_ratio == float("inf") and row.issues == ["class_imbalance", "too_many_short", "small_dataset"]


def test_upper_median(spark):
    df = spark.createDataFrame([("a" * n,) for n in (1, 2, 5, 9)], "t string")
    assert stats.length_stats(df, "t").first().median_length == 5


def test_tiers(spark):
    df = spark.createDataFrame([(1, 1.0, 0.9, 0.9, 0.9), (2, 0.97, 0.7, None, 0.9), (3, 0.92, 0.7, None, 0.9), (4, 0.92, 0.9, None, None),
                                (5, 0.93, None, None, 0.9), (6, 0.8, 0.79, 0.85, 0.8), (7, None, None, None, None)],
                               "id long, acc double, f1 double, train_acc double, ind_acc double")
    got = {r.id: r.tier for r in governance.with_tier(df).collect()}
    assert got == {1: "definite_delete", 2: "high_risk_delete", 3: "warning_only", 4: "warning_only", 5: "definite_delete",
                   6: "healthy", 7: "healthy"}


def test_encoding_ladder(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name,n\ncafé,1\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("name,n\ncafé,1\n".encode("utf-8"))
    assert readers.pick_encoding(spark, str(tmp_path / "a.csv")) == "ISO-8859-1"
    assert readers.pick_encoding(spark, str(tmp_path / "b.csv")) == "UTF-8"
    for f in "ab":
        assert readers.read_with_encoding(spark, str(tmp_path / f"{f}.csv"), "name string, n int").first().name == "café"


def test_reader_errors_and_gate(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        readers.read_any(spark, "x.npy")
    few = spark.range(10).withColumn("b", F.lit(1)).withColumn("Label_Col", F.lit(0))
    assert readers.ingest_gate(few, "label")["reason"] == "too_few_rows"
    assert readers.ingest_gate(few, "label", min_rows=5)["target"] == "Label_Col"
    assert readers.ingest_gate(few, "price", min_rows=5)["reason"] == "target_missing"


def test_bom_export(spark, tmp_path):
    writers.write_csv_bom(spark.createDataFrame([(1, "x")], "a int, b string").coalesce(1), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfa,b")


def test_contained_passages(spark):
    passages = spark.createDataFrame([(1, "needle in the haystack of words here"), (2, "tiny"), (3, "absent passage of some length")], "p long, t string")
    docs = spark.createDataFrame([(10, "xx needle in the haystack of words here yy"), (11, "needle in the haystack"), (12, "a tiny thing")], "d long, t string")
    got = {(r.p, r.d) for r in sets.leakage_contained(passages, "p", "t", docs, "d", "t").collect()}
    assert got == {(1, 10), (2, 12)}
