"""Secrets: the forest's part in the outcome, long values, columns, and the operator against plain Python."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import secret_forest as sf
from tallyloom.llm import words as tw

PROSE = ["the password: at-least 8 signs", "token: user-id of the row", "api_token: see-the-docs", "api_key = your-key-here"]


def hexed(rng, k):
    return "".join(rng.choice("0123456789abcdef") for _ in range(k))


def corpus(rng, n=240):
    rows = []
    for i in range(n):
        kind = i % 4
        text = [f'the wind and token = "{hexed(rng, 40)}" house', f"number {rng.randrange(10**16, 10**17)} of the house",
                f"{rng.choice(['token', 'password'])}: {rng.choice(['see', 'ask'])}-{rng.choice(['the', 'our'])}-{rng.choice(['docs', 'page'])} here",
                f"built site/house/wind-{rng.randrange(10**6)}/index{rng.randrange(10**6)} of it"][kind]
        rows.append((i, text))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def fitted(spark, rows):
    docs = table(spark, rows)
    lexicon = sf.learn_lexicon(docs, text="text")
    return lexicon, sf.fit(sf.find(docs, lexicon, text="text"))


def texts(found):
    return {r["doc_id"]: r["text"] for r in found.collect()}


def test_prose_behind_a_name_stays(spark):
    lexicon, forest = fitted(spark, corpus(random.Random(1)))
    assert forest.trees
    docs = table(spark, list(enumerate(PROSE)) + [(9, f'token = "{hexed(random.Random(2), 40)}"')])
    got = texts(sf.scan_secrets(docs, lexicon, forest, text="text"))
    assert [got[i] for i in range(4)] == PROSE and got[9] == 'token = "[secret]"'


def test_votes_change_the_outcome(spark):
    """Findings labelled by hand: page keys are none. The forest then drops new ones, also behind a name and in quotes."""
    rng = random.Random(3)
    page = lambda: f"page-{rng.randrange(100)}-home-{rng.randrange(100)}"
    rows = [(i, f'api_key = "{page() if i % 2 else hexed(rng, 40)}" of the house') for i in range(300)]
    docs = table(spark, rows)
    lexicon = sf.learn_lexicon(docs, text="text")
    found = sf.find(docs, lexicon, text="text")
    assert found.where("label = 1").count() == 300  # the rule by itself takes all
    by_hand = found.withColumn("label", (~F.col("candidate").startswith("page-")).cast("int"))
    forest = sf.fit(by_hand)
    later = [(1000 + i, f'api_key = "{page() if i % 2 else hexed(rng, 40)}" of the house') for i in range(100)]
    got = texts(sf.scan_secrets(table(spark, later), lexicon, forest, text="text"))
    right = [("[secret]" in got[d]) == ("page-" not in t) for d, t in later]
    assert np.mean(right) > 0.98
    # and with the labels of the rule none is dropped
    got = texts(sf.scan_secrets(table(spark, later), lexicon, sf.fit(found), text="text"))
    assert all("[secret]" in t for t in got.values())


def test_unsettled_candidates_are_judged(spark):
    """Values that no rule labels: random hex is taken, and a number is not, both behind an unquoted name."""
    rng = random.Random(4)
    lexicon, forest = fitted(spark, corpus(rng))
    key, number = hexed(rng, 40), "12345678901234567"
    assert sf.sure_label(key.encode(), b"code=", False) is None and sf.sure_label(number.encode(), b"code=", False) is None
    got = texts(sf.scan_secrets(table(spark, [(1, f"code={key} end"), (2, f"code={number} end")]), lexicon, forest, text="text"))
    assert got == {1: "code=[secret] end", 2: f"code={number} end"}


@pytest.mark.parametrize("size", [320, 5_000, 2_000_000])
def test_long_values_go_whole(spark, size):
    rng = random.Random(size)
    lexicon, forest = fitted(spark, corpus(rng))
    value = "".join(rng.choices("abcdefghijkmnopqrstuvwxyz!$%+", k=size))
    got = texts(sf.scan_secrets(table(spark, [(1, f'a password = "{value}" b')]), lexicon, forest, text="text"))
    assert got[1] == 'a password = "[secret]" b'


def test_features_of_long_bodies_need_little_memory():
    import tracemalloc

    lexicon = sf.Lexicon(np.ones((27, 27)), np.sort(tw.hash_spans(
        np.frombuffer(b"wind", np.uint8), np.array([0]), np.array([4]))))
    body = (b"wind" + b"qzxj" * 3) * 320_000
    tracemalloc.start()
    begin = time.time()
    x = dict(zip(sf.FEATURES, sf.describe(body, b"token = ", b"", lexicon)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert x["length"] == len(body) and x["covered"] == 0.25
    assert peak < 40 * len(body) and time.time() - begin < 60


def test_features_follow_their_definitions():
    rng = random.Random(6)
    known = [b"wind", b"house", b"docs"]
    hashes = [tw.hash_spans(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in known]
    pairs = -np.log(np.random.default_rng(1).random((27, 27)))
    lexicon = sf.Lexicon(pairs, np.sort(np.array(hashes, np.uint64)))

    def plain(body, before, after):
        kind = lambda c: "d" if c.isdigit() else "l" if "a" <= c <= "z" else "u" if "A" <= c <= "Z" else "s"
        s = body.decode("latin-1")
        n, kinds = len(s), [kind(c) for c in s]
        number = lambda c: ord(c.lower()) - 96
        surprise = [pairs[number(a), number(b)] for a, b in zip(s, s[1:]) if kind(a) in "lu" and kind(b) in "lu"]
        cover = [False] * n
        for w in known:
            for m in re.finditer(f"(?={w.decode()})", s.lower()):
                if all(kind(c) in "lu" for c in s[m.start():m.start() + len(w)]):
                    cover[m.start():m.start() + len(w)] = [True] * len(w)
        share = [s.count(c) / n for c in set(s)]
        left, right = re.findall("[A-Za-z]+", before)[-3:], re.findall("[A-Za-z]+", after)[:1]
        is_known = lambda ws: float(any(w.lower().encode() in known for w in ws))
        return [n, sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1), np.mean(surprise) if surprise else 0,
                -sum(p * np.log2(p) for p in share), kinds.count("d") / n, sum(c in "0123456789abcdefABCDEF" for c in s) / n,
                kinds.count("u") / n, sum(cover) / n, s.count("/"), before[-1:] in tuple("/\\.@"),
                bool(re.match(r"[.@/\\][A-Za-z]", after)),
                any(x in " ".join([*left[:-1], *right]).lower() for x in sf.NAMES), is_known(left[-1:]), is_known(right)]

    for _ in range(300):
        body = "".join(rng.choice(["wind", "House", "docs", "/", "7", "q", "Z", "-", "+"]) for _ in range(rng.randint(1, 30))).encode()
        before, after = rng.choice(["", "the token = ", "secret house ", 'x"', "a/"]), rng.choice(["", " wind x", ".com", " key"])
        got = sf.describe(body, before.encode(), after.encode(), lexicon)
        assert np.allclose(got, np.array(plain(body, before, after), float))


def test_columns_in_other_case_and_named_like_results(spark):
    lexicon, forest = fitted(spark, corpus(random.Random(7)))
    docs = table(spark, [(1, "GITHUB_TOKEN=ghp_" + "aB3" * 12)]).withColumnRenamed("text", "TEXT").withColumn("_text", F.lit(5))
    row = sf.scan_secrets(docs, lexicon, forest, text="text").first()
    assert row["TEXT"] == "GITHUB_TOKEN=[secret]" and row["_text"] == 5
    with pytest.raises(ValueError, match="secret_spans"):
        sf.scan_secrets(docs.withColumn("Secret_Spans", F.lit(1)), lexicon, forest, text="text")
