"""Passages with very many places: same results by partial sums, and no large group of one anchor."""

import random

import brute
import pytest
from pyspark.sql import functions as F
from test_exact_operators import passages, table

from tallyloom.llm import substring_dedup


@pytest.mark.parametrize("seed, hot_rows", [(1, 1), (2, 3), (3, 8)])
def test_hot_anchors_give_the_same_rows(spark, seed, hot_rows):
    rows = passages(seed)
    out = substring_dedup.remove_repeats(table(spark, rows), id="doc_id", text="text", window=20, block_bytes=4000,
                                         hot_rows=hot_rows)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["digest"])
           for r in out.withColumn("digest", F.sha2("kept_text", 256)).collect()}
    assert got == brute.without_repeats([(d, t) for d, t, _ in rows])


def test_hot_anchors_with_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(1, text, ""), (1, text, ""), (2, text, ""), (None, text, ""), (None, text, "")]
    out = substring_dedup.remove_repeats(table(spark, rows), id="doc_id", text="text", hot_rows=1).collect()
    assert sorted(((r["doc_id"] or -1), r["n_removed"]) for r in out) == [(-1, 0), (-1, 0), (1, 0), (1, 0), (2, 50)]


@pytest.mark.parametrize("n", [600, 2400])
def test_groups_of_one_anchor_do_not_grow(spark, n):
    """A line in a third of the documents, each time in a block of its own."""
    rng = random.Random(n)
    line = " ".join(f"l{i}" for i in range(30))
    say = lambda: " ".join(f"w{rng.randrange(9999)}" for _ in range(40))
    docs = table(spark, [(i, f"{say()} {line if i % 3 == 0 else ''} {say()}", "") for i in range(n)]).select("doc_id", "text")
    hot = substring_dedup.hot_anchors(docs, 50, 20, 8)
    assert len(hot)
    cold = substring_dedup.scan_runs(docs, 1 << 30, 20, 8, hot)
    assert cold.groupBy("anchor").count().agg(F.max("count")).first()[0] < 50
    windows = substring_dedup.scan_runs(docs, 1 << 30, 20, 8, hot, windows=True)
    assert windows.groupBy("anchor", "code").count().agg(F.max("count")).first()[0] == n / 3
    # samples: one per window and block, the first place only where it recurs in its block
    assert substring_dedup.confirm_hot(windows).where("first <> 0").count() == 0
