"""Columns in another case, or named like those the operators add."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language_spans, ordinal_quality, prefix_join, suffix_tree_lm
from tallyloom.llm import words as tw

GRADER = ordinal_quality.Model(np.zeros(8), np.array([0.0]), [0, 1])


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(1, "one two three"), (2, "four five"), (3, None)], "doc_id long, TEXT string")


def test_names_are_found_in_any_case(spark, docs):
    assert tw.place_of(docs, "text") == 1 and tw.place_of(docs, "doc_id") == 0
    with pytest.raises(Exception):
        tw.place_of(docs, "texts")
    bench = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    clean = prefix_join.clean_documents(docs, bench, text="text", item="item_id", item_text="text")
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3]
    assert ordinal_quality.grade_documents(docs, GRADER, text="text", select=1).count() == 3
    tree = suffix_tree_lm.fit(docs, text="text")
    assert suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id"]).count() == 3


def test_columns_named_like_results(spark, docs):
    bench = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    named = docs.withColumn("_bench_words", F.col("doc_id") * 10).withColumn("_BENCH_hits", F.lit("x"))
    clean = prefix_join.clean_documents(named, bench, text="text", item="item_id", item_text="text")
    assert clean.columns == named.columns
    assert sorted((r["doc_id"], r["_bench_words"], r["_BENCH_hits"]) for r in clean.collect()) == [(2, 20, "x"), (3, 30, "x")]
    with pytest.raises(ValueError, match="_bench_hits"):
        prefix_join.mark(named, bench, text="text", item="item_id", item_text="text")
    with pytest.raises(ValueError, match="quality_kept"):
        ordinal_quality.grade_documents(docs.withColumn("Quality_Kept", F.lit(1)), GRADER, text="text", select=1)
    learnt = docs.withColumn("lang", F.lit("en"))
    model = language_spans.fit(learnt, text="text", lang="lang")
    assert language_spans.label_spans(learnt, model, text="text").where("lang_pred = 'en'").count() == 2
    with pytest.raises(ValueError, match="lang_pred"):
        language_spans.label_spans(docs.withColumn("lang_pred", F.lit(1)), model, text="text")
    tree = suffix_tree_lm.fit(docs, text="text")
    with pytest.raises(ValueError, match="_row"):
        suffix_tree_lm.score(docs.withColumn("_row", F.lit(1)), tree, text="text", keep=["doc_id", "_row"])
