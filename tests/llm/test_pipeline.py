"""The stages of the corpus pipeline, each against plain Python on the rows it was given."""

import re

import brute
import corpus_pipeline


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "secrets", "pack"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        got = out.collect()
        text = {d: r["text"] for d, r in rows.items()}
        if name != "pack":
            assert out.columns == docs.columns
        if name == "quality":
            good = [d for d, r in labels.items() if d in rows and r["quality"] == 1 and r["toxic"] == 0]
            kept = {r["doc_id"] for r in got}
            assert kept <= set(rows) and len(kept & set(good)) > 0.9 * len(good)
            assert all(r == rows[r["doc_id"]] for r in got)
        if name == "near_duplicates":
            want = brute.near_classes(list(text.items()), 5)
            assert {r["doc_id"] for r in got} == {d for d, low in want.items() if d == low}
        if name == "decontaminate":
            want = brute.contamination(list(text.items()), items)
            assert {r["doc_id"] for r in got} == {d for d, (_, hit, _) in want.items() if not hit}
        if name == "secrets":
            assert {r["doc_id"] for r in got} == set(rows)
            for r in got:
                assert r["text"] == re.sub(r'(token = ")[0-9a-f]{40}(")', r"\1[secret]\2", text[r["doc_id"]])
                assert r["n_chars"] == (rows[r["doc_id"]]["n_chars"] if r["text"] == text[r["doc_id"]] else len(r["text"]))
        if name == "pack":
            assert sorted(r["doc_id"] for r in got) == sorted(rows)
            assert all(r["n_words"] == len(brute.words(text[r["doc_id"]])) for r in got)
        else:
            docs = spark.createDataFrame(got, docs.schema)
            rows = {r["doc_id"]: r for r in got}


def test_run_packs_what_the_stages_keep(spark, sf_dir):
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.columns == ["doc_id", "n_words", "bucket", "bucket_length", "batch", "slot", "padding"]
    assert 0 < packed.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
