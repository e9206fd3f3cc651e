"""Stages of the pipeline on documents with columns named like those the operators add."""

import os

from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    named = docs.withColumn("quality_kept", F.lit(False)).withColumn("Secret_spans", F.lit("s")).withColumn(
        "_bench_hits", F.col("doc_id"))
    for stage in (corpus_pipeline.quality, corpus_pipeline.decontaminate, corpus_pipeline.secrets):
        got = stage(spark, named, SF)
        assert got.columns == named.columns
        want = stage(spark, docs, SF)
        rows = got.select(*docs.columns).collect()
        assert sorted(map(str, rows)) == sorted(map(str, want.collect())) and rows
        assert got.where("NOT quality_kept AND Secret_spans = 's' AND _bench_hits = doc_id").count() == len(rows)
