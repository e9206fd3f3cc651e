"""A corpus run from raw documents to packed batches.

Each stage reads what the one before it kept and returns the columns of `documents`; the last
returns the packing. `run` writes every stage as Parquet to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import length_buckets, lsh_forest, ordinal_quality, prefix_join, secret_forest, words
from tallyloom.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the graded labels lead to expect to be good; toxic and poor ones go."""
    graded = ordinal_quality.three_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"), quality="quality", toxic="toxic")
    model = ordinal_quality.fit(docs, graded, id="doc_id", text="text", grade="grade")
    name = words.unused(docs, "quality")
    return ordinal_quality.grade_documents(docs, model, text="text", select=2, name=name).where(f"{name}_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the least id."""
    return lsh_forest.keep_first(docs, id="doc_id", text="text", shingle=5, similarity=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return prefix_join.clean_documents(docs, benchmark, text="text", item="item_id", item_text="text", window=10)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; n_chars follows the text."""
    lexicon = secret_forest.learn_lexicon(docs, text="text")
    forest = secret_forest.fit(secret_forest.find(docs, lexicon, text="text"))
    name = words.unused(docs, "secret")
    found = secret_forest.scan_secrets(docs, lexicon, forest, text="text", name=name)
    return found.withColumn("n_chars", F.when(F.size(f"{name}_spans") > 0, F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches of documents of like length."""
    return length_buckets.pack(docs, id="doc_id", text="text", tokens_per_batch=1 << 16, buckets=16)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("pack", pack),
]

# Fitting a classifier and a forest has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
