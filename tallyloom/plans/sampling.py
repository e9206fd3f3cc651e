"""Bindings for splits, samples, balancing, synthesis and augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.operators import augment, features, sampling as op
from tallyloom.plans.registry import query, run_key, table
from tallyloom.session import cut_lineage

H = "md5(doc_id || '|42')"
QUOTA = """
    c AS (SELECT {label} AS g, count(*) AS n FROM {src} GROUP BY 1),
    s AS (SELECT g, n, ceil(sum(n) OVER () * {ratio})::DOUBLE AS want, ceil(sum(n) OVER () * {ratio})::DOUBLE * n / sum(n) OVER ()::DOUBLE AS share FROM c),
    q AS (SELECT g, floor(share) + (row_number() OVER (ORDER BY round(share - floor(share), 9) DESC, g) <= want - sum(floor(share)) OVER ())::INT AS quota FROM s)
"""


@query("P01_random_split", f"""
    SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {H}, doc_id) <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split FROM documents
""")
def random_split(spark, sf):
    return op.random_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.2)


@query("P02_stratified_split", f"""
    WITH {QUOTA.format(label="quality", src="labels", ratio=0.25)}
    SELECT doc_id, quality, CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY {H}, doc_id) <= quota THEN 'test' ELSE 'train' END AS split
    FROM labels JOIN q ON g = quality
""")
def stratified_split(spark, sf):
    return op.stratified_split(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.25)


@query("P03_three_way_split", f"""
    WITH {QUOTA.format(label="quality", src="labels", ratio=0.2)},
    a AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {H}, doc_id) <= quota AS t FROM labels JOIN q ON g = quality),
    r AS (SELECT doc_id, quality FROM a WHERE NOT t),
    {QUOTA.format(label="quality", src="r", ratio=0.1 / (1.0 - 0.2)).replace(" c AS", " c2 AS").replace("FROM c)", "FROM c2)").replace(" s AS", " s2 AS").replace("FROM s)", "FROM s2)").replace(" q AS", " q2 AS")},
    b AS (SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '|43'), doc_id) <= quota AS v FROM r JOIN q2 ON g = quality)
    SELECT doc_id, quality, CASE WHEN t THEN 'test' WHEN v THEN 'val' ELSE 'train' END AS split FROM a LEFT JOIN b USING (doc_id)
""")
def three_way_split(spark, sf):
    return op.three_way_split(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", 0.2, 0.1)


@query("P04_ratio_split_per_label", f"""
    SELECT doc_id, toxic, CASE WHEN row_number() OVER (PARTITION BY toxic ORDER BY {H}, doc_id) <= floor(count(*) OVER (PARTITION BY toxic) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM labels
""")
def ratio_split_per_label(spark, sf):
    return op.ratio_split_per_label(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "toxic")


@query("P05_stratified_kfold", f"""
    SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY {H}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels
""")
def stratified_kfold(spark, sf):
    return op.stratified_kfold(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", folds=5)


@query("P06_row_cap_sample", """
    WITH r AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER) AS run_id, l_quantity FROM lineitem)
    SELECT run_id, l_quantity FROM r ORDER BY md5(run_id || '|42'), run_id LIMIT 3000
""")
def row_cap_sample(spark, sf):
    li = table(spark, sf, "lineitem").select(
        run_key().alias("run_id"), "l_quantity")
    return op.row_cap_sample(li, "run_id", 3000)


@query("P07_downsample", f"""
    WITH m AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM labels GROUP BY quality))
    SELECT doc_id, quality FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {H}, doc_id) AS r FROM labels), m WHERE r <= m
""")
def downsample(spark, sf):
    return op.downsample(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query("P08_upsample", f"""
    WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {H}, doc_id) AS rk, count(*) OVER (PARTITION BY quality) AS n FROM labels),
    c AS (SELECT quality, max(n) AS n FROM r GROUP BY quality),
    d AS (SELECT quality, n, unnest(range(1, (SELECT max(n) FROM c) - n + 1)) AS draw FROM c),
    u AS (SELECT quality, draw, floor(('0x' || substr(md5(quality || '|' || draw || '|42'), 1, 12))::BIGINT / 281474976710656.0::DOUBLE * n)::BIGINT + 1 AS rk FROM d)
    SELECT doc_id, quality, 0::BIGINT AS copy FROM labels UNION ALL SELECT doc_id, quality, draw FROM u JOIN r USING (quality, rk)
""")
def upsample(spark, sf):
    return op.upsample(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality")


@query("P09_smote")
def smote(spark, sf):
    vecs = table(spark, sf, "embeddings").withColumn("label", (F.col("label") < 3).cast("int"))
    return op.smote(vecs, "vec_id", "embedding", "label", share=0.5)


@query("P09_smote_text")
def smote_text(spark, sf):
    """Labelled texts balanced on their TF-IDF rows."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id").select("doc_id", "text", "quality")
    counts = cut_lineage(features.term_counts(docs, "doc_id", tx.mixed_tokens(F.col("text"))), "counts")
    rows = cut_lineage(features.apply_tfidf(counts, "doc_id", features.fit_tfidf(counts, docs.count())), "rows")
    made = op.smote_sparse(docs.select("doc_id", "quality"), rows, "doc_id", "quality")
    return made.groupBy("quality", "draw", "base", "other", "step").agg(
        F.count("term").alias("n_terms"), F.round(F.sum("weight"), 9).alias("total"))


@query("P10_bootstrap")
def bootstrap(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return op.bootstrap(docs, "doc_id", docs.count())


@query("P11_synth_classification")
def synth_classification(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "run_id", run_key())
    per = max(1, li.count() // 3)
    return op.synth_classification(li, "run_id", "l_returnflag", ["l_quantity", "l_extendedprice", "l_discount"],
                                   ["l_linestatus"], per)


@query("P12_synth_regression")
def synth_regression(spark, sf):
    li = table(spark, sf, "lineitem")
    return op.synth_regression(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], li.count())


@query("P13_synth_mixture")
def synth_mixture(spark, sf):
    vecs = table(spark, sf, "embeddings")
    return op.synth_mixture(vecs, "embedding", vecs.count(), parts=8, max_iter=3).select("draw", "component", "label", "embedding")


SYNONYMS = {"tion": ["sion", "ment"], "the": ["that", "this"], "ing": ["ed"], "und": ["oder"]}


@query("P14_augment_text", """
    SELECT doc_id, quality, v AS variant, CASE WHEN v = 0 THEN 'original' WHEN (doc_id + v - 1) % 2 = 0 THEN 'synonym' ELSE 'delete' END AS method
    FROM labels, unnest([0, 1, 2]) x(v)
""")
def augment_text(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "text", "quality")
    return augment.augment_text(docs, "doc_id", "text", ["quality"], SYNONYMS, factor=3).select("doc_id", "quality", "variant", "method")


@query("P15_synonym_replace")
def synonym_replace(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", F.lit(1).alias("variant"))
    return augment.synonym_column(docs, "doc_id", "text", "variant", SYNONYMS)


@query("P16_char_dropout")
def char_dropout(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "text", F.lit(1).alias("variant"),
        (augment.DROP_LOW + (augment.DROP_HIGH - augment.DROP_LOW) * op.uniform("doc_id")).alias("rate"))
    return augment.dropout_column(docs, "doc_id", "text", "variant", "rate")
