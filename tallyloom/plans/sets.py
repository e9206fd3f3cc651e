"""Bindings for set operations, deduplication and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import sets as op
from tallyloom.plans.filters import CATALOG_SQL, catalog
from tallyloom.plans.registry import query, table
from tallyloom.sources.readers import drop_all_null_columns, union_all


@query("U01_drop_duplicate_rows", """
    WITH d AS (SELECT DISTINCT l_returnflag, l_linestatus, l_discount, l_tax FROM lineitem)
    SELECT l_returnflag, l_linestatus, l_discount, l_tax, (SELECT count(*) FROM lineitem) AS before, (SELECT count(*) FROM d) AS after FROM d
""")
def drop_duplicate_rows(spark, sf):
    rows, counts = op.drop_duplicate_rows(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_discount", "l_tax"))
    return rows.withColumn("before", counts.select("before").scalar()).withColumn("after", counts.select("after").scalar())


@query("U02_dedup_by_hash", "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_by_hash(spark, sf):
    return op.dedup_by_hash(table(spark, sf, "documents"), "text", "doc_id").select("doc_id", "text")


@query("U03_merge_sources", """
    WITH d AS (SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text)
    SELECT d.doc_id, o.lang AS origin, length(d.text)::BIGINT AS n, (SELECT count(*) FROM documents x WHERE x.lang = o.lang) AS origin_rows
    FROM d JOIN documents o USING (doc_id) WHERE length(d.text) BETWEEN 5 AND 500
""")
def merge_sources(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    merged, counts = op.merge_sources({l: docs.filter(F.col("lang") == l) for l in ("en", "fr", "de", "es")},
                                      "doc_id", "text", "lang")
    return merged.join(counts.withColumnRenamed("n", "origin_rows"), "origin").select(
        "doc_id", "origin", F.length("text").cast("long").alias("n"), "origin_rows")


@query("U05_unseen_values", """
    SELECT DISTINCT o_custkey FROM orders WHERE o_orderkey % 5 <> 0 AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)
""")
def unseen_values(spark, sf):
    orders = table(spark, sf, "orders")
    return op.unseen_values(orders.filter(F.col("o_orderkey") % 5 == 0), orders.filter(F.col("o_orderkey") % 5 != 0), "o_custkey")


@query("U06_validate_test_set", """
    SELECT 'benchmark' AS test, FALSE AS valid, 'missing_columns:doc_id,lang,n_chars,source' AS issues, 'extra_columns:item_id;unseen_targets:'
       || (SELECT count(*) FROM (SELECT text FROM benchmark EXCEPT SELECT text FROM documents)) AS warnings
    UNION ALL SELECT 'labels', TRUE, '', 'nulls:' || (SELECT count(*) FROM labels WHERE doc_id % 10 = 1)
""")
def validate_test_set(spark, sf):
    labels = table(spark, sf, "labels")
    test = labels.withColumn("toxic", F.when(F.col("doc_id") % 10 != 1, F.col("toxic")))
    flat = lambda df, name: df.select(F.lit(name).alias("test"), "valid", F.concat_ws(";", "issues").alias("issues"),
                                      F.concat_ws(";", "warnings").alias("warnings"))
    return union_all([
        flat(op.validate_test_set(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "text"), "benchmark"),
        flat(op.validate_test_set(labels, test, "quality"), "labels")])


@query("U07_leakage_overlap", """
    SELECT 'exact' AS kind, sha256(text) AS digest, NULL::BIGINT AS item_id, NULL::BIGINT AS doc_id FROM documents
    GROUP BY text HAVING count(*) FILTER (md5(doc_id::VARCHAR) < '8') > 0 AND count(*) FILTER (md5(doc_id::VARCHAR) >= '8') > 0
    UNION ALL SELECT 'contained', NULL, item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)
""")
def leakage_overlap(spark, sf):
    docs = table(spark, sf, "documents")
    half = F.md5(F.col("doc_id").cast("string")) < "8"
    none = F.lit(None).cast("bigint")
    exact = op.leakage_exact(docs.filter(half), docs.filter(~half), "text")
    inside = op.leakage_contained(table(spark, sf, "benchmark"), "item_id", "text", docs, "doc_id", "text")
    return exact.select(F.lit("exact").alias("kind"), "digest", none.alias("item_id"), none.alias("doc_id")).unionByName(
        inside.select(F.lit("contained").alias("kind"), F.lit(None).cast("string").alias("digest"), "item_id", "doc_id"))


@query("U08_drop_all_null_columns", "SELECT p_partkey, p_name, CASE WHEN p_size = 1 THEN p_brand END AS rare FROM part")
def drop_null_columns(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.lit(None).cast("double").alias("empty"), "p_name",
                                           F.when(F.col("p_size") == 1, F.col("p_brand")).alias("rare"))
    return drop_all_null_columns(part)


@query("U09_upsert", """
    SELECT p_partkey AS source_id, p_type AS kind, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 6 <> 0 THEN 'v2' ELSE 'v1' END AS path,
      CASE WHEN p_partkey % 3 = 0 AND p_partkey % 6 <> 0 THEN p_size + 100 ELSE p_size END AS n_rows FROM part
    UNION ALL SELECT p_partkey + 1000000, p_type, 'v2', p_size + 100 FROM part WHERE p_partkey % 5 = 0
""")
def upsert(spark, sf):
    base = table(spark, sf, "part").select(F.col("p_partkey").alias("source_id"), F.col("p_type").alias("kind"),
                                           F.lit("v1").alias("path"), F.col("p_size").alias("n_rows"))
    hit = base.filter(F.col("source_id") % 3 == 0).withColumn(
        "path", F.when(F.col("source_id") % 6 == 0, "v1").otherwise("v2")).withColumn("n_rows", F.col("n_rows") + 100)
    fresh = base.filter(F.col("source_id") % 5 == 0).select(
        (F.col("source_id") + 1000000).alias("source_id"), "kind", F.lit("v2").alias("path"), (F.col("n_rows") + 100).alias("n_rows"))
    return op.upsert(base, hit.unionByName(fresh), ["source_id", "kind"], ["path", "n_rows"], "path")


@query("U10_apply_patch", """
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0 THEN 'PATCHED' ELSE o_orderpriority END AS o_orderpriority,
      CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '2024-05-01' END AS updated_at FROM orders
""")
def apply_patch(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    patch = orders.filter(F.col("o_orderkey") % 4 == 0).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 8 != 0, "PATCHED").alias("o_orderpriority"))
    return op.apply_patch(orders, patch, "o_orderkey", ["o_orderpriority"], F.to_timestamp_ntz(F.lit("2024-05-01 00:00:00")))


@query("U11_copy_if_absent", f"""
    WITH {CATALOG_SQL},
    r AS (SELECT p_partkey AS id, (p_partkey % 13) AS owner_id FROM part),
    c AS (SELECT c.id, c.name, r.owner_id FROM catalog c JOIN r USING (id) WHERE is_public
          AND NOT EXISTS (SELECT 1 FROM catalog e WHERE e.name = c.name AND e.owner_id = r.owner_id))
    SELECT id, name, owner_id, is_public FROM catalog UNION ALL SELECT min(id), name, owner_id, FALSE FROM c GROUP BY name, owner_id
""")
def copy_if_absent(spark, sf):
    cat = catalog(spark, sf).select("id", "name", "owner_id", "is_public")
    requests = cat.select("id", (F.col("id") % 13).alias("owner_id"))
    return cat.unionByName(op.copy_if_absent(cat, requests, "id", "name", "owner_id", "is_public"))
