"""Bindings for searches, predicates and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import filters as op
from tallyloom.plans.registry import RUNS_SQL, query, runs, table

CATALOG_SQL = """
    catalog AS (
      SELECT p_partkey AS id, p_name AS name, p_type AS category, p_brand AS framework,
             p_size AS size, p_retailprice AS score, p_partkey % 97 AS owner_id,
             p_size % 2 = 0 AS is_public
      FROM part)
"""


def catalog(spark, sf):
    p = table(spark, sf, "part")
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("framework"), F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("score"), (F.col("p_partkey") % 97).alias("owner_id"),
        (F.col("p_size") % 2 == 0).alias("is_public"))


@query("F01_catalog_search", f"""
    WITH {CATALOG_SQL}
    SELECT id, name, category FROM catalog
    WHERE (owner_id = 5 OR is_public)
      AND (name ILIKE '%RING%' OR category ILIKE '%RING%' OR framework ILIKE '%RING%')
""")
def catalog_search(spark, sf):
    return (op.catalog_search(catalog(spark, sf), owner="owner_id", owner_id=5, public="is_public",
                              include_public=True, search="RING",
                              search_in=["name", "category", "framework"])
            .select("id", "name", "category").orderBy(F.col("id").desc()))


@query("F02_registry_search", f"""
    WITH {CATALOG_SQL}
    SELECT id, name, score FROM catalog
    WHERE category = 'PROMO' AND framework = 'Brand#7' AND is_public
""")
def registry_search(spark, sf):
    found = op.catalog_search(catalog(spark, sf), equals={
        "category": "PROMO", "framework": "Brand#7", "status": None, "is_public": True})
    order = op.checked_sort("score", ["score", "name"], "id", "asc", key="id")
    return found.select("id", "name", "score").orderBy(*order)


@query("F03_job_search", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' AND o_orderpriority ILIKE '%urg%'
""")
def job_search(spark, sf):
    return op.catalog_search(
        table(spark, sf, "orders"),
        equals={"o_orderstatus": "O", "o_orderpriority": "1-URGENT", "o_custkey": None},
        search="urg", search_in=["o_orderpriority"]).select("o_orderkey", "o_orderdate")


@query("F04_directory_search", """
    SELECT c_custkey, c_name FROM customer
    WHERE c_mktsegment = 'BUILDING' AND (c_name ILIKE '%00012%' OR c_mktsegment ILIKE '%00012%')
""")
def directory_search(spark, sf):
    return op.catalog_search(table(spark, sf, "customer"), equals={"c_mktsegment": "BUILDING"},
                             search="00012", search_in=["c_name", "c_mktsegment"]) \
        .select("c_custkey", "c_name")


@query("F05_top_level_threads", """
    SELECT conv_id, text FROM conversations WHERE turn = 0 AND role <> 'system'
""")
def top_level_threads(spark, sf):
    conv = table(spark, sf, "conversations")
    parent = F.when(F.col("turn") > 0, F.col("turn") - 1)
    return (conv.withColumn("parent", parent).filter(F.col("parent").isNull() & (F.col("role") != "system"))
            .select("conv_id", "text"))


@query("F06_visible_replies", """
    SELECT conv_id, turn, text FROM conversations WHERE turn > 0 AND role <> 'system'
""")
def visible_replies(spark, sf):
    return (table(spark, sf, "conversations").filter((F.col("turn") > 0) & (F.col("role") != "system"))
            .select("conv_id", "turn", "text").orderBy("conv_id", "turn"))


@query("F07_row_access", """
    SELECT o_orderkey, c_custkey AS user_id,
           (o_orderkey % 3 = 0 OR o_custkey = c_custkey + o_orderkey % 2 OR c_mktsegment = 'MACHINERY') AS viewable,
           (o_custkey = c_custkey + o_orderkey % 2 OR c_mktsegment = 'MACHINERY') AS editable
    FROM orders JOIN customer ON c_custkey = o_custkey
""")
def row_access(spark, sf):
    joined = (table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
              .withColumn("is_public", F.col("o_orderkey") % 3 == 0)
              .withColumn("owner_id", F.col("o_custkey") - F.col("o_orderkey") % 2))
    view, edit = op.row_access("owner_id", "is_public", "c_custkey", "c_mktsegment", "MACHINERY")
    return joined.select("o_orderkey", F.col("c_custkey").alias("user_id"),
                         view.alias("viewable"), edit.alias("editable"))


@query("F08_status_in_and_present", f"""
    WITH {RUNS_SQL}
    SELECT run_id, f1 FROM runs WHERE status IN ('trained', 'deployed') AND f1 IS NOT NULL
""")
def status_in_and_present(spark, sf):
    return runs(spark, sf).filter(op.status_in_and_present("status", ["trained", "deployed"], "f1")) \
        .select("run_id", "f1")


@query("F09_since", """
    SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
""")
def since(spark, sf):
    mark = F.to_timestamp_ntz(F.lit("2024-01-15 00:00:00"))
    return table(spark, sf, "events").filter(F.col("ts") >= mark).select("event_id", "ts")


@query("F10_stale_rows", """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '2000-06-01' - INTERVAL 24 HOURS)
""")
def stale_rows(spark, sf):
    return table(spark, sf, "orders").filter(
        op.stale("o_orderstatus", "o_orderdate", "2000-06-01 00:00:00", ["F"], ["P"])) \
        .select("o_orderkey", "o_orderstatus")


@query("F11_low_quality", f"""
    WITH {RUNS_SQL}
    SELECT run_id, task FROM runs WHERE status = 'trained' AND
      CASE task WHEN 'classification' THEN acc - 0.42 < 0.5 WHEN 'regression' THEN f1 - 0.9 < 0
                ELSE ind_acc - 0.4 < 0.3 END
""")
def low_quality(spark, sf):
    scored = runs(spark, sf).filter(F.col("status") == "trained") \
        .withColumn("a", F.col("acc") - 0.42).withColumn("r2", F.col("f1") - 0.9) \
        .withColumn("sil", F.col("ind_acc") - 0.4)
    return scored.filter(op.low_quality("task", "a", "r2", "sil")).select("run_id", "task")


@query("F12_threshold_flag", f"""
    WITH {RUNS_SQL}
    SELECT dataset_id, count(*) AS n, max(acc) AS top FROM runs WHERE acc >= 0.999 GROUP BY dataset_id
""")
def threshold_flag(spark, sf):
    return (runs(spark, sf).filter(F.col("acc") >= 0.999).groupBy("dataset_id")
            .agg(F.count(F.lit(1)).alias("n"), F.max("acc").alias("top")))


@query("F13_keys_subset", """
    SELECT event_id FROM events WHERE event_id % 5 <> 0 AND event_id % 5 <> 1
""")
def keys_subset(spark, sf):
    ev = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 5 == 0, '{"k": 1, "extra": 2}') \
        .when(F.col("event_id") % 5 == 1, "{}").otherwise(F.col("props"))
    return ev.withColumn("hp", text).filter(op.keys_subset("hp", ["k", "algorithm"])).select("event_id")


@query("F14_drop_invalid_target", """
    SELECT event_id, value FROM events WHERE event_id % 9 NOT IN (0, 1, 2, 3)
""")
def drop_invalid_target(spark, sf):
    m = F.col("event_id") % 9
    dirty = F.when(m == 0, F.lit(None)).when(m == 1, F.lit(float("nan"))) \
        .when(m == 2, F.lit(float("inf"))).when(m == 3, F.lit(float("-inf"))).otherwise(F.col("value"))
    return (table(spark, sf, "events").withColumn("value", dirty).filter(op.finite("value"))
            .select("event_id", "value"))


@query("F15_length_band", """
    SELECT doc_id, length(text) AS n FROM documents WHERE length(text) BETWEEN 5 AND 500
""")
def length_band(spark, sf):
    return table(spark, sf, "documents").filter(op.length_band("text")) \
        .select("doc_id", F.length("text").cast("long").alias("n"))


@query("F16_nonblank_pair", """
    SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text, CAST(quality AS VARCHAR) AS label
    FROM documents JOIN labels USING (doc_id) WHERE toxic = 0 AND regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''
""")
def nonblank_pair(spark, sf):
    pairs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "text",
        F.when(F.col("toxic") == 1, "  ").otherwise(F.concat(F.lit(" "), F.col("quality"), F.lit("\n"))).alias("label"))
    return op.nonblank_pair(pairs, "text", "label")


@query("F17_align_features", """
    SELECT l_tax, l_quantity, 0.0::DOUBLE AS l_rebate, l_discount FROM lineitem
""")
def align_features(spark, sf):
    return op.align_features(table(spark, sf, "lineitem"),
                             ["l_tax", "l_quantity", "l_rebate", "l_discount"], zero_fill=True)


@query("F18_column_filter_by_type", """
    SELECT c_custkey, c_nationkey, c_acctbal FROM customer
""")
def column_filter_by_type(spark, sf):
    df = table(spark, sf, "customer")
    return df.select(*op.columns_of(df, "numeric"))


@query("F19_page_slice", """
    SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total,
           (SELECT CAST(ceil(count(*) / 15.0) AS BIGINT) FROM orders) AS pages,
           3 < (SELECT ceil(count(*) / 15.0) FROM orders) AS has_next, TRUE AS has_prev
    FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15 OFFSET 30
""")
def page_slice(spark, sf):
    return op.page_slice(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                         [F.desc("o_totalprice"), "o_orderkey"], 3, 15)
