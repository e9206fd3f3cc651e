"""Bindings for feature preparation, text features and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import text as tx
from tallyloom.functions import values as vl
from tallyloom.operators import cluster, features as op, profile, vector_index
from tallyloom.plans.registry import query, run_key, table
from tallyloom.session import cut_lineage
from tallyloom.sources.readers import union_all


@query("X01_impute_mean", """
    WITH e AS (SELECT event_id, CASE WHEN event_id % 5 NOT IN (0, 1) THEN value END AS value FROM events)
    SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM e)), 6) AS value FROM e
""")
def impute_mean(spark, sf):
    m = F.col("event_id") % 5
    ev = table(spark, sf, "events").select("event_id", F.when(m == 0, float("nan")).when(m != 1, F.col("value")).alias("value"))
    return op.impute_mean(ev, ["value"]).withColumn("value", F.round("value", 6))


@query("X02_impute_mode", """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS p FROM orders),
    m AS (SELECT p FROM o WHERE p IS NOT NULL GROUP BY p ORDER BY count(*) DESC, p LIMIT 1)
    SELECT o_orderkey, coalesce(p, (SELECT p FROM m)) AS priority FROM o
""")
def impute_mode(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"))
    return op.impute_mode(df, ["priority"])


@query("X03_impute_constant", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority ELSE 'missing' END AS priority FROM orders")
def impute_constant(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"))
    return op.impute_constant(df, ["priority"])


CODES_SQL = """
    c AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
          FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'))
"""


@query("X04_label_encode", f"""
    WITH {CODES_SQL} SELECT o_orderkey, coalesce(code, 0)::INTEGER AS code FROM orders LEFT JOIN c ON p = o_orderpriority
""")
def label_encode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    codes = op.label_codes(orders.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED"), "o_orderpriority")
    return op.label_encode(orders, "o_orderpriority", "code", codes).select("o_orderkey", "code")


@query("X05_label_decode", f"""
    WITH {CODES_SQL} SELECT o_orderkey, coalesce(p, (SELECT min(p) FROM c)) AS label FROM orders LEFT JOIN c ON p = o_orderpriority
""")
def label_decode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    codes = op.label_codes(orders.filter(F.col("o_orderpriority") != "4-NOT SPECIFIED"), "o_orderpriority")
    return op.label_decode(op.label_encode(orders, "o_orderpriority", "code", codes), "code", "label", codes).select("o_orderkey", "label")


SCALED = ["l_quantity", "l_extendedprice", "unit"]


@query("X06_standardise", """
    WITH l AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER) AS run_id, l_quantity, l_extendedprice FROM lineitem)
    SELECT run_id, round((l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER (), 8) AS l_quantity,
      round((l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER (), 8) AS l_extendedprice, 0.0::DOUBLE AS unit FROM l
""")
def standardise(spark, sf):
    df = table(spark, sf, "lineitem").select(run_key().alias("run_id"),
                                             "l_quantity", "l_extendedprice", F.lit(3.0).alias("unit"))
    out = op.standardise(df, SCALED, op.fit_scaler(df, SCALED))
    return out.select("run_id", *[F.round(c, 8).alias(c) for c in SCALED])


@query("X07_inverse_standardise", """
    SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER) AS run_id, round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 6) AS l_extendedprice FROM lineitem
""")
def inverse_standardise(spark, sf):
    df = table(spark, sf, "lineitem").select(run_key().alias("run_id"),
                                             "l_quantity", "l_extendedprice")
    cols = SCALED[:2]
    scaler = op.fit_scaler(df, cols)
    out = op.inverse_standardise(op.standardise(df, cols, scaler), cols, scaler)
    return out.select("run_id", *[F.round(c, 6).alias(c) for c in cols])


TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+')"


@query("X08_tokenise_mixed", f"""
    SELECT doc_id, token, count(*) AS n FROM (SELECT doc_id, unnest({TOKENS}) AS token FROM documents) GROUP BY ALL
""")
def tokenise_mixed(spark, sf):
    return op.term_counts(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", tx.mixed_tokens(F.col("text"))).toDF("doc_id", "token", "n")


@query("X09_char_ngram_tokens", """
    WITH c AS (SELECT string_split(lower(text), '') AS c FROM conversations),
    g AS (SELECT unnest(c) AS gram FROM c UNION ALL SELECT unnest(list_transform(range(1, len(c)), lambda i: c[i] || c[i+1])) FROM c
          UNION ALL SELECT unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i+1] || c[i+2])) FROM c)
    SELECT gram, count(*) AS n FROM g GROUP BY gram
""")
def char_ngram_tokens(spark, sf):
    grams = F.explode(tx.ngram_array(F.lower("text"), (1, 2, 3))).alias("gram")
    return table(spark, sf, "conversations").select(grams).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def tfidf_vocabulary(docs, counts):
    """Fitted on three quarters of the texts; `counts` holds the terms of these at least."""
    learned = F.md5(F.col("doc_id").cast("string")) < "c"
    return op.fit_tfidf(counts.filter(learned), docs.filter(learned).count())


VOCAB_SQL = f"""
    t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) GROUP BY ALL),
    n AS (SELECT count(*) AS n FROM documents WHERE md5(doc_id::VARCHAR) < 'c'),
    d AS (SELECT term, count(*) AS df, sum(tf) AS total FROM t WHERE md5(doc_id::VARCHAR) < 'c' GROUP BY term),
    v AS (SELECT term, df, total, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM d, n WHERE df >= 2 AND df <= n * 0.9::DOUBLE)
"""


@query("X10_tfidf", f"""
    WITH {VOCAB_SQL},
    w AS (SELECT doc_id, term, (1.0 + ln(tf)) * idf AS w FROM t JOIN v USING (term))
    SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 8) AS weight FROM w
""")
def tfidf(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # the texts are cut into terms once, for fitting and for weighing
    counts = cut_lineage(op.term_counts(docs, "doc_id", tx.mixed_tokens(F.col("text"))), "counts")
    out = op.apply_tfidf(counts, "doc_id", tfidf_vocabulary(docs, counts))
    return out.withColumn("weight", F.round("weight", 8))


@query("X12_nnz_check", f"""
    WITH {VOCAB_SQL},
    b AS (SELECT item_id, count(DISTINCT term) AS n FROM (SELECT item_id, unnest({TOKENS}) AS term FROM benchmark) JOIN v USING (term) GROUP BY item_id)
    SELECT item_id, coalesce(n, 0) AS nnz, CASE WHEN coalesce(n, 0) = 0 THEN 'unreliable' WHEN n < 3 THEN 'weak' ELSE 'ok' END AS reliability
    FROM benchmark LEFT JOIN b USING (item_id)
""")
def nnz_check(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    train = docs.filter(F.md5(F.col("doc_id").cast("string")) < "c")
    vocabulary = tfidf_vocabulary(docs, op.term_counts(train, "doc_id", tx.mixed_tokens(F.col("text"))))
    return op.nnz_check(table(spark, sf, "benchmark"), "item_id", tx.mixed_tokens(F.col("text")), vocabulary)


@query("X13_l2_normalise", """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN vec_id % 50 = 0 THEN 0 ELSE x::DOUBLE * (vec_id % 7 + 1) END) AS e FROM embeddings),
    n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v)
    SELECT vec_id, i, round(CASE WHEN n = 0 THEN x ELSE x / n END, 8) AS x FROM (SELECT vec_id, n, unnest(e) AS x, unnest(range(0, 64)) AS i FROM n)
""")
def l2_normalise(spark, sf):
    scale = F.when(F.col("vec_id") % 50 == 0, 0).otherwise(F.col("vec_id") % 7 + 1)
    v = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * scale).alias("e"))
    return (v.select("vec_id", F.posexplode(op.l2_normalise(F.col("e"))).alias("i", "x"))
            .select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 8).alias("x")))


@query("X14_pad_or_truncate", """
    SELECT vec_id, i, CASE WHEN i < 64 AND i < 60 + vec_id % 10 THEN round(coalesce(embedding[i + 1]::DOUBLE, 0), 8) ELSE 0 END AS x
    FROM embeddings, range(0, CASE WHEN vec_id % 2 = 0 THEN 66 ELSE 66 END) r(i)
""")
def pad_or_truncate(spark, sf):
    cut = F.slice("embedding", F.lit(1), (60 + F.col("vec_id") % 10).cast("int"))
    v = table(spark, sf, "embeddings").select("vec_id", cut.alias("e"))
    return (v.select("vec_id", F.posexplode(op.pad_or_truncate(F.col("e"), 66)).alias("i", "x"))
            .select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 8).alias("x")))


@query("X15_cosine_match_level", """
    WITH s AS (SELECT a.vec_id, greatest(-1, least(1, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]))) AS s
      FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id - a.vec_id % 3)
    SELECT vec_id, round(s, 6) AS similarity, round(1 - s, 6) AS distance,
      CASE WHEN s >= .99 THEN 'identical' WHEN s >= .9 THEN 'high' WHEN s >= .7 THEN 'medium' WHEN s >= .5 THEN 'low' ELSE 'none' END AS level FROM s
""")
def cosine_match_level(spark, sf):
    a = table(spark, sf, "embeddings").select("vec_id", "embedding")
    b = a.select(F.col("vec_id").alias("other"), F.col("embedding").alias("e2"))
    s = a.join(b, F.col("other") == F.col("vec_id") - F.col("vec_id") % 3).select("vec_id", op.cosine(F.col("embedding"), F.col("e2")).alias("s"))
    return s.select("vec_id", F.round("s", 6).alias("similarity"), F.round(1 - F.col("s"), 6).alias("distance"),
                    op.match_level(F.col("s")).alias("level"))


TARGETS = {"lineitem": ("l_shipdate", "l_shipdate"), "events": ("value", "props"), "documents": ("n_chars", "n_chars"),
           "labels": ("toxic", "toxic"), "benchmark": ("item_id", "item_id"), "part": ("p_retailprice", "p_retailprice")}


@query("X16_pick_target", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{a}' AS target, (SELECT count({a}) FROM {t}) AS present" for t, (a, _) in
    {**TARGETS, "events": ("value", "")}.items()))
def pick_target(spark, sf):
    parts = []
    for name in TARGETS:
        df = table(spark, sf, name)
        text = profile.text_columns(df)
        declared = "value" if name == "events" else None
        goal = profile.pick_target(df.columns, text, declared, ["target", "class", "price"])
        parts.append(df.agg(F.count(goal).alias("present")).select(F.lit(name).alias("table_name"), F.lit(goal).alias("target"), "present"))
    return union_all(parts)


@query("X17_pick_text_column", """
    SELECT 'documents' AS table_name, 'text' AS text_column, count(text) AS present FROM documents
    UNION ALL SELECT 'pages', CASE WHEN avg(length(html)) > avg(length(url)) THEN 'html' ELSE 'url' END, count(*) FROM pages
    UNION ALL SELECT 'customer', CASE WHEN avg(length(c_name)) > avg(length(c_mktsegment)) THEN 'c_name' ELSE 'c_mktsegment' END, count(*) FROM customer
""")
def pick_text_column(spark, sf):
    parts = []
    for name in ("documents", "pages", "customer"):
        df = table(spark, sf, name)
        col = profile.pick_text_column(df)
        parts.append(df.agg(F.count(col).alias("present")).select(F.lit(name).alias("table_name"), F.lit(col).alias("text_column"), "present"))
    return union_all(parts)


@query("X18_target_kind", """
    SELECT 'l_quantity' AS target, CASE WHEN count(*) FILTER (l_quantity <> floor(l_quantity)) > 0 THEN 'regression' ELSE 'classification' END AS kind FROM lineitem
    UNION ALL SELECT 'l_discount', CASE WHEN count(*) FILTER (l_discount <> floor(l_discount)) > 0 THEN 'regression' ELSE 'classification' END FROM lineitem
    UNION ALL SELECT 'l_returnflag', 'classification' FROM lineitem LIMIT 3
""")
def target_kind(spark, sf):
    li = table(spark, sf, "lineitem")
    return union_all([profile.target_kind(li, c).select(F.lit(c).alias("target"), "kind") for c in ("l_quantity", "l_discount", "l_returnflag")])


@query("X19_task_repair", """
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 AND p_size > 25 THEN 'regression' WHEN p_partkey % 2 = 1 AND p_size <= 25 THEN 'classification'
        WHEN p_partkey % 2 = 0 THEN 'classification' ELSE 'regression' END AS task,
      CASE WHEN p_partkey % 2 = 0 AND p_size > 25 THEN 'random_forest_regressor' WHEN p_partkey % 2 = 1 AND p_size <= 25 THEN 'knn'
        WHEN p_partkey % 2 = 0 THEN 'random_forest' ELSE 'knn_regressor' END AS algorithm,
      CASE WHEN p_size > 25 THEN 'r2' ELSE 'accuracy' END AS scorer FROM part
""")
def task_repair(spark, sf):
    even = F.col("p_partkey") % 2 == 0
    task, algo, scorer = profile.task_repair(
        F.when(even, "classification").otherwise("regression"), F.when(F.col("p_size") > 25, "regression").otherwise("classification"),
        F.when(even, "random_forest").otherwise("knn_regressor"))
    return table(spark, sf, "part").select("p_partkey", task.alias("task"), algo.alias("algorithm"), scorer.alias("scorer"))


@query("X20_inf_tokens", """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'inf' WHEN 1 THEN '-inf' ELSE k END AS label FROM (SELECT *, (event_id % 10)::VARCHAR AS k FROM events)
""")
def inf_tokens(spark, sf):
    m = F.col("event_id") % 6
    v = F.when(m == 0, float("inf")).when(m == 1, float("-inf")).otherwise((F.col("event_id") % 10).cast("double"))
    lab = vl.replace_inf(v)
    return table(spark, sf, "events").select("event_id", F.regexp_replace(lab, r"\.0$", "").alias("label"))


NEIGHBOURS_SQL = """
    v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
    n AS (SELECT a.vec_id, b.label, list_distance(a.e, b.e) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS r
          FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
"""


@query("M03_knn_predict", """
    WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, vec_id % 4 = 0 AS q FROM embeddings),
    n AS (SELECT a.vec_id, b.label, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS r FROM v a JOIN v b ON a.q AND NOT b.q),
    c AS (SELECT vec_id, label, count(*) AS s FROM n WHERE r <= 7 GROUP BY ALL)
    SELECT vec_id, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS r FROM c) WHERE r = 1
""")
def knn_predict(spark, sf):
    """Every row of the held-out quarter is predicted from the other three."""
    v = table(spark, sf, "embeddings")
    held = F.col("vec_id") % 4 == 0
    return cluster.knn_vote(v.filter(~held), v.filter(held), "vec_id", "embedding", "label")


@query("M03_knn_predict_regression", f"""
    WITH {NEIGHBOURS_SQL} SELECT vec_id, round(sum(label / d) / sum(1 / d), 9) AS prediction FROM n WHERE r <= 7 GROUP BY vec_id
""")
def knn_predict_regression(spark, sf):
    v = table(spark, sf, "embeddings")
    found = cluster.knn_vote(v, v.filter(F.col("vec_id") % 100 == 0), "vec_id", "embedding", "label", weights="distance",
                             regression=True, exclude_self=True)
    return found.select("vec_id", F.round("prediction", 9).alias("prediction"))


@query("M03_knn_indexed")
def knn_indexed(spark, sf):
    """Every row is indexed; half of the cells are read, which these unclustered vectors need for a recall above 0.9."""
    v = table(spark, sf, "embeddings")
    index = vector_index.build(v, "vec_id", "embedding")
    near = vector_index.search(index, v.filter(F.col("vec_id") % 100 == 0), "vec_id", "embedding", k=7,
                               probes=-(-index.cells // 2), exclude_self=True)
    return cluster.knn_vote(v, v, "vec_id", "embedding", "label", near=near)


@query("M06_cluster_density", """
    WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id = b.vec_id OR list_distance(a.e, b.e) <= 1.13),
    core AS (SELECT a AS id FROM p GROUP BY a HAVING count(*) >= 4),
    cp AS (SELECT a, b FROM p WHERE a IN (FROM core) AND b IN (FROM core)),
    reach AS (SELECT id AS a, id AS b FROM core UNION SELECT r.a, cp.b FROM reach r JOIN cp ON cp.a = r.b),
    comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY a),
    named AS (SELECT id, dense_rank() OVER (ORDER BY c) - 1 AS cluster FROM comp),
    border AS (SELECT p.a AS id, min(cluster) AS cluster FROM p JOIN named ON named.id = p.b WHERE p.a NOT IN (FROM core) GROUP BY p.a)
    SELECT vec_id, coalesce(n.cluster, b.cluster, -1) AS cluster FROM v LEFT JOIN named n ON n.id = vec_id LEFT JOIN border b ON b.id = vec_id
""")
def cluster_density(spark, sf):
    return cluster.dbscan(table(spark, sf, "embeddings"), "vec_id", "embedding", 1.13, 4)


@query("M17_score_linear", """
    SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER) AS run_id, round(-1.5 + 0.04 * l_quantity + 12.0 * l_discount - 8.0 * l_tax, 8) AS margin,
      round(1 / (1 + exp(-(-1.5 + 0.04 * l_quantity + 12.0 * l_discount - 8.0 * l_tax))), 8) AS probability FROM lineitem
""")
def score_linear(spark, sf):
    z, p = op.score_linear(["l_quantity", "l_discount", "l_tax"], [0.04, 12.0, -8.0], -1.5)
    return table(spark, sf, "lineitem").select(
        run_key().alias("run_id"),
        F.round(z, 8).alias("margin"), F.round(p, 8).alias("probability"))
