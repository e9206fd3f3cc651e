"""Bindings for aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.operators import features, profile, stats as op
from tallyloom.plans.filters import CATALOG_SQL, catalog
from tallyloom.plans.registry import EVENTS_SQL, RUNS_SQL, events, query, r9, runs, table
from tallyloom.sources.readers import column_stats, union_all


@query("A01_count_by", """
    SELECT 'category' AS dimension, p_type AS value, count(*) AS n FROM part GROUP BY p_type
    UNION ALL SELECT 'status', o_orderstatus, count(*) FROM orders GROUP BY 2
    UNION ALL SELECT 'framework', p_brand, count(*) FROM part WHERE p_size > 25 GROUP BY 2
""")
def count_by(spark, sf):
    part, orders = table(spark, sf, "part"), table(spark, sf, "orders")
    known = part.withColumn("framework", F.when(F.col("p_size") > 25, F.col("p_brand")))
    named = lambda df, d, c: df.select(F.lit(d).alias("dimension"), F.col(c).alias("value"), "n")
    return union_all([named(op.count_by(part, "p_type"), "category", "p_type"),
                      named(op.count_by(orders, "o_orderstatus"), "status", "o_orderstatus"),
                      named(op.count_by(known, "framework", skip_null=True), "framework", "framework")])


@query("A02_totals", f"""
    WITH {CATALOG_SQL}
    SELECT count(*) AS total_count, coalesce(sum(size::BIGINT * 1000000), 0)::BIGINT AS total_size,
       round(sum(size::BIGINT * 1000000) / 1073741824.0, 2) AS total_gb, sum(is_public::INT)::BIGINT AS public_count FROM catalog
""")
def totals(spark, sf):
    df = catalog(spark, sf).withColumn("bytes", F.col("size").cast("long") * 1000000)
    return op.totals(df, "bytes", "is_public")


@query("A03_registry_totals", f"""
    WITH {RUNS_SQL}
    SELECT count(*) AS total, count(*) FILTER (dataset_id % 2 = 0) AS public_count,
      count(*) FILTER (dataset_id % 2 <> 0) AS private_count, count(*) FILTER (status = 'trained') AS deployed,
      round(avg(acc), 9) AS avg_metric, max(acc) AS max_metric FROM runs
""")
def registry_totals(spark, sf):
    df = runs(spark, sf).withColumn("is_public", F.col("dataset_id") % 2 == 0)
    out = op.registry_totals(df, "is_public", F.col("status") == "trained", "acc")
    return out.withColumn("avg_metric", r9(F.col("avg_metric")))


@query("A04_job_totals", """
    SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o,
      count(*) FILTER (o_orderstatus = 'P') AS n_p, count(*) FILTER (o_orderstatus IN ('O', 'P')) AS active,
      round(avg(CASE WHEN o_custkey % 7 <> 0 THEN o_custkey * 60 END) FILTER (o_orderstatus = 'F'), 1) AS avg_seconds FROM orders
""")
def job_totals(spark, sf):
    minutes = F.col("o_custkey").cast("int")
    df = table(spark, sf, "orders").withColumn(
        "done", F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderdate") + F.make_dt_interval(mins=minutes)))
    return op.job_totals(df, "o_orderstatus", ["F", "O", "P"], ["O", "P"], "F", "o_orderdate", "done")


@query("A05_class_distribution", """
    SELECT quality, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM labels), 9) AS percent FROM labels GROUP BY quality
""")
def class_distribution(spark, sf):
    out = op.class_distribution(table(spark, sf, "labels"), "quality")
    return out.withColumn("percent", r9(F.col("percent")))


@query("A06_imbalance_ratio", """
    SELECT round(max(n)::DOUBLE / min(n), 9) AS imbalance_ratio FROM (SELECT count(*) AS n FROM labels GROUP BY quality)
""")
def imbalance_ratio(spark, sf):
    return op.imbalance_ratio(table(spark, sf, "labels"), "quality").select(r9(F.col("imbalance_ratio")).alias("imbalance_ratio"))


@query("A07_length_stats", """
    WITH l AS (SELECT length(text) AS len, row_number() OVER (ORDER BY length(text)) - 1 AS i, count(*) OVER () AS n FROM documents)
    SELECT count(*) AS total, min(len) AS min_length, max(len) AS max_length, round(sum(len)::DOUBLE / count(*), 9) AS avg_length,
      max(len) FILTER (i = n // 2) AS median_length, count(*) FILTER (len < 10) AS short_count, count(*) FILTER (len > 500) AS long_count FROM l
""")
def length_stats(spark, sf):
    out = op.length_stats(table(spark, sf, "documents"), "text")
    return out.withColumn("avg_length", r9(F.col("avg_length")))


@query("A08_duplicate_rate", """
    SELECT count(*) - count(DISTINCT md5(text)) AS duplicates FROM documents
""")
def duplicate_rate(spark, sf):
    return op.duplicate_count(table(spark, sf, "documents"), "text")


@query("A09_quality_issues", """
    WITH t AS (SELECT regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text, CAST(quality AS VARCHAR) AS label
               FROM documents JOIN labels USING (doc_id)),
    r AS (SELECT * FROM t WHERE text <> ''),
    l AS (SELECT length(text) AS len, row_number() OVER (ORDER BY length(text)) - 1 AS i, count(*) OVER () AS n FROM r),
    s AS (SELECT count(*) AS total, min(len) AS min_length, max(len) AS max_length, round(sum(len)::DOUBLE / count(*), 9) AS avg_length,
      max(len) FILTER (i = n // 2) AS median_length, count(*) FILTER (len < 10) AS short_count, count(*) FILTER (len > 500) AS long_count FROM l),
    c AS (SELECT CASE WHEN count(*) < 2 THEN 'inf'::DOUBLE ELSE max(n)::DOUBLE / min(n) END AS ratio FROM (SELECT count(*) AS n FROM r GROUP BY label)),
    d AS (SELECT count(*) - count(DISTINCT md5(text)) AS duplicates FROM r)
    SELECT total, min_length, max_length, avg_length, median_length, short_count, long_count, round(ratio, 9) AS imbalance_ratio, duplicates,
      concat_ws(',', CASE WHEN ratio > 3 THEN 'class_imbalance' END, CASE WHEN short_count > total * 0.1 THEN 'too_many_short' END,
        CASE WHEN duplicates > total * 0.05 THEN 'many_duplicates' END, CASE WHEN total < 2000 THEN 'small_dataset' END) AS issues
    FROM s, c, d
""")
def quality_issues(spark, sf):
    from tallyloom.operators.filters import nonblank_pair

    pairs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id") \
        .select("text", F.col("quality").cast("string").alias("label"))
    out = op.quality_report(nonblank_pair(pairs, "text", "label"), "text", "label")
    return (out.withColumn("avg_length", r9(F.col("avg_length"))).withColumn("imbalance_ratio", r9(F.col("imbalance_ratio")))
            .withColumn("issues", F.concat_ws(",", "issues")))


PROFILED = {"orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
            "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
            "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
            "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
            "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
            "labels": "doc_id bigint, quality int, toxic int", "benchmark": "item_id bigint, text string",
            "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"}
PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c.split()[0]}' AS column_name, '{c.split()[1]}' AS dtype, count(*) - count({c.split()[0]}) AS nulls, "
    f"count(DISTINCT {c.split()[0]}) AS uniques, count(*) AS n_rows FROM {t}"
    for t, cols in PROFILED.items() for c in cols.split(", "))


@query("A10_profile_columns", PROFILE_SQL)
def profile_columns(spark, sf):
    return union_all([column_stats(table(spark, sf, t)).drop("position").withColumn("table_name", F.lit(t))
                      for t in PROFILED])


@query("A11_type_mix", """
    SELECT 8 AS numeric_cols, 2 AS categorical_cols, 0.8::DOUBLE AS numeric_ratio, 0.2::DOUBLE AS categorical_ratio, TRUE AS mostly_numeric,
      FALSE AS mostly_categorical, FALSE AS mixed_types, count(*) AS n_rows FROM lineitem
""")
def type_mix(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumns(
        {k: F.lit(v) for k, v in profile.type_mix(df).items()})


@query("A12_missing_rate", """
    SELECT round((count(*) FILTER (event_id % 10 = 0) + count(*) FILTER (event_id % 4 = 1))::DOUBLE / count(*) / 6, 4) AS missing_rate FROM events
""")
def missing_rate(spark, sf):
    df = table(spark, sf, "events") \
        .withColumn("props", F.when(F.col("event_id") % 10 != 0, F.col("props"))) \
        .withColumn("value", F.when(F.col("event_id") % 4 == 1, float("nan")).otherwise(F.col("value")))
    return df.agg(profile.missing_rate(df).alias("missing_rate"))


@query("A13_target_profile", """
    WITH c AS (SELECT count(*) AS n FROM lineitem GROUP BY l_returnflag)
    SELECT 'l_returnflag' AS target, 'categorical' AS target_type, count(*) AS n_classes, round(min(n)::DOUBLE / max(n), 4) AS class_balance,
      round(min(n)::DOUBLE / max(n), 4) < 0.2 AS imbalanced, count(*) = 2 AS binary, count(*) > 2 AS multi_class,
      NULL::DOUBLE AS target_mean, NULL::DOUBLE AS target_std, NULL::DOUBLE AS target_skew FROM c
    UNION ALL
    SELECT 'l_extendedprice', 'continuous', 0, 1.0, FALSE, FALSE, FALSE, round(avg(l_extendedprice), 4),
      round(stddev_samp(l_extendedprice), 4), round(skewness(l_extendedprice), 4) FROM lineitem
""")
def target_profile(spark, sf):
    df = table(spark, sf, "lineitem")
    return union_all([profile.target_profile(df, t).withColumn("target", F.lit(t))
                      for t in ("l_returnflag", "l_extendedprice")])


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "charge"]


@query("A14_correlation_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 8) AS r, round(abs(corr({a}, {b})), 9) > 0.85 AS high "
    f"FROM (SELECT *, l_extendedprice * (1 - l_discount) AS charge FROM lineitem)"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]))
def correlation_pairs(spark, sf):
    df = table(spark, sf, "lineitem").withColumn("charge", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return profile.correlations(df, NUMERIC).select(
        "left", "right", F.round("r", 8).alias("r"), (F.abs("r") > 0.85).alias("high"))


@query("A15_text_columns", """
    SELECT c AS column_name, n_distinct > total * 0.1 AS is_text FROM (
      SELECT 'text' AS c, count(DISTINCT text) AS n_distinct, count(*) AS total FROM documents
      UNION ALL SELECT 'lang', count(DISTINCT lang), count(*) FROM documents
      UNION ALL SELECT 'source', count(DISTINCT source), count(*) FROM documents)
""")
def text_columns(spark, sf):
    stats = column_stats(table(spark, sf, "documents"), ["text", "lang", "source"])
    return stats.select("column_name", (F.col("uniques") > F.col("n_rows") * 0.1).alias("is_text"))


MATRIX_SQL = """
    m AS (SELECT a.v AS actual, b.v AS predicted, count(l.doc_id) AS n FROM (VALUES ('0'), ('1')) a(v) CROSS JOIN (VALUES ('0'), ('1')) b(v)
       LEFT JOIN labels l ON l.quality::VARCHAR = a.v AND (CASE WHEN l.doc_id % 3 = 0 THEN 1 - l.toxic ELSE l.quality END)::VARCHAR = b.v GROUP BY 1, 2),
    c AS (SELECT l AS label, sum(n) FILTER (actual = l) AS support, coalesce(sum(n) FILTER (predicted = l), 0) AS guessed,
       coalesce(sum(n) FILTER (actual = l AND predicted = l), 0) AS tp FROM m, (VALUES ('0'), ('1')) x(l) GROUP BY l),
    p AS (SELECT *, CASE WHEN guessed > 0 THEN tp::DOUBLE / guessed ELSE 0 END AS p, CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS r FROM c),
    f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM p)
"""


def scored_labels(spark, sf):
    return table(spark, sf, "labels").withColumn(
        "guess", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("toxic")).otherwise(F.col("quality")))


@query("A16_confusion_matrix", """
    SELECT a.v AS actual, b.v AS predicted, count(l.doc_id) AS n FROM (VALUES ('0'), ('1')) a(v) CROSS JOIN (VALUES ('0'), ('1')) b(v)
    LEFT JOIN labels l ON l.quality::VARCHAR = a.v AND l.toxic::VARCHAR = b.v GROUP BY 1, 2
""")
def confusion_matrix(spark, sf):
    return op.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic")


@query("A17_classification_metrics", f"""
    WITH {MATRIX_SQL}
    SELECT round(sum(tp)::DOUBLE / sum(support), 9) AS accuracy, round(sum(p * support) / sum(support), 9) AS precision_weighted,
      round(avg(p), 9) AS precision_macro, round(sum(r * support) / sum(support), 9) AS recall_weighted, round(avg(r), 9) AS recall_macro,
      round(sum(f * support) / sum(support), 9) AS f1_weighted, round(avg(f), 9) AS f1_macro FROM f
""")
def classification_metrics(spark, sf):
    out = op.classification_metrics(op.confusion_matrix(scored_labels(spark, sf), "quality", "guess"))
    return out.select(*[r9(F.col(c)).alias(c) for c in out.columns])


@query("A18_per_class_report", f"""
    WITH {MATRIX_SQL}
    SELECT label, round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1, support::BIGINT AS support FROM f
""")
def per_class_report(spark, sf):
    out = op.per_class_report(op.confusion_matrix(scored_labels(spark, sf), "quality", "guess"))
    return out.select("label", *[r9(F.col(c)).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("A19_regression_metrics", """
    WITH p AS (SELECT l_extendedprice / 1000 AS y, 2.0 * l_quantity AS g FROM lineitem)
    SELECT round(avg((y - g) * (y - g)), 6) AS mse, round(avg(abs(y - g)), 6) AS mae, round(sqrt(avg((y - g) * (y - g))), 6) AS rmse,
      round(1 - avg((y - g) * (y - g)) / var_pop(y), 6) AS r2 FROM p
""")
def regression_metrics(spark, sf):
    df = table(spark, sf, "lineitem").select((F.col("l_extendedprice") / 1000).alias("y"), (2.0 * F.col("l_quantity")).alias("g"))
    out = op.regression_metrics(df, "y", "g")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("A20_residual_shape", """
    WITH p AS (SELECT l_extendedprice / 1000 - 2.0 * l_quantity AS e FROM lineitem),
    m AS (SELECT *, avg(e) OVER () AS mu FROM p),
    s AS (SELECT avg((e - mu) ** 2) AS m2, avg((e - mu) ** 3) AS m3, avg((e - mu) ** 4) AS m4, sqrt(avg(e * e)) / avg(abs(e)) AS ratio FROM m)
    SELECT round(m3 / m2 ** 1.5, 6) AS residual_skew, round(m4 / (m2 * m2), 6) AS residual_kurtosis, round(ratio, 6) AS rmse_mae_ratio FROM s
""")
def residual_shape(spark, sf):
    df = table(spark, sf, "lineitem").select((F.col("l_extendedprice") / 1000).alias("y"), (2.0 * F.col("l_quantity")).alias("g"))
    out = op.residual_shape(df, "y", "g")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("A21_cluster_metrics", """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    x AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(e) AS x FROM v),
    c AS (SELECT label, i, avg(x) AS x FROM x GROUP BY ALL),
    m AS (SELECT i, avg(x) AS x FROM x GROUP BY i),
    n AS (SELECT label, count(*) AS n FROM v GROUP BY label),
    d AS (SELECT x.vec_id, x.label, sum((x.x - c.x) ** 2) AS d2 FROM x JOIN c USING (label, i) GROUP BY ALL),
    s AS (SELECT label, avg(sqrt(d2)) AS s, sum(d2) AS w FROM d GROUP BY label),
    g AS (SELECT a.label AS la, b.label AS lb, sqrt(sum((a.x - b.x) ** 2)) AS g FROM c a JOIN c b ON a.i = b.i AND a.label <> b.label GROUP BY ALL),
    db AS (SELECT avg(r) AS db FROM (SELECT la, max((sa.s + sb.s) / g) AS r FROM g JOIN s sa ON sa.label = la JOIN s sb ON sb.label = lb GROUP BY la)),
    bt AS (SELECT sum(n * q) AS b FROM n JOIN (SELECT c.label, sum((c.x - m.x) ** 2) AS q FROM c JOIN m USING (i) GROUP BY c.label) USING (label)),
    p AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.e, b.e) ** 2) AS t, count(*) AS cnt FROM v a JOIN v b ON a.vec_id <> b.vec_id GROUP BY ALL),
    ab AS (SELECT vec_id, max(t / cnt) FILTER (label = other) AS a, min(t / cnt) FILTER (label <> other) AS b FROM p GROUP BY vec_id),
    sil AS (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab)
    SELECT round(silhouette, 6) AS silhouette, round(db, 6) AS davies_bouldin,
      round((b / (SELECT count(*) - 1 FROM n)) / ((SELECT sum(w) FROM s) / ((SELECT sum(n) FROM n) - (SELECT count(*) FROM n))), 6) AS calinski_harabasz,
      round((SELECT sum(w) FROM s), 6) AS inertia FROM sil, db, bt
""")
def cluster_metrics(spark, sf):
    out = op.cluster_metrics(table(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("A22_external_cluster_metrics", """
    WITH e AS (SELECT label AS t, CASE WHEN vec_id % 4 = 0 THEN vec_id % 3 ELSE label // 2 END AS f FROM embeddings),
    n AS (SELECT t, f, count(*)::DOUBLE AS n FROM e GROUP BY ALL), a AS (SELECT t, sum(n) AS na FROM n GROUP BY t),
    b AS (SELECT f, sum(n) AS nb FROM n GROUP BY f), z AS (SELECT sum(n) AS z FROM n),
    q AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM n) AS i, (SELECT sum(na * (na - 1) / 2) FROM a) AS ra, (SELECT sum(nb * (nb - 1) / 2) FROM b) AS rb,
       (SELECT sum(n / z * ln(n * z / (na * nb))) FROM n JOIN a USING (t) JOIN b USING (f), z) AS mi,
       (SELECT -sum(na / z * ln(na / z)) FROM a, z) AS ha, (SELECT -sum(nb / z * ln(nb / z)) FROM b, z) AS hb, z FROM z)
    SELECT round((i - ra * rb / (z * (z - 1) / 2)) / ((ra + rb) / 2 - ra * rb / (z * (z - 1) / 2)), 8) AS adjusted_rand,
      round(mi / ((ha + hb) / 2), 8) AS normalised_mutual_info FROM q
""")
def external_cluster_metrics(spark, sf):
    found = F.when(F.col("vec_id") % 4 == 0, F.col("vec_id") % 3).otherwise(F.floor(F.col("label") / 2))
    out = op.external_cluster_metrics(table(spark, sf, "embeddings").withColumn("found", found), "label", "found")
    return out.select(*[F.round(c, 8).alias(c) for c in out.columns])


@query("A23_cluster_balance", """
    WITH c AS (SELECT CASE WHEN vec_id % 11 = 0 THEN -1 ELSE label END AS c, count(*) AS n FROM embeddings GROUP BY 1)
    SELECT round(min(n) FILTER (c <> -1)::DOUBLE / max(n) FILTER (c <> -1), 9) AS balance_ratio,
      round(sum(n) FILTER (c = -1)::DOUBLE / sum(n), 9) AS noise_ratio, count(*) FILTER (c <> -1) AS n_clusters FROM c
""")
def cluster_balance(spark, sf):
    df = table(spark, sf, "embeddings").withColumn("c", F.when(F.col("vec_id") % 11 == 0, -1).otherwise(F.col("label")))
    return op.cluster_balance(df, "c").select(r9(F.col("balance_ratio")).alias("balance_ratio"),
                                              r9(F.col("noise_ratio")).alias("noise_ratio"), "n_clusters")


@query("A24_fold_summary", """
    SELECT user_id, round(avg(value), 6) AS cv_mean, round(stddev_pop(value), 6) AS cv_std, count(value) AS n_folds FROM events GROUP BY user_id
""")
def fold_summary(spark, sf):
    out = op.fold_summary(table(spark, sf, "events"), "user_id", "value")
    return out.select("user_id", F.round("cv_mean", 6).alias("cv_mean"), F.round("cv_std", 6).alias("cv_std"), "n_folds")


CURVE_SQL = """
    o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events),
    g AS (SELECT user_id, max(n) AS n, avg(value) AS mean, stddev_pop(value) AS sd, regr_slope(value, i) AS slope,
       avg(value) FILTER (i < 3) AS early, avg(value) FILTER (i >= n - 3) AS late FROM o GROUP BY user_id),
    k AS (SELECT *, n >= 3 AND mean > 0 AS known, CASE WHEN n >= 3 AND mean > 0 THEN sd / mean ELSE 0 END AS cv FROM g),
    curve AS (SELECT user_id, n, cv, known, CASE WHEN known THEN slope END AS slope, CASE WHEN known THEN early END AS early_mean, CASE WHEN known THEN late END AS late_mean,
      known AND cv > 0.25 AS oscillating, known AND late > early * 1.5 AS diverging, known AND late > early * 0.7 AND NOT late > early * 1.5 AS slow_convergence,
      known AND late < early * 0.3 AND cv < 0.12 AS converged_well,
      CASE WHEN NOT known THEN 'unknown' WHEN late > early * 1.5 THEN 'diverging' WHEN slope < -0.01 THEN 'converging' WHEN abs(slope) < 0.01 THEN 'flat' ELSE 'increasing' END AS trend FROM k)
"""


@query("A25_loss_curve", f"""
    WITH {CURVE_SQL}
    SELECT user_id, n, round(cv, 6) AS cv, round(slope, 6) AS slope, round(early_mean, 6) AS early_mean, round(late_mean, 6) AS late_mean,
      oscillating, diverging, slow_convergence, converged_well, trend FROM curve
""")
def loss_curve(spark, sf):
    out = op.loss_curve(table(spark, sf, "events"), "user_id", "ts", "value", ["event_id"])
    return out.withColumns({c: F.round(c, 6) for c in ("cv", "slope", "early_mean", "late_mean")})


@query("A27_range_rules", """
    SELECT 'discount_low' AS rule, count(*) FILTER (l_discount > 0.05) AS violations FROM lineitem
    UNION ALL SELECT 'tax_unit', count(*) FILTER (NOT l_tax BETWEEN 0 AND 1) FROM lineitem
    UNION ALL SELECT 'quantity_positive', count(*) FILTER (l_quantity <= 2) FROM lineitem
    UNION ALL SELECT 'flag_known', count(*) FILTER (l_returnflag = 'N') FROM lineitem
""")
def range_rules(spark, sf):
    return op.range_rules(table(spark, sf, "lineitem"), {
        "discount_low": F.col("l_discount") <= 0.05, "tax_unit": F.col("l_tax").between(0, 1),
        "quantity_positive": F.col("l_quantity") > 2, "flag_known": F.col("l_returnflag").isin("A", "R")})


@query("A28_most_frequent", """
    WITH v AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL
      UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL
      UNION ALL SELECT 'o_custkey', o_custkey::VARCHAR, count(*) FROM orders GROUP BY ALL)
    SELECT column_name, value, n FROM (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS r FROM v) WHERE r = 1
""")
def most_frequent(spark, sf):
    return features.fit_modes(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("A29_inverse_frequency_weights", """
    WITH c AS (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic),
    w AS (SELECT *, sum(n) OVER ()::DOUBLE / (count(*) OVER () * n) AS raw FROM c)
    SELECT toxic, n, round(CASE WHEN (SELECT max(raw) / greatest(min(raw), 1) FROM w) > 3 THEN raw ELSE 1 END, 9) AS weight FROM w
""")
def inverse_frequency_weights(spark, sf):
    return op.inverse_frequency_weights(table(spark, sf, "labels"), "toxic").withColumn("weight", r9(F.col("weight")))


@query("A30_sorted_distinct", """
    SELECT p_brand AS label, row_number() OVER (ORDER BY p_brand) - 1 AS position FROM (SELECT DISTINCT p_brand FROM part)
""")
def sorted_distinct(spark, sf):
    return features.label_codes(table(spark, sf, "part"), "p_brand").select("label", F.col("code").cast("long").alias("position"))


@query("A31_dashboard_rollup", """
    SELECT p_type, p_brand, CAST(grouping(p_type) * 2 + grouping(p_brand) AS BIGINT) AS level, count(*) AS n, sum(p_size)::BIGINT AS total_size
    FROM part GROUP BY GROUPING SETS ((p_type), (p_brand), ())
""")
def dashboard_rollup(spark, sf):
    return op.dashboard_rollup(table(spark, sf, "part"), ["p_type", "p_brand"],
                               {"n": F.count(F.lit(1)), "total_size": F.sum("p_size")})
