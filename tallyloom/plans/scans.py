"""Bindings for readers, writers and codecs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans.registry import query, runs, table, RUNS_SQL
from tallyloom.session import scratch_path
from tallyloom.sources import codecs, readers, writers
from tallyloom.sources.readers import union_all

PART = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"


@query("S01_read_any", """
    SELECT f.fmt, p.* FROM part p CROSS JOIN (VALUES ('csv'), ('json'), ('txt')) f(fmt)
""")
def read_any(spark, sf):
    part = table(spark, sf, "part")
    base = scratch_path(spark, "read-any")
    part.write.option("header", "true").csv(f"{base}/csv")
    part.write.json(f"{base}/json")
    part.write.option("header", "true").option("sep", "\t").csv(f"{base}/txt")
    return union_all([
        readers.read_any(spark, f"{base}/{f}", f, schema=PART).withColumn("fmt", F.lit(f))
        for f in ("csv", "json", "txt")])


@query("S02_read_with_encoding", """
    SELECT doc_id, source, regexp_replace(text, '[\\r\\n]+', ' ', 'g') AS text
    FROM documents
    WHERE NOT regexp_matches(text, '[^\\x00-\\xff]') AND NOT regexp_matches(text, '[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x9f]')
""")
def read_with_encoding(spark, sf):
    docs = table(spark, sf, "documents").filter(
        ~F.col("text").rlike(r"[^\x00-\xff]") & ~F.col("text").rlike(r"[\x00-\x08\x0b-\x1f\x7f-\x9f]"))
    path = scratch_path(spark, "latin1")
    (docs.select("doc_id", "source", F.regexp_replace("text", r"[\r\n]+", " ").alias("text"))
     .write.options(header="true", encoding="ISO-8859-1", escape='"',
                    ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))
    return readers.read_with_encoding(
        spark, path, "doc_id BIGINT, source STRING, text STRING", escape='"')


@query("S03_read_headerless", """
    SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN NULL ELSE s_acctbal END AS s_acctbal, s_name
    FROM supplier
""")
def read_headerless(spark, sf):
    supplier = table(spark, sf, "supplier")
    path = scratch_path(spark, "headerless")
    (supplier.select("s_suppkey", "s_name", "s_nationkey",
                     F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("string"))
                     .otherwise("?").alias("s_acctbal"))
     .write.option("header", "false").option("sep", "|").csv(path))
    return readers.read_headerless(
        spark, path, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
        sep="|", drop=["s_nationkey"])


@query("S04_normalise_column_names", """
    SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size_in_mm FROM part
""")
def normalise_column_names(spark, sf):
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias(" part key "), F.col("p_name").alias("part name"),
        F.col("p_size").alias("size in  mm"))
    return readers.normalise_column_names(part)


@query("S05_sniff_text_label", """
    WITH src AS (
      SELECT d.doc_id,
             CASE WHEN d.doc_id % 2 = 0 THEN CAST(l.quality AS VARCHAR) ELSE d.text END AS c0,
             CASE WHEN d.doc_id % 2 = 0 THEN d.text ELSE CAST(l.quality AS VARCHAR) END AS c1
      FROM documents d JOIN labels l USING (doc_id)),
    sided AS (
      SELECT doc_id, trim(c0, ' ') a, trim(c1, ' ') b,
             CASE WHEN trim(c0, ' ') IN ('0', '1') THEN 'left'
                  WHEN trim(c1, ' ') IN ('0', '1') THEN 'right'
                  WHEN length(trim(c0, ' ')) <= 4 AND length(trim(c1, ' ')) > 10 THEN 'left'
                  WHEN length(trim(c1, ' ')) <= 4 AND length(trim(c0, ' ')) > 10 THEN 'right' END AS side
      FROM src),
    cut AS (SELECT doc_id, CASE side WHEN 'left' THEN a ELSE b END AS raw,
                   CASE side WHEN 'left' THEN b ELSE a END AS text FROM sided WHERE side IS NOT NULL)
    SELECT doc_id, text, CASE raw WHEN '1' THEN 'positive' WHEN '0' THEN 'negative' ELSE raw END AS label
    FROM cut WHERE length(text) >= 5
""")
def sniff_text_label(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    q, even = F.col("quality").cast("string"), F.col("doc_id") % 2 == 0
    two = docs.select("doc_id", F.when(even, q).otherwise(F.col("text")).alias("c0"),
                      F.when(even, F.col("text")).otherwise(q).alias("c1"))
    return readers.sniff_text_label(two, "c0", "c1")


@query("S06_ingest_gate", """
    SELECT count(*) >= 50 AS accepted, CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) < 50
           THEN 'too_few_rows' ELSE 'ok' END AS reason, count(*) AS n_rows,
           'l_returnflag' AS target FROM lineitem
""")
def ingest_gate(spark, sf):
    verdict = readers.ingest_gate(table(spark, sf, "lineitem"), "RETURN")
    return spark.createDataFrame(
        [(verdict["accepted"], verdict["reason"], verdict["rows"], verdict["target"])],
        "accepted BOOLEAN, reason STRING, n_rows BIGINT, target STRING")


@query("S07_clean_write", """
    SELECT DISTINCT text, lang, source FROM documents
""")
def clean_write(spark, sf):
    docs = table(spark, sf, "documents").select(
        "source", "text", "lang", F.lit(None).cast("string").alias("note"))
    path = scratch_path(spark, "clean")
    # base64 keeps line breaks and quotes of the texts out of the csv cells
    writers.clean_write(docs.withColumn("text", F.base64(F.encode("text", "UTF-8"))), path, "source")
    back = readers.read_any(spark, path, "csv", schema="text STRING, lang STRING, source STRING",
                            multiLine="true")
    return back.withColumn("text", F.decode(F.unbase64("text"), "UTF-8"))


@query("S08_preview", """
    WITH head AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 20)
    SELECT 'o_orderkey' AS column_name, 'bigint' AS dtype, count(*) - count(o_orderkey) AS nulls, count(DISTINCT o_orderkey) AS uniques FROM head
    UNION ALL SELECT 'o_custkey', 'bigint', count(*) - count(o_custkey), count(DISTINCT o_custkey) FROM head
    UNION ALL SELECT 'o_orderstatus', 'string', count(*) - count(o_orderstatus), count(DISTINCT o_orderstatus) FROM head
    UNION ALL SELECT 'o_totalprice', 'double', count(*) - count(o_totalprice), count(DISTINCT o_totalprice) FROM head
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(*) - count(o_orderdate), count(DISTINCT o_orderdate) FROM head
    UNION ALL SELECT 'o_orderpriority', 'string', count(*) - count(o_orderpriority), count(DISTINCT o_orderpriority) FROM head
""")
def preview(spark, sf):
    _, facts = readers.preview(table(spark, sf, "orders"), ["o_orderkey"], 20)
    return facts.select("column_name", "dtype", "nulls", "uniques")


@query("S09_decode_json_column", """
    SELECT event_id, CAST(json_extract_string(CASE WHEN event_id % 7 = 0 THEN '{}' ELSE props END, '$.k') AS INTEGER) AS k
    FROM events
""")
def decode_json_column(spark, sf):
    ev = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 14 == 0, "").when(F.col("event_id") % 7 == 0, "{broken") \
        .otherwise(F.col("props"))
    return ev.select("event_id", codecs.decode_json(text, "k INT").getField("k").alias("k"))


@query("S10_encode_json_column", """
    SELECT event_id, '{"event_type":"' || event_type || '","user_id":' || user_id || '}' AS doc FROM events
""")
def encode_json_column(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", codecs.encode_json(["event_type", "user_id"]).alias("doc"))


@query("S14_append_run_history", """
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, round(sum(value), 2) AS total
    FROM events GROUP BY event_type
""")
def append_run_history(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    path = scratch_path(spark, "history")
    writers.append_run_history(ev.filter(F.col("event_id") % 2 == 0), path, "event_type")
    writers.append_run_history(ev.filter(F.col("event_id") % 2 == 1), path, "event_type")
    return (spark.read.parquet(path).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"),
                 F.round(F.sum("value"), 2).alias("total")))


@query("S15_content_digest", """
    SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents
""")
def content_digest(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", codecs.content_digest("text").alias("sha256"),
        codecs.content_digest("text", "md5").alias("md5"))


@query("S16_nested_report", f"""
    WITH {RUNS_SQL}
    SELECT algorithm, count(*) AS n, min(acc) AS worst, max(acc) AS best, count(*) AS items_written
    FROM runs GROUP BY algorithm
""")
def nested_report(spark, sf):
    df = runs(spark, sf).select("run_id", "algorithm", "acc")
    path = scratch_path(spark, "report")
    writers.write_nested_report(df, path, "algorithm",
                                {"worst": F.min("acc"), "best": F.max("acc")})
    summary = spark.read.schema("algorithm STRING, n BIGINT, worst DOUBLE, best DOUBLE").json(f"{path}/summary")
    items = (spark.read.schema("run_id STRING, acc DOUBLE, algorithm STRING").json(f"{path}/items")
             .groupBy("algorithm").agg(F.count(F.lit(1)).alias("items_written")))
    return summary.join(items, "algorithm")
