"""Bindings for scalar functions and text scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import patterns
from tallyloom.functions import text as tx
from tallyloom.functions import values as vl
from tallyloom.operators import ordered
from tallyloom.operators.joins import first_rule
from tallyloom.plans.registry import EVENTS_SQL, events, query, sql_round, table


@query("C01_format_bytes", """
    SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN '0 B' WHEN b < 1024 THEN printf('%.2f B', b)
       WHEN b < 1048576 THEN printf('%.2f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576)
       ELSE printf('%.2f GB', b / 1073741824) END AS size
    FROM (SELECT doc_id, CASE WHEN doc_id % 50 = 0 THEN 0 WHEN doc_id % 3 = 0 THEN n_chars * 1000003.0
          ELSE n_chars END::DOUBLE AS b FROM documents)
""")
def format_bytes(spark, sf):
    n = F.when(F.col("doc_id") % 50 == 0, 0).when(F.col("doc_id") % 3 == 0, F.col("n_chars") * 1000003) \
        .otherwise(F.col("n_chars"))
    return table(spark, sf, "documents").select("doc_id", tx.format_bytes(n).alias("size"))


@query("C02_format_duration", """
    SELECT event_id, CASE WHEN s < 60 THEN CAST(floor(s) AS BIGINT) || '秒'
       WHEN s < 3600 THEN CAST(floor(s / 60) AS BIGINT) || '分' || CAST(floor(s % 60) AS BIGINT) || '秒'
       ELSE CAST(floor(s / 3600) AS BIGINT) || '小时' || CAST(floor((s % 3600) / 60) AS BIGINT) || '分钟' END AS shown
    FROM (SELECT event_id, value * (event_id % 40 + 1) AS s FROM events)
""")
def format_duration(spark, sf):
    secs = F.col("value") * (F.col("event_id") % 40 + 1)
    return table(spark, sf, "events").select("event_id", tx.format_duration(secs).alias("shown"))


@query("C03_format_datetime", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS shown
    FROM orders
""")
def format_datetime(spark, sf):
    ts = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", tx.format_datetime(ts).alias("shown"))


@query("C04_truncate_text", """
    SELECT doc_id, CASE WHEN length(text) <= 100 THEN text ELSE substr(text, 1, 97) || '...' END AS shown FROM documents
""")
def truncate_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.truncate_text(F.col("text")).alias("shown"))


@query("C05_slug", """
    SELECT p_partkey, trim(regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^a-zA-Z0-9_-]', '-', 'g'), '-') AS slug
    FROM part
""")
def slug(spark, sf):
    name = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", tx.slug(name).alias("slug"))


@query("C06_clean_filename", """
    WITH f AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN md5(url) || '_' WHEN 1 THEN '0f8fad5b-d9cb-469f-a165-70867728950e_' ELSE '' END
               || regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1)
               || CASE page_id % 2 WHEN 0 THEN '_best-run.pkl' ELSE '' END AS name FROM pages),
    c AS (SELECT page_id, trim(translate(regexp_replace(regexp_replace(regexp_replace(name,
           '\\.(pkl|pt|pth|h5|keras|onnx|joblib|zip)$', '', 'i'),
           '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}_', '', 'i'), '^[0-9a-f]{32}_', '', 'i'), '_-', '  ')) AS title FROM f)
    SELECT page_id, CASE WHEN length(title) >= 2 THEN title END AS title FROM c
""")
def clean_filename(spark, sf):
    pick = F.col("page_id") % 3
    name = F.concat(
        F.when(pick == 0, F.concat(F.md5("url"), F.lit("_")))
        .when(pick == 1, "0f8fad5b-d9cb-469f-a165-70867728950e_").otherwise(""),
        F.regexp_extract(F.regexp_replace("url", r"[?#].*$", ""), r"([^/]*)/?$", 1),
        F.when(F.col("page_id") % 2 == 0, "_best-run.pkl").otherwise(""))
    return table(spark, sf, "pages").select("page_id", tx.clean_filename(name).alias("title"))


# the algorithm stands between a slash and a bracketed note
TAIL = r"/\s+(\w+)\s+\[[a-z]+\]"
KNOWN = {"random_forest": "forest", "ridge": "ridge"}
PREFIXES = [("NLP-LogReg", "logistic"), ("NLP-Log", "other"), ("NLP-SVM", "svm")]


@query("C09_extract_algorithm", """
    WITH n AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'set: ' || source || ' / random_forest [rerun]'
        WHEN 1 THEN source || ' /  mystery [check]' WHEN 2 THEN 'NLP-LogReg-' || source
        WHEN 3 THEN 'NLP-SVM / ridge [rerun]' ELSE source END AS name FROM documents),
    t AS (SELECT *, regexp_extract(name, '/\\s+(\\w+)\\s+\\[[a-z]+\\]', 1) AS tail FROM n)
    SELECT doc_id, CASE WHEN tail = 'random_forest' THEN 'forest' WHEN tail = 'ridge' THEN 'ridge'
       WHEN contains(name, 'NLP-LogReg') THEN 'logistic' WHEN contains(name, 'NLP-Log') THEN 'other'
       WHEN contains(name, 'NLP-SVM') THEN 'svm' END AS algorithm FROM t
""")
def extract_algorithm(spark, sf):
    m, src = F.col("doc_id") % 5, F.col("source")
    name = (F.when(m == 0, F.concat(F.lit("set: "), src, F.lit(" / random_forest [rerun]")))
            .when(m == 1, F.concat(src, F.lit(" /  mystery [check]")))
            .when(m == 2, F.concat(F.lit("NLP-LogReg-"), src))
            .when(m == 3, "NLP-SVM / ridge [rerun]").otherwise(src))
    return table(spark, sf, "documents").select(
        "doc_id", tx.extract_algorithm(name, TAIL, KNOWN, PREFIXES).alias("algorithm"))


@query("C10_normalise_key", """
    SELECT p_partkey, CASE lower(p_type) WHEN 'economy' THEN 'cheap' WHEN 'promo' THEN 'offer_item'
       ELSE replace(lower(p_type || '-Class'), '-', '_') END AS key FROM part
""")
def normalise_key(spark, sf):
    raw = F.when(F.col("p_type").isin("ECONOMY", "PROMO"), F.col("p_type")) \
        .otherwise(F.concat("p_type", F.lit("-Class")))
    return table(spark, sf, "part").select("p_partkey", tx.normalise_key(
        raw, {"economy": "cheap", "promo": "offer_item", "small_class": "never"}, ["small_class"]).alias("key"))


@query("C11_strip_html", """
    SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g') AS text
    FROM pages
""")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.strip_html(F.col("html")).alias("text"))


BANNED = ["casino", "cheap.{0,20}pills", "[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}", "license", "tion.*tion", "https?://"]


@query("C12_moderate", """
    WITH t AS (SELECT 'd' || doc_id AS id, CASE WHEN doc_id % 101 = 0 THEN ' ' ELSE text END AS text FROM documents
               UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations)
    SELECT id, CASE WHEN regexp_matches(text, '^\\s*$') THEN 'empty_content'
       WHEN regexp_matches(text, 'casino', 'i') THEN 'auto_filtered:casino'
       WHEN regexp_matches(text, 'cheap.{0,20}pills', 'i') THEN 'auto_filtered:cheap.{0,20}pills'
       WHEN regexp_matches(text, '[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}', 'i') THEN 'auto_filtered:[a-z0-9._%+-]+@[a-z0-9.-]+[.][a-z]{2,}'
       WHEN regexp_matches(text, 'license', 'i') THEN 'auto_filtered:license'
       WHEN regexp_matches(text, 'tion.*tion', 'i') THEN 'auto_filtered:tion.*tion'
       WHEN regexp_matches(text, 'https?://', 'i') THEN 'auto_filtered:https?://' END AS reason,
       reason IS NULL AS is_clean FROM t
""")
def moderate(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"),
        F.when(F.col("doc_id") % 101 == 0, " ").otherwise(F.col("text")).alias("text"))
    conv = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), "text")
    return (docs.unionByName(conv).select("id", tx.moderate(F.col("text"), BANNED).alias("reason"))
            .withColumn("is_clean", F.col("reason").isNull()))


@query("C13_link_policy", """
    WITH h AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) AS host FROM pages)
    SELECT page_id, host, host = 'example.org' OR host LIKE '%.example.org' OR host = 'www.ththhe.example.com'
       OR host LIKE '%.www.ththhe.example.com' AS allowed FROM h
""")
def link_policy(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", tx.host_of(url).alias("host"),
        tx.link_allowed(url, ["example.org", "www.ththhe.example.com"]).alias("allowed"))


@query("C14_url_admissible", """
    WITH u AS (SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'http://10.' || page_id % 256 || '.0.1/x'
        WHEN 1 THEN 'https://' || (page_id % 223 + 1) || '.8.' || page_id % 256 || '.4:8080/'
        WHEN 2 THEN 'ftp://files.example.com/a' WHEN 3 THEN 'http://172.' || page_id % 40 || '.1.1'
        WHEN 4 THEN 'http://[::1]/a' WHEN 5 THEN 'http:///nohost' ELSE url END AS url FROM pages),
    p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
          regexp_extract(url, '^[a-z]+://(\\[[^\\]]*\\]|[^/:?#]*)', 1) AS host FROM u),
    o AS (SELECT *, CASE WHEN regexp_matches(host, '^\\d+\\.\\d+\\.\\d+\\.\\d+$') THEN
          [CAST(x AS BIGINT) for x in string_split(host, '.')] END AS q FROM p)
    SELECT page_id, url, scheme IN ('http', 'https') AND host <> '' AND host NOT LIKE '[::1%' AND NOT coalesce(
       q[1] IN (0, 10, 127) OR q[1] >= 224 OR (q[1] = 100 AND q[2] BETWEEN 64 AND 127) OR (q[1] = 169 AND q[2] = 254)
       OR (q[1] = 172 AND q[2] BETWEEN 16 AND 31) OR (q[1] = 192 AND q[2] = 168) OR (q[1] = 192 AND q[2] = 0 AND q[3] IN (0, 2))
       OR (q[1] = 198 AND q[2] IN (18, 19)) OR (q[1] = 198 AND q[2] = 51 AND q[3] = 100) OR (q[1] = 203 AND q[2] = 0 AND q[3] = 113), FALSE)
       AS admissible FROM o
""")
def url_admissible(spark, sf):
    i = F.col("page_id")
    text = lambda c: c.cast("string")
    url = (F.when(i % 8 == 0, F.concat(F.lit("http://10."), text(i % 256), F.lit(".0.1/x")))
           .when(i % 8 == 1, F.concat(F.lit("https://"), text(i % 223 + 1), F.lit(".8."), text(i % 256), F.lit(".4:8080/")))
           .when(i % 8 == 2, "ftp://files.example.com/a")
           .when(i % 8 == 3, F.concat(F.lit("http://172."), text(i % 40), F.lit(".1.1")))
           .when(i % 8 == 4, "http://[::1]/a").when(i % 8 == 5, "http:///nohost").otherwise(F.col("url")))
    return (table(spark, sf, "pages").select("page_id", url.alias("url"))
            .withColumn("admissible", tx.url_admissible(F.col("url"))))


@query("C15_char_ngrams", """
    WITH c AS (SELECT string_split(text, '') AS c FROM documents),
    g AS (SELECT unnest(list_transform(range(1, len(c)), lambda i: c[i] || c[i+1])) AS gram FROM c
          UNION ALL SELECT unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i+1] || c[i+2])) FROM c
          UNION ALL SELECT unnest(list_transform(range(1, len(c) - 2), lambda i: c[i] || c[i+1] || c[i+2] || c[i+3])) FROM c)
    SELECT gram, count(*) AS n FROM g GROUP BY gram
""")
def char_ngrams(spark, sf):
    return patterns.window_counts(table(spark, sf, "documents"), "text", (2, 3, 4))


LEXICON = [("tion", 1), ("able", 1), ("heit", 1), ("err", -1), ("est", -1), ("des", -1)]
NEGATORS = ["un", "no"]


@query("C16_lexicon_sentiment", f"""
    WITH lex(word, weight) AS (VALUES ('tion', 1), ('able', 1), ('heit', 1), ('err', -1), ('est', -1), ('des', -1)),
    d AS (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM documents),
    c AS (SELECT doc_id, string_split(t, '') AS c FROM d),
    p AS (SELECT doc_id, 3 AS w, unnest(range(1, len(c) - 1)) AS pos,
                 unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i+1] || c[i+2])) AS gram FROM c
          UNION ALL SELECT doc_id, 4, unnest(range(1, len(c) - 2)),
                 unnest(list_transform(range(1, len(c) - 2), lambda i: c[i] || c[i+1] || c[i+2] || c[i+3])) FROM c),
    h AS (SELECT doc_id, word, weight, pos,
            (pos > 1 AND trim(substr(t, pos - 1, w)) IN ('un', 'no')) OR (pos > 2 AND trim(substr(t, pos - 2, w)) IN ('un', 'no')) AS near,
            substr(t, greatest(1, pos - 3), pos - greatest(1, pos - 3)) AS prefix
          FROM p JOIN lex ON word = gram JOIN d USING (doc_id)),
    g AS (SELECT doc_id, word, weight, count(*) AS hits, sum(near::INT) AS near, arg_min(prefix, pos) AS prefix
          FROM h GROUP BY ALL),
    f AS (SELECT *, CASE WHEN contains(prefix, 'un') OR contains(prefix, 'no') THEN hits ELSE near END AS turned FROM g),
    s AS (SELECT doc_id, sum(CASE WHEN weight > 0 THEN hits - turned ELSE turned END) AS p,
                 sum(CASE WHEN weight > 0 THEN turned ELSE hits - turned END) AS n FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(p, 0)::BIGINT AS positive_count, coalesce(n, 0)::BIGINT AS negative_count,
       CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label,
       CASE WHEN coalesce(p + n, 0) = 0 THEN 0.0 WHEN p = n THEN 0.5 ELSE {sql_round("greatest(p, n)::DOUBLE / (p + n)::DOUBLE", 3)} END::DOUBLE AS confidence
    FROM documents LEFT JOIN s USING (doc_id)
""")
def lexicon_sentiment(spark, sf):
    lexicon = spark.createDataFrame(LEXICON, "word STRING, weight INT")
    return tx.lexicon_sentiment(table(spark, sf, "documents"), "doc_id", "text", lexicon,
                                "word", "weight", NEGATORS, widths=(3, 4))


CLASSES = ["reheat", "nation", "Sports", "en"]


@query("C17_keyword_class", """
    WITH t AS (SELECT doc_id, lower(text) AS low, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: length(w) > 1) AS words FROM documents),
    s AS (SELECT doc_id, CASE WHEN contains(low, 'reheat') THEN 1.0 WHEN len(list_filter(words, lambda w: contains('reheat', w))) > 0 THEN 0.5 ELSE 0 END AS a,
      CASE WHEN contains(low, 'nation') THEN 1.0 WHEN len(list_filter(words, lambda w: contains('nation', w))) > 0 THEN 0.5 ELSE 0 END AS b,
      CASE WHEN contains(low, 'sports') THEN 1.0 WHEN len(list_filter(words, lambda w: contains('sports', w))) > 0 THEN 0.5 ELSE 0 END AS c,
      CASE WHEN contains(low, 'en') THEN 1.0 WHEN len(list_filter(words, lambda w: contains('en', w))) > 0 THEN 0.5 ELSE 0 END AS d FROM t),
    b AS (SELECT doc_id, greatest(a, b, c, d) AS top, CASE WHEN top = 0 THEN NULL WHEN a = top THEN 'reheat' WHEN b = top THEN 'nation'
      WHEN c = top THEN 'Sports' ELSE 'en' END AS class FROM s)
    SELECT doc_id, class, CASE WHEN class IS NOT NULL THEN 0.5::DOUBLE END AS confidence,
      CASE WHEN class IS NOT NULL THEN CASE WHEN class = 'reheat' THEN 0.5 ELSE round(0.5 / 3, 3) END::DOUBLE END AS prob_reheat FROM b
""")
def keyword_class(spark, sf):
    best, probs = tx.keyword_class(F.col("text"), CLASSES)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", best.alias("class"), probs.alias("p")).select(
        "doc_id", "class", F.when(F.col("class").isNotNull(), F.lit(0.5)).alias("confidence"),
        F.get("p", F.lit(0)).alias("prob_reheat"))


DOMAINS = [("latin", ["ción", "mente", "ez"]), ("german", ["sch", "heit", "ung"]), ("english", ["tion", "able", "ing"])]


@query("C18_domain_by_hits", """
    WITH s AS (SELECT doc_id, contains(t, 'ción')::INT + contains(t, 'mente')::INT + contains(t, 'ez')::INT AS a,
      contains(t, 'sch')::INT + contains(t, 'heit')::INT + contains(t, 'ung')::INT AS b,
      contains(t, 'tion')::INT + contains(t, 'able')::INT + contains(t, 'ing')::INT AS c
      FROM (SELECT doc_id, lower(text) AS t FROM documents))
    SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN NULL WHEN a = greatest(a, b, c) THEN 'latin'
      WHEN b = greatest(a, b, c) THEN 'german' ELSE 'english' END AS domain FROM s
""")
def domain_by_hits(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", tx.domain_by_hits(F.col("text"), DOMAINS).alias("domain"))


CATEGORY_RULES = [(["ring", "bolt"], "hardware"), (["gear"], "machine"), (["p_retailprice"], "priced")]


@query("C19_infer_category", """
    SELECT p_partkey, CASE WHEN name LIKE '%ring%' OR name LIKE '%bolt%' THEN 'hardware' WHEN name LIKE '%gear%' THEN 'machine'
      ELSE 'tabular' END AS category, 'priced' AS with_columns
    FROM (SELECT p_partkey, replace(lower(p_name), '_', ' ') AS name FROM part)
""")
def infer_category(spark, sf):
    from tallyloom.operators.profile import infer_category as infer

    part = table(spark, sf, "part")
    plain = infer(F.col("p_name"), CATEGORY_RULES, columns=["a", "b"], extension="csv")
    seen = infer(F.lit("untitled"), CATEGORY_RULES, columns=part.columns, extension="csv")
    return part.select("p_partkey", plain.alias("category"), seen.alias("with_columns"))


@query("C20_canonical_label", """
    SELECT doc_id, CASE quality WHEN 1 THEN 'positive' ELSE 'negative' END AS label,
      CASE WHEN toxic = 1 THEN 'odd' ELSE 'negative' END AS other FROM labels
""")
def canonical_label(spark, sf):
    names = {"1": "positive", "pos": "positive", "0": "negative", "neg": "negative"}
    raw = F.when(F.col("toxic") == 1, "odd").otherwise("neg")
    q = F.col("quality").cast("string")
    return table(spark, sf, "labels").select("doc_id", tx.lookup(q, names, q).alias("label"),
                                             tx.lookup(raw, names, raw).alias("other"))


@query("C21_split_tags", """
    SELECT p_partkey, len(list_filter(string_split(replace(p_name, ' ', ' , ,'), ','), lambda x: trim(x) <> '')) AS n_tags,
      replace(p_name, ' ', ',') AS joined FROM part
""")
def split_tags(spark, sf):
    tags = tx.split_tags(F.regexp_replace("p_name", " ", " , ,"))
    return table(spark, sf, "part").select("p_partkey", F.size(tags).cast("long").alias("n_tags"),
                                           tx.join_tags(tags).alias("joined"))


@query("C22_typed_params", f"""
    WITH {EVENTS_SQL}
    SELECT event_id, CASE WHEN k % 3 = 0 THEN NULL ELSE k::BIGINT END AS batch_size,
       CASE WHEN k % 4 = 0 THEN NULL ELSE k / 100.0::DOUBLE END AS dropout,
       CASE WHEN k % 5 <> 0 THEN k || '+' || (k + 1) END AS layers FROM ev
""")
def typed_params(spark, sf):
    ev, k = events(spark, sf), F.col("k")
    batch = F.when(k % 3 == 0, "many").otherwise(F.concat(F.lit(" "), k.cast("string")))
    drop = F.when(k % 4 == 0, "").otherwise((k / 100.0).cast("string"))
    layers = F.when(k % 5 == 0, "64,x").otherwise(F.concat(k.cast("string"), F.lit(", ,"), (k + 1).cast("string")))
    return ev.select("event_id", vl.typed_param(batch, "int").alias("batch_size"),
                     vl.typed_param(drop, "float").alias("dropout"),
                     F.array_join(F.transform(vl.typed_param(layers, "ints"), lambda x: x.cast("string")), "+").alias("layers"))


@query("C23_merge_params", f"""
    WITH {EVENTS_SQL}
    SELECT event_id, 'depth=' || k || CASE WHEN k % 2 = 0 THEN ';dropout=0.1' ELSE ';dropout=0.5' END || ';test_size=0.2' AS params FROM ev
""")
def merge_params(spark, sf):
    k = F.col("k").cast("string")
    best = F.map_filter(F.create_map(F.lit("depth"), k, F.lit("algorithm"), F.lit("x"), F.lit("dropout"),
                                     F.when(F.col("k") % 2 == 0, "0.1")), lambda a, v: v.isNotNull())
    old = F.create_map(F.lit("dropout"), F.lit("0.5"), F.lit("test_size"), F.lit("0.2"), F.lit("depth"), F.lit("9"))
    merged = vl.merge_params(best, old, ["algorithm"])
    pairs = F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return events(spark, sf).select("event_id", F.array_join(pairs, ";").alias("params"))


@query("C24_calendar_parts", """
    SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(month(ts) AS INTEGER) AS month FROM events
""")
def calendar_parts(spark, sf):
    parts = vl.calendar_parts(F.col("ts"))
    return table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("C25_to_utc8", "SELECT event_id, ts + INTERVAL 8 HOURS AS local_ts FROM events")
def to_utc8(spark, sf):
    return table(spark, sf, "events").select("event_id", vl.to_utc8(F.col("ts")).alias("local_ts"))


@query("C26_pick_metric", """
    SELECT event_id, CASE event_type WHEN 'click' THEN value WHEN 'view' THEN value + 1 WHEN 'error' THEN value + 2
       WHEN 'signup' THEN value + 3 END AS f1 FROM events
""")
def pick_metric(spark, sf):
    v, kind = F.col("value"), F.col("event_type")
    m = (F.when(kind == "click", F.create_map(F.lit("f1_macro"), v + 9, F.lit("test_f1_macro"), v))
         .when(kind == "view", F.create_map(F.lit("test_f1_score"), v + 1, F.lit("f1_macro"), v + 9))
         .when(kind == "error", F.create_map(F.lit("f1_macro"), v + 2, F.lit("f1_score"), v + 9))
         .when(kind == "signup", F.create_map(F.lit("f1_score"), v + 3))
         .otherwise(F.create_map(F.lit("loss"), v)))
    return table(spark, sf, "events").select("event_id", vl.pick_metric(m, "f1_macro", "f1_score").alias("f1"))


@query("C27_domain_check", """
    WITH e AS (SELECT page_id, nullif(lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]\\.([A-Za-z0-9]+)$', 1)), '') AS extension FROM pages)
    SELECT page_id, extension, coalesce(extension IN ('html', 'csv', 'com'), FALSE) AS allowed FROM e
""")
def domain_check(spark, sf):
    ext = vl.file_extension(F.col("url"))
    return table(spark, sf, "pages").select("page_id", ext.alias("extension"),
                                            vl.in_domain(ext, ["html", "csv", "com"]).alias("allowed"))


@query("C28_round_and_clip", f"""
    SELECT event_id, {sql_round("greatest(3, least(99, value))::DOUBLE", 1)} AS score FROM events
""")
def round_and_clip(spark, sf):
    return table(spark, sf, "events").select("event_id", vl.clip(F.col("value"), 3.0, 99.0, 1).alias("score"))


@query("C29_log_scale_lerp", """
    WITH n AS (SELECT l_partkey AS dataset_id, count(*) * count(*) AS n_rows FROM lineitem GROUP BY 1),
    t AS (SELECT *, (log10(greatest(100, least(1000000, n_rows))) - 2.0) / 4.0 AS t FROM n)
    SELECT dataset_id, n_rows, CAST(round_even(35 + (4 - 35) * t, 0) AS INTEGER) AS epochs,
      CAST(round_even((12 + 148 * t) / 8, 0) * 8 AS INTEGER) AS batch_size, round(0.0003 + (0.002 - 0.0003) * t, 6) AS learning_rate,
      round(0.55 + (0.15 - 0.55) * t, 2) AS dropout, round(pow(10.0, -2.5 + (-5.0 + 2.5) * t), 9) AS weight_decay,
      round(0.22 + (0.08 - 0.22) * t, 2) AS val_size FROM t
""")
def log_scale_lerp(spark, sf):
    n = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("dataset_id")) \
        .agg((F.count(F.lit(1)) * F.count(F.lit(1))).alias("n_rows"))
    s = vl.size_scaled_settings(F.col("n_rows"))
    s["weight_decay"] = F.round(s["weight_decay"], 9)
    return n.select("dataset_id", "n_rows", *[c.alias(k) for k, c in s.items()])


@query("C30_cast_codes", """
    SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS BIGINT) AS code FROM orders
""")
def cast_codes(spark, sf):
    from tallyloom.operators.features import alphabetical_codes

    orders = table(spark, sf, "orders")
    return (alphabetical_codes(orders, "o_orderpriority", "code")
            .select("o_orderkey", F.col("code").cast("long").alias("code")))
