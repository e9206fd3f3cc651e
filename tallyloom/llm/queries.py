"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import (
    bitmap_tiles,
    bitplanes,
    kruskal_runs,
    language_spans,
    length_buckets,
    line_frequency,
    lsh_forest,
    ordinal_quality,
    prefix_join,
    secret_forest,
    shared_lists,
    substring_dedup,
    suffix_tree_lm,
)
from tallyloom.llm.registry import ORACLES, QUERIES, query, table

__all__ = ["ORACLES", "QUERIES"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query("op1_substring_dedup", sql=r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    win AS (
      SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM d WHERE len(ws) >= 20)),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM later),
    lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
    left_words AS (
      SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS kept
      FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN lists USING (doc_id) LEFT JOIN left_words USING (doc_id)
""")
def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), id="doc_id", text="text", window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_ordinal_quality")
def op2_ordinal_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    graded = ordinal_quality.three_grades(table(spark, sf_dir, "labels"), quality="quality", toxic="toxic")
    model = ordinal_quality.fit(docs, graded, id="doc_id", text="text", grade="grade")
    found = ordinal_quality.grade_documents(docs, model, text="text", select=2)
    return found.select("doc_id", F.col("quality_grade").alias("expected_grade"),
                        F.col("quality_tail").alias("tail_probability"), F.col("quality_kept").alias("kept"))


@query("op3_suffix_tree_lm")
def op3_suffix_tree_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", suffix_tree_lm.held_out(docs.doc_id, 7, 2))
    tree = suffix_tree_lm.fit(docs.where("NOT held_out"), text="text")
    return suffix_tree_lm.score(docs, tree, text="text", keep=["doc_id", "held_out"])


@query("op4_length_buckets")
def op4_length_buckets(spark, sf_dir):
    return length_buckets.pack(table(spark, sf_dir, "documents"), id="doc_id", text="text",
                               tokens_per_batch=1 << 16, buckets=16)


@query("op5_line_frequency", sql=rf"""
    WITH d AS (
      SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    l AS (
      SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
    lw AS (
      SELECT doc_id, source, text, line,
             regexp_extract_all(translate(line, '{UPPER}0123456789', '{LOWER}0000000000'), '[^\x20\x09-\x0D]+') AS lws FROM l),
    kl AS (SELECT doc_id, source, text, line, len(lws) AS nw, array_to_string(lws, ' ') AS norm FROM lw WHERE len(lws) > 0),
    dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM kl GROUP BY doc_id),
    common AS (SELECT norm, source FROM kl GROUP BY norm, source HAVING count(DISTINCT text) > 50),
    gone AS (SELECT doc_id, sum(nw) AS gone FROM kl JOIN common ON kl.norm = common.norm AND kl.source IS NOT DISTINCT FROM common.source GROUP BY doc_id),
    win AS (
      SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM d WHERE len(ws) >= 3)),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
    rep AS (SELECT doc_id, count(DISTINCT p) AS n_rep FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
    f AS (
      SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(n_rep, 0) AS n_repeat_words, len(ws) - coalesce(gone, 0) AS words_left
      FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN gone USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, words_left, base_failed,
           NOT base_failed AND words_left >= 0.3::DOUBLE * n_words AS kept
    FROM b
""")
def op5_line_frequency(spark, sf_dir):
    return line_frequency.line_rules(table(spark, sf_dir, "documents"), id="doc_id", text="text",
                                     host="source", max_docs=50, min_left=0.3).drop("removed_lines")


@query("op6_lsh_forest", sql=rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(4, len(ws)) - 1], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - least(4, len(ws)) + 1)) AS i FROM d WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach AS (SELECT a AS doc_id, a AS low FROM link UNION SELECT link.b, reach.low FROM reach JOIN link ON link.a = reach.doc_id),
    comp AS (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.low, d.doc_id) AS component_id,
           d.doc_id = coalesce(comp.low, d.doc_id) AS kept
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
""")
def op6_lsh_forest(spark, sf_dir):
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), id="doc_id", text="text", shingle=4,
                                      similarity=0.8)


@query("op7_bitplanes")
def op7_bitplanes(spark, sf_dir):
    files = bitplanes.write_tokens(table(spark, sf_dir, "documents"), id="doc_id", text="text",
                                   tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    read = bitplanes.read_tokens(files, id="doc_id")
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@query("op8_language_spans")
def op8_language_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", suffix_tree_lm.held_out(docs.doc_id, 4, 2))
    model = language_spans.fit(docs.where("NOT held_out"), text="text", lang="lang")
    tagged = language_spans.label_spans(docs.select("doc_id", "held_out", "text"), model, text="text")
    return tagged.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query("op9_secret_forest")
def op9_secret_forest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = secret_forest.learn_lexicon(docs, text="text")
    forest = secret_forest.fit(secret_forest.find(docs, lexicon, text="text"))
    found = secret_forest.scan_secrets(docs, lexicon, forest, text="text")
    return found.select("doc_id", F.col("secret_candidates").alias("n_candidates"),
                        F.size("secret_spans").cast("long").alias("n_secrets"), F.col("secret_spans").alias("spans"),
                        F.sha2("text", 256).alias("redacted_sha256"))


@query("op10_prefix_join", sql=rf"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM documents),
    b AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM benchmark),
    bw AS (
      SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS win
      FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(10, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0)),
    sizes AS (SELECT DISTINCT n FROM bw),
    dw AS (
      SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
      FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM w, sizes WHERE len(ws) >= n)),
    hits AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw USING (win, n)),
    places AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits),
    per AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
    its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id)
""")
def op10_prefix_join(spark, sf_dir):
    found = prefix_join.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                      id="doc_id", text="text", item="item_id", item_text="text", window=10)
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def looped(docs: DataFrame) -> DataFrame:
    """The documents, where every tenth by crc32 of its id repeats its words from a place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def loop(ws):
        n, g = F.size(ws).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")
        said = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(ws, place(i))), " ")
        return F.when(n > 0, said)

    # one array of one array: the words are cut once for all places
    words = F.array(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    text = F.when(h % 10 == 0, F.coalesce(F.get(F.transform(words, loop), 0), F.col("text"))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query("op11_kruskal_runs", sql=r"""
    WITH d AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
             xor(list_reduce(list_concat([4294967295::BIGINT], [ord(x)::BIGINT for x in string_split(doc_id::VARCHAR, '')]),
               lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
                 lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS h FROM documents),
    e AS (SELECT doc_id, ws, h, len(ws) AS n, (h // 10) % nullif(len(ws), 0) AS a FROM d),
    f AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM e),
    w AS (
      SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE ws END AS ws FROM f),
    g AS (
      SELECT doc_id, i, array_to_string(ws[i + 1:i + 6], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(len(ws) - 5)) AS i FROM w WHERE len(ws) >= 6)),
    pairs AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM g x JOIN g y ON x.doc_id = y.doc_id AND x.g = y.g AND x.i < y.i),
    islands AS (
      SELECT doc_id, q, min(i) AS start, max(i) - min(i) + 6 + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
    runs AS (
      SELECT doc_id, start, length, min(q) AS period FROM islands
      WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
    listed AS (
      SELECT doc_id, count(*) AS n_runs, arg_min(struct_pack(s := start, l := length, q := period), (-length, start, period)) AS best,
             string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
      FROM runs GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS p FROM runs),
    left_words AS (
      SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept
      FROM (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) - 1 AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
           1000 * best.l // best.q AS exponent_milli, sha256(coalesce(said, '')) AS runs_sha256,
           sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM w LEFT JOIN listed USING (doc_id) LEFT JOIN left_words USING (doc_id)
""")
def op11_kruskal_runs(spark, sf_dir):
    found = kruskal_runs.collapse_runs(looped(table(spark, sf_dir, "documents")), id="doc_id", text="text", least=12)
    order = F.array_sort("runs", lambda x, y: F.when(x["length"] != y["length"], F.signum(y["length"] - x["length"]))
                         .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]))
                         .otherwise(F.signum(x["period"] - y["period"])).cast("int"))
    best = F.get(order, 0)
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                              r["period"].cast("string"), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


@query("op12_bitmap_tiles", sql=rf"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (
      SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - least(5, len(ws)) + 1)) AS i FROM d WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    reach AS (SELECT a AS doc_id, a AS low FROM link UNION SELECT link.b, reach.low FROM reach JOIN link ON link.a = reach.doc_id),
    comp AS (SELECT doc_id, min(low) AS low FROM reach GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.low, d.doc_id) AS component_id
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
""")
def op12_bitmap_tiles(spark, sf_dir):
    return bitmap_tiles.jaccard_classes(table(spark, sf_dir, "documents"), id="doc_id", text="text", shingle=5,
                                        similarity=0.8)


@query("op13_shared_lists", sql=r"""
    WITH r AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS other, list_dot_product(a.v, r.v)::BIGINT AS score
      FROM r a JOIN r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
    SELECT p.anchor_id, p.other AS positive_id,
           (row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other))::INTEGER AS rank,
           s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    QUALIFY rank <= 10
""")
def op13_shared_lists(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = rows.where(F.col("embedding").isNotNull() & ~odd).select(
        "vec_id", shifted.alias("label"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector"),
        (F.col("vec_id") % 100 == 0).alias("anchor"))
    return shared_lists.hard_negatives(rows, id="vec_id", vector="vector", label="label", anchor="anchor", positives=5,
                                       negatives=10, low=30, high=90)
