"""Feature preparation: imputing, encoding, scaling, exact TF-IDF, vectors.

Every fit returns either Columns of an aggregate or a small table, so statistics
from a training split can be applied to any other split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.ordered import with_row
from tallyloom.operators.profile import missing
from tallyloom.session import cut_lineage

# What imputing writes into an unknown category, and the labels
# infinite targets get before encoding.
MISSING = "missing"
INF_LABELS = {"pos": "inf", "neg": "-inf"}


# ------------------------------------------------------------------ imputing

def fit_means(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of the present values per column."""
    return train.agg(*[F.avg(F.when(~missing(train, c), F.col(c))).alias(c) for c in columns])


def impute_mean(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Fill missing numbers with the training means."""
    means = fit_means(df if train is None else train, columns).toDF(*[f"{c}__mean" for c in columns])
    filled = {c: F.when(missing(df, c), F.col(f"{c}__mean")).otherwise(F.col(c)) for c in columns}
    return with_row(df, means).withColumns(filled).drop(*means.columns)


def fit_modes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n): the most frequent value, the lowest on ties."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                                for c in columns]))
    counted = (train.select(cells.alias("c")).select("c.*").filter(F.col("value").isNotNull())
               .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("value")))
    return (counted.groupBy("column_name").agg(best.alias("b"))
            .select("column_name", F.col("b.value").alias("value"), (-F.col("b.m")).alias("n")))


def impute_mode(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    modes = fit_modes(df if train is None else train, columns)
    return df.withColumns({
        c: F.coalesce(F.col(c), modes.filter(F.col("column_name") == c).select("value").scalar())
        for c in columns})


def impute_constant(df: DataFrame, columns: Sequence[str], value: str = MISSING) -> DataFrame:
    return df.fillna(value, subset=list(columns))


# ------------------------------------------------------------------ encoding

def label_codes(train: DataFrame, column: str) -> DataFrame:
    """(label, code): alphabetical codes from 0 for the labels seen in training."""
    labels = train.filter(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("label")).distinct()
    coded = ranked_text(labels, "label")
    return coded.select("label", (F.col("rn") - 1).cast("int").alias("code"))


def ranked_text(labels: DataFrame, column: str) -> DataFrame:
    """Rank `rn` of distinct strings in byte order: ranges of them are sorted side
    by side and written, and each range starts where the counts before it end."""
    placed = cut_lineage(labels.repartitionByRange(column).sortWithinPartitions(column)
                         .withColumn("__id", F.monotonically_increasing_id()), "ranks")
    part = F.shiftright("__id", 33)
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    starts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n")) \
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    return placed.withColumn("__part", part).join(starts, "__part") \
        .withColumn("rn", F.col("__first") + F.col("__id").bitwiseAND((1 << 33) - 1) + 1) \
        .drop("__id", "__part", "__first")


def label_encode(df: DataFrame, column: str, alias: str, codes: DataFrame) -> DataFrame:
    """Codes of a fitted table; labels unseen in training take the first class."""
    seen = codes.select(F.col("label").alias("__label"), F.col("code").alias("__code"))
    return (df.join(seen, F.col(column).cast("string") == F.col("__label"), "left")
            .withColumn(alias, F.coalesce("__code", F.lit(0))).drop("__label", "__code"))


def alphabetical_codes(df: DataFrame, column: str, alias: str) -> DataFrame:
    return label_encode(df, column, alias, label_codes(df, column))


def label_decode(df: DataFrame, code: str, alias: str, codes: DataFrame) -> DataFrame:
    names = codes.select(F.col("code").alias("__code"), F.col("label").alias(alias))
    return df.join(names, F.col(code) == F.col("__code"), "left").drop("__code")


# ------------------------------------------------------------------- scaling

def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population deviation per column; a constant scales by 1."""
    stats = []
    for c in columns:
        sd = F.stddev_pop(c)
        stats += [F.avg(c).alias(f"{c}__mean"), F.when(sd == 0, 1.0).otherwise(sd).alias(f"{c}__sd")]
    return train.agg(*stats)


def standardise(df: DataFrame, columns: Sequence[str], scaler: DataFrame) -> DataFrame:
    scaled = {c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__sd") for c in columns}
    return with_row(df, scaler).withColumns(scaled).drop(*scaler.columns)


def inverse_standardise(df: DataFrame, columns: Sequence[str], scaler: DataFrame) -> DataFrame:
    back = {c: F.col(c) * F.col(f"{c}__sd") + F.col(f"{c}__mean") for c in columns}
    return with_row(df, scaler).withColumns(back).drop(*scaler.columns)


# -------------------------------------------------------------------- tf-idf

def term_counts(docs: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, tf): combined before the shuffle, so a frequent term is cheap."""
    return (docs.select(key, F.explode(tokens).alias("term"))
            .groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf")))


def fit_tfidf(counts: DataFrame, n_docs: Column | int, max_features: int | None = None, min_df: int = 2,
              max_df: float = 0.9) -> DataFrame:
    """(term, df, total, idf, code): terms within the document-frequency band,
    of these the `max_features` most used if a number is given, ties alphabetical."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    terms = (counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
             .filter((F.col("df") >= min_df) & (F.col("df") <= n * max_df)))
    top = terms if max_features is None else terms.orderBy(F.desc("total"), "term").limit(max_features)
    return top.select("term", "df", "total",
                      (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def apply_tfidf(counts: DataFrame, key: str, vocabulary: DataFrame) -> DataFrame:
    """(key, term, weight): (1 + ln tf) · idf, scaled to unit length per row: a row's
    terms meet once, and its norm is taken over the array."""
    w = (counts.join(vocabulary.select("term", "idf"), "term")
         .withColumn("raw", (1.0 + F.log("tf")) * F.col("idf")))
    rows = w.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("__norm"),
                              F.collect_list(F.struct("term", "raw")).alias("__terms"))
    return (rows.select(key, "__norm", F.explode("__terms").alias("t"))
            .select(key, "t.term", (F.col("t.raw") / F.col("__norm")).alias("weight")))


def nnz_check(docs: DataFrame, key: str, tokens: Column, vocabulary: DataFrame) -> DataFrame:
    """Distinct vocabulary terms per text: none is unreliable, under 3 is weak."""
    matched = (docs.select(key, F.explode(F.array_distinct(tokens)).alias("term"))
               .join(vocabulary.select("term"), "term", "left_semi")
               .groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")))
    n = F.coalesce("__n", F.lit(0))
    return (docs.select(key).join(matched, F.col(key) == F.col("__key"), "left")
            .select(key, n.alias("nnz"),
                    F.when(n == 0, "unreliable").when(n < 3, "weak").otherwise("ok").alias("reliability")))


# ------------------------------------------------------------------- vectors

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, x: s + x)


def l2_normalise(vec: Column) -> Column:
    """Unit length; a zero vector stays as it is. Pass a plain column: the norm
    is computed once per row."""
    norm = F.sqrt(dot(vec, vec))
    # the norm travels as a one-element array so the lambda does not recompute it
    return F.flatten(F.transform(F.array(norm), lambda n: F.transform(
        vec, lambda x: F.when(n == 0, x.cast("double")).otherwise(x.cast("double") / n))))


def pad_or_truncate(vec: Column, size: int) -> Column:
    zero = F.array_repeat(F.lit(0.0), size)
    return F.slice(F.concat(F.transform(vec, lambda x: x.cast("double")), zero), 1, size)


def cosine(a: Column, b: Column) -> Column:
    raw = dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw))


def match_level(similarity: Column) -> Column:
    return (F.when(similarity >= 0.99, "identical").when(similarity >= 0.90, "high")
            .when(similarity >= 0.70, "medium").when(similarity >= 0.50, "low").otherwise("none"))


def score_linear(features: Sequence[str], weights: Sequence[float], intercept: float) -> tuple[Column, Column]:
    """(margin, sigmoid) of given coefficients over plain columns."""
    z = F.lit(float(intercept))
    for c, w in zip(features, weights, strict=True):
        z = z + F.col(c) * F.lit(float(w))
    return z, 1.0 / (1.0 + F.exp(-z))
