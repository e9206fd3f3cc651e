"""Readers: format dispatch, encoding ladder, headerless files, previews."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# File extension -> Spark source and its options.
FORMATS = {
    "csv": ("csv", {"header": "true"}),
    "txt": ("csv", {"header": "true", "sep": "\t"}),
    "tsv": ("csv", {"header": "true", "sep": "\t"}),
    "json": ("json", {}),
    "jsonl": ("json", {}),
    "parquet": ("parquet", {}),
    "orc": ("orc", {}),
}


def read_any(spark: SparkSession, path: str, fmt: str | None = None,
             schema: StructType | str | None = None, nrows: int | None = None,
             **options: str) -> DataFrame:
    """Read by explicit format or by extension; `nrows` limits the result.

    Text formats without a schema are inferred, which costs a pass over the
    files: give a schema for anything large.
    """
    key = (fmt or os.path.splitext(path)[1].lstrip(".")).lower()
    if key not in FORMATS:
        raise ValueError(f"unsupported format {key!r}; known: {sorted(FORMATS)}")
    source, defaults = FORMATS[key]
    reader = spark.read.format(source).options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    elif source == "csv":
        reader = reader.option("inferSchema", "true")
    df = reader.load(path)
    return df.limit(nrows) if nrows is not None else df


def pick_encoding(spark: SparkSession, path: str,
                  ladder: Sequence[str] = ("UTF-8", "ISO-8859-1")) -> str:
    """First encoding of the ladder under which every line decodes.

    The text source keeps raw bytes, so UTF-8 validity is one distributed scan;
    any other charset is accepted when decoding leaves no replacement character.
    """
    for encoding in ladder[:-1]:
        if encoding.upper() in ("UTF-8", "UTF8"):
            bad = spark.read.text(path).filter(~F.is_valid_utf8("value"))
        else:
            lines = spark.read.option("encoding", encoding).schema("value STRING") \
                .option("sep", "\x01").csv(path)
            bad = lines.filter(F.col("value").contains("�"))
        if bad.isEmpty():
            return encoding
    return ladder[-1]


def read_with_encoding(spark: SparkSession, path: str, schema: StructType | str | None = None,
                       ladder: Sequence[str] = ("UTF-8", "ISO-8859-1"),
                       **options: str) -> DataFrame:
    """CSV under the first encoding of the ladder that fits the whole file."""
    return read_any(spark, path, "csv", schema=schema,
                    encoding=pick_encoding(spark, path, ladder), **options)


def read_headerless(spark: SparkSession, path: str, schema: str, sep: str = ",",
                    null_token: str = "?", drop: Sequence[str] = ()) -> DataFrame:
    """Headerless delimited file with given columns; `null_token` means missing."""
    df = (spark.read.schema(schema)
          .options(header="false", sep=sep, nullValue=null_token,
                   ignoreLeadingWhiteSpace="true", ignoreTrailingWhiteSpace="true")
          .csv(path))
    return df.drop(*drop)


def normalise_column_names(df: DataFrame, sep: str = "_") -> DataFrame:
    """Strip column names and join their words with `sep`."""
    return df.toDF(*[sep.join(c.split()) for c in df.columns])


def sniff_text_label(df: DataFrame, left: str, right: str,
                     positive: Sequence[str] = ("1", "positive", "pos"),
                     negative: Sequence[str] = ("0", "negative", "neg"),
                     names: tuple[str, str] = ("positive", "negative"),
                     min_text: int = 5, short: int = 4, long: int = 10) -> DataFrame:
    """Decide per row which column holds the label; undecidable rows go.

    A 0/1 cell is the label; otherwise the side of at most `short` characters
    next to one longer than `long`.
    """
    a, b = F.trim(F.col(left)), F.trim(F.col(right))
    side = (
        F.when(a.isin("0", "1"), "left").when(b.isin("0", "1"), "right")
        .when((F.length(a) <= short) & (F.length(b) > long), "left")
        .when((F.length(b) <= short) & (F.length(a) > long), "right")
    )
    raw = F.when(F.col("__side") == "left", a).otherwise(b)
    text = F.when(F.col("__side") == "left", b).otherwise(a)
    label = F.when(raw.isin(*positive), names[0]).when(raw.isin(*negative), names[1]).otherwise(raw)
    return (df.withColumn("__side", side).filter(F.col("__side").isNotNull())
            .withColumn("text", text).withColumn("label", label)
            .filter(F.length("text") >= min_text).drop("__side", left, right))


def target_like(columns: Sequence[str], wanted: str) -> str | None:
    """Exact column, else the first one containing `wanted`, ignoring case."""
    if wanted in columns:
        return wanted
    return next((c for c in columns if wanted.lower() in c.lower()), None)


def ingest_gate(df: DataFrame, target: str, min_rows: int = 50, min_columns: int = 3,
                rows: int | None = None) -> dict:
    """Verdict on a new dataset: accepted or not, why, and the repaired target."""
    n = df.count() if rows is None else rows
    found = target_like(df.columns, target) if target else None
    reason = (
        "empty" if n == 0 else
        "too_few_rows" if n < min_rows else
        "too_few_columns" if len(df.columns) < min_columns else
        "target_missing" if target and found is None else "ok"
    )
    return {"accepted": reason == "ok", "reason": reason, "rows": n, "target": found}


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: position, type, nulls and exact distinct count, in one job.

    Columns become (position, value) rows that are pre-aggregated before the
    shuffle, so one very frequent value costs one row per task.
    """
    names = list(columns or df.columns)
    types = dict(df.dtypes)
    if not names:
        raise ValueError("no columns to profile")
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), short_value(as_text(df, c)).alias("value"))
        for i, c in enumerate(names)]))
    counted = (df.select(cells.alias("c")).select("c.pos", "c.value")
               .groupBy("pos", "value").agg(F.count(F.lit(1)).alias("n")))
    label = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(i), F.lit(c))])
    dtype = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(i), F.lit(types[c]))])
    return (counted.groupBy("pos")
            .agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
                 F.count("value").alias("uniques"), F.sum("n").alias("n_rows"))
            .select(label[F.col("pos")].alias("column_name"), dtype[F.col("pos")].alias("dtype"),
                    "nulls", "uniques", "n_rows", F.col("pos").alias("position")))


def short_value(value: Column) -> Column:
    """Value, or its digest when long: texts are told apart without shuffling them."""
    return F.when(F.length(value) > 40, F.sha1(F.encode(value, "UTF-8"))).otherwise(value)


def as_text(df: DataFrame, column: str) -> Column:
    """Cell as text; floating NaN is a missing value, nested cells become JSON."""
    dtype = dict(df.dtypes)[column]
    col = F.col(column)
    if dtype in ("double", "float"):
        return F.when(F.isnan(col), None).otherwise(col).cast("string")
    if dtype.startswith(("array", "map", "struct")):
        return F.to_json(col)
    return col.cast("string")


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> tuple[DataFrame, DataFrame]:
    """First `n` rows and per-column facts about just those rows."""
    head = df.orderBy(*order).limit(n)
    return head, column_stats(head)


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of non-null cells per column."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns with no value at all (one aggregate row is read back)."""
    present = null_counts(df).first().asDict()
    return df.drop(*[c for c in df.columns if present[c] == 0])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
