"""Writers: cleaned datasets, prediction exports, run history, class reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.readers import drop_all_null_columns


def clean(df: DataFrame, target: str | None = None) -> DataFrame:
    """Drop all-null columns and repeated rows, move the target last."""
    out = drop_all_null_columns(df).dropDuplicates()
    if target and target in out.columns:
        out = out.select(*[c for c in out.columns if c != target], target)
    return out


def clean_write(df: DataFrame, path: str, target: str | None = None) -> None:
    clean(df, target).write.option("header", "true").option("escape", '"').csv(path)


def append_run_history(df: DataFrame, path: str, partition: str) -> None:
    """Append per-epoch metric rows, one folder per value of `partition`."""
    df.write.mode("append").partitionBy(partition).parquet(path)


def predictions_wide(df: DataFrame, keep: Sequence[str], prediction: str, probabilities: str,
                     classes: Sequence[str], decimals: int = 4) -> DataFrame:
    """Original columns, prediction, confidence, and one column per class.

    `probabilities` is an array column ordered like `classes`, the model's own list.
    """
    return df.select(
        *keep, F.col(prediction).alias("prediction"),
        F.round(F.array_max(probabilities), decimals).alias("confidence"),
        *[F.round(F.col(probabilities)[i], decimals).alias(f"prob_{c}")
          for i, c in enumerate(classes)])


def predictions_json(df: DataFrame, keep: Sequence[str], prediction: str, probabilities: str,
                     classes: Sequence[str]) -> DataFrame:
    """One JSON document per row with prediction, confidence and probabilities."""
    pairs: list[Column] = []
    for i, c in enumerate(classes):
        pairs += [F.lit(str(c)), F.round(F.col(probabilities)[i], 4)]
    return df.select(F.to_json(F.struct(
        *keep, F.col(prediction).alias("_prediction"),
        F.round(F.array_max(probabilities), 4).alias("_confidence"),
        F.create_map(*pairs).alias("_probabilities"))).alias("document"))


def write_csv_bom(df: DataFrame, path: str) -> None:
    """CSV whose header starts with a byte-order mark, for spreadsheet tools."""
    first = df.columns[0]
    (df.withColumnRenamed(first, "﻿" + first)
     .write.option("header", "true").option("escape", '"').csv(path))


def class_report(df: DataFrame, by: str, measures: dict[str, Column]) -> DataFrame:
    """Summary row per class; the members stay in the class's own folder."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"),
                              *[c.alias(k) for k, c in measures.items()])


def write_nested_report(df: DataFrame, path: str, by: str, measures: dict[str, Column]) -> None:
    """Report as a folder: `summary` (one row per class) and `items/<class>`.

    The member list of a class can be any size, so it is written as partitioned
    JSON lines instead of one array.
    """
    class_report(df, by, measures).write.json(f"{path}/summary")
    df.write.partitionBy(by).json(f"{path}/items")
