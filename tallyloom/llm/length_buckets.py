"""Packing by optimal length buckets.

Lengths (words of a text, at least 1) are counted in a global histogram: exact up to 128, then in
64 steps per doubling, so it has a few thousand bins whatever the data. Dynamic programming over
the histogram chooses the bucket bounds that minimise the total padding. Inside a bucket
documents are put in a hashed order; a batch takes as many as fit the token budget at
the bucket's bound, so all rows of a batch are padded to one length.

Places in a bucket come from counts of hash slices plus ranks inside a slice: no window holds
more than about `slice_rows` rows however many documents share a length, and only the last batch of a
bucket is not full.

Defined results: null and empty texts have no words and are packed at length 1; a document longer
than the budget has a batch of its own; repeated rows each have a place; an empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import cut_lineage

STEPS = 64


def count_words(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(id, n_words) of each row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [tw.split(p).counts() for p in tw.pieces(tw.texts_of(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *n]))],
                                             ["id", "n_words"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, f"id {rows.schema['id'].dataType.simpleString()}, n_words long")


def _bin(length: Column) -> Column:
    """Upper end of the histogram bin of a length."""
    doublings = F.length(F.bin(length)) - 1
    step = F.pow(F.lit(2.0), F.greatest(doublings - STEPS.bit_length() + 1, F.lit(0))).cast("long")
    return F.floor((length + step - 1) / step).cast("long") * step


def best_bounds(longest: np.ndarray, n: np.ndarray, total: np.ndarray, buckets: int) -> list[int]:
    """Bounds (ascending, at most `buckets`) with the least padding for bins given by their longest
    length, number of documents and sum of lengths."""
    m = len(n)
    if not m:
        return []
    counts, sums = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(total)])
    # padding when bins i..j-1 share the bound of bin j-1
    cost = longest[None, :] * (counts[None, 1:] - counts[:-1, None]) - (sums[None, 1:] - sums[:-1, None])
    cost = np.where(np.arange(m)[:, None] <= np.arange(m)[None, :], cost.astype(float), np.inf)
    best = np.concatenate([[0.0], np.full(m, np.inf)])
    came = []
    for _ in range(min(buckets, m)):
        through = best[:m, None] + cost
        at = through.argmin(0)
        best = np.concatenate([[np.inf], through[at, np.arange(m)]])
        came.append((at, best[m]))
    k = int(np.argmin([c for _, c in came]))
    out, j = [], m
    while j > 0:
        out.append(int(longest[j - 1]))
        j = int(came[k][0][j - 1])
        k -= 1
    return out[::-1]


def pack(docs: DataFrame, *, id: str, text: str, tokens_per_batch: int = 1 << 16, buckets: int = 16,
         slice_rows: int = 50_000) -> DataFrame:
    """One row per document: id, n_words, bucket, bucket_length, batch (in the bucket), slot and padding."""
    if tokens_per_batch < 1 or not 1 <= buckets <= 256:
        raise ValueError("tokens_per_batch is positive, buckets is 1 to 256")
    rows = cut_lineage(count_words(docs, id, text).withColumn("row", F.monotonically_increasing_id())
                       .withColumn("length", F.greatest("n_words", F.lit(1))), "lengths")
    bins = rows.groupBy(_bin(F.col("length")).alias("bin")).agg(
        F.max("length").alias("longest"), F.count("*").alias("n"), F.sum("length").alias("total")).collect()
    bins.sort(key=lambda r: r["bin"])
    side = lambda name: np.array([r[name] for r in bins], np.int64)
    bounds = best_bounds(side("longest"), side("n"), side("total"), buckets)
    limits = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    slices = max(1, -(-sum(r["n"] for r in bins) // slice_rows))
    placed = rows.withColumn("bucket", F.size(F.filter(limits, lambda b: b < F.col("length")))) \
        .withColumn("order", F.xxhash64("id", "row")) \
        .withColumn("slice", F.floor(F.shiftrightunsigned("order", 33) * F.lit(slices) / F.lit(2**31)).cast("long"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n")).select(
        "bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("bucket", "slice").orderBy("order", "row")
    place = F.col("first") + F.col("rank") - 1
    bound = F.element_at(limits, F.col("bucket") + 1) if bounds else F.lit(1).cast("long")
    # the slice order of an unsigned hash is that of its high bits
    return placed.withColumn("rank", F.row_number().over(inside)).join(starts, ["bucket", "slice"]) \
        .withColumn("bucket_length", bound).withColumn("place", place) \
        .withColumn("per_batch", F.greatest(F.lit(1), F.floor(F.lit(tokens_per_batch) / F.col("bucket_length")))) \
        .select(F.col("id").alias(id), "n_words", "bucket", "bucket_length",
                F.floor(F.col("place") / F.col("per_batch")).cast("long").alias("batch"),
                (F.col("place") % F.col("per_batch")).cast("long").alias("slot"),
                (F.col("bucket_length") - F.col("length")).alias("padding"))
