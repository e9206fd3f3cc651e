"""Quality grades by ordinal cumulative-link regression on hashed text.

A text's features are present or absent: its letter words (A-Z folded), the last three bytes
of its blank-separated tokens, and the share, in tenths, of tokens in capitals, of tokens that are mostly
signs, and of tokens equal to the one before; all are hashed to `buckets` places. One weight vector w is shared by all grades; ordered thresholds
cut the score: P(grade <= k) = sigmoid(threshold_k - w x). The expected grade and the tail
probability P(grade >= g) follow, and texts are selected by the latter.

The model is fitted on a bounded sample of the labelled rows, `max_rows` (default 20 000) by hash
order of their id. Only features whose presence depends on the grade get a weight: those seen twice whose
likelihood-ratio statistic over the sample is significant at `level` (or at least `least_gain`, if given). Words of
two or three texts of a rare grade reach that in tables of any size.
Every document is scored, over its whole text.

Defined results: rows without a grade or text are not learnt from; texts without words and null texts
have grade 0, tail 0 and are not kept; labels with one grade only, or none, give that
grade (or 0) to every text with words, tail 1 and kept; repeated rows each give a row; an empty
table gives no rows. Input columns pass through unchanged; one named like an added column is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import cut_lineage

LETTERS = np.ones(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = False
KINDS = np.array([2, 3, 5, 7, 11], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Weights by bucket, ascending thresholds, and the grades they separate."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[int]


def features(piece: tw.Texts, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each text, text after text, and their bounds."""
    words, tokens = tw.split(piece, LETTERS), tw.split(piece)
    data = piece.data
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    letter = np.concatenate([[0], np.cumsum(~LETTERS[data])])
    size = tokens.end - tokens.start
    caps = (upper[tokens.end] - upper[tokens.start]) > 1
    caps &= (upper[tokens.end] - upper[tokens.start]) == (letter[tokens.end] - letter[tokens.start])
    symbols = (letter[tokens.end] - letter[tokens.start]) * 2 < size
    whole = tw.hash_spans(data, tokens.start, tokens.end)
    again = np.zeros(len(whole), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (tokens.row[1:] == tokens.row[:-1])
    n = tokens.counts()
    some = np.flatnonzero(n)
    parts = [
        (tw.hash_spans(data, words.start, words.end, tw.LOWER) ^ KINDS[0], words.row),
        (tw.hash_spans(data, np.maximum(tokens.start, tokens.end - 3), tokens.end) ^ KINDS[1], tokens.row),
    ]
    for kind, flags in zip(KINDS[2:], (caps, symbols, again)):
        tenths = -(-10 * np.bincount(tokens.row[flags], minlength=len(piece))[some] // n[some])
        parts.append((tenths.astype(np.uint64) + kind, some))
    bucket = np.concatenate([tw.mix(h) % np.uint64(buckets) for h, _ in parts]).astype(np.int64)
    key = np.unique(np.concatenate([r for _, r in parts]) * buckets + bucket)
    return key % buckets, np.searchsorted(key // buckets, np.arange(len(piece) + 1))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def dependence(seen: np.ndarray, per_grade: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of each feature's presence against the grades; `seen` counts
    texts by feature (rows) and grade."""
    total, n = seen.sum(1, keepdims=True), per_grade.sum()
    out = np.zeros(len(seen))
    for found, share in ((seen, total / n), (per_grade - seen, 1 - total / n)):
        expected = share * per_grade
        out += 2 * (found * np.log(np.maximum(found, 1e-12) / np.maximum(expected, 1e-12))).sum(1)
    return out


def critical(level: float, free: int) -> float:
    """Value a chi-square variable of `free` degrees exceeds with the chance `level` (Wilson and Hilferty)."""
    part = 2 / (9 * free)
    return free * max(0.0, 1 - part + NormalDist().inv_cdf(1 - level) * part**0.5) ** 3


def fit_arrays(bucket: np.ndarray, bounds: np.ndarray, grade: np.ndarray, buckets: int, steps: int, rate: float,
               shrink: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds for grades 0..k-1, by adaptive gradient steps over all rows."""
    n = len(grade)
    k = int(grade.max()) + 1
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
    used, place = np.unique(bucket, return_inverse=True)
    w = np.zeros(len(used))
    share = np.clip(np.cumsum(np.bincount(grade, minlength=k))[:-1] / n, 1e-4, 1 - 1e-4)
    cuts = np.log(share / (1 - share))
    # thresholds stay ordered as a first cut and logs of the gaps
    t = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    m1, m2 = np.zeros(len(w) + len(t)), np.zeros(len(w) + len(t))
    for step in range(1, steps + 1):
        cuts = np.concatenate([[-np.inf], np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])), [np.inf]])
        x = np.bincount(row, w[place], n)
        low, high = _sigmoid(cuts[grade] - x), _sigmoid(cuts[grade + 1] - x)
        p = np.maximum(high - low, 1e-9)
        d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
        d_x = (d_high - d_low) / n
        d_w = np.bincount(place, d_x[row], len(w)) + shrink * w
        d_cut = np.zeros(k + 1)
        np.add.at(d_cut, grade, d_low / n)
        np.add.at(d_cut, grade + 1, -d_high / n)
        d_cut = d_cut[1:k]
        tail = np.cumsum(d_cut[::-1])[::-1]
        d_t = np.concatenate([tail[:1], tail[1:] * np.exp(t[1:])])
        g = np.concatenate([d_w, d_t])
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        move = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w -= move[:len(w)]
        t -= move[len(w):]
    weights = np.zeros(buckets)
    weights[used] = w
    return weights, np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))


def fit(docs: DataFrame, graded: DataFrame, *, id: str, text: str, grade: str, max_rows: int = 20_000,
        buckets: int = 1 << 18, least_gain: float | None = None, level: float = 0.01, steps: int = 300, rate: float = 0.1,
        shrink: float = 2e-3) -> Model:
    """Fit on at most `max_rows` rows of `graded` (id, whole-number grade) with a text in `docs`."""
    sample = graded.where(F.col(id).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(id).alias("_id")).agg(
        F.min(F.col(grade).cast("int")).alias("_grade")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.where(F.col(text).isNotNull()).select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text")) \
        .join(F.broadcast(sample), "_id").select("_grade", "_text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(1))):
                bucket, bounds = features(piece, buckets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(bucket, pa.int32()))],
                    ["grade", "buckets"])

    sampled = cut_lineage(rows.mapInArrow(scan, "grade int, buckets array<int>"), "sample")
    per_grade = {r["grade"]: r["n"] for r in sampled.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    names = sorted(per_grade)
    if len(names) < 2:
        return Model(np.zeros(buckets), np.zeros(0), names or [0])
    order = {g: i for i, g in enumerate(names)}
    counts = sampled.select("grade", F.explode("buckets").alias("bucket")).groupBy("bucket", "grade").agg(
        F.count("*").alias("n")).toArrow()
    seen = np.zeros((buckets, len(names)))
    seen[counts.column("bucket").to_numpy(), [order[g] for g in counts.column("grade").to_pylist()]] = counts.column("n").to_numpy()
    if least_gain is None:
        least_gain = critical(level, len(names) - 1)
    kept = np.flatnonzero((dependence(seen, np.array([per_grade[g] for g in names], float)) >= least_gain) & (seen.sum(1) > 1))

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            own = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            flat = lists.flatten().to_numpy()
            good = np.isin(flat, kept)
            bounds = np.searchsorted(own[good], np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat[good], pa.int32()))],
                ["grade", "buckets"])

    found = sampled.mapInArrow(narrow, "grade int, buckets array<int>").toArrow().combine_chunks()
    lists = found.column("buckets").combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    grade_of = np.array([order[g] for g in found.column("grade").to_pylist()])
    weights, cuts = fit_arrays(lists.flatten().to_numpy(), bounds, grade_of, buckets, steps, rate, shrink)
    return Model(weights, cuts, names)


def grade_documents(docs: DataFrame, model: Model, *, text: str, select: int, least_tail: float = 0.5,
                    name: str = "quality") -> DataFrame:
    """All columns of `docs` with `<name>_grade` (expected), `<name>_tail` (P(grade >= select)) and `<name>_kept`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = tw.place_of(docs, text)
    tw.refuse_names(docs, f"{name}_grade", f"{name}_tail", f"{name}_kept")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        grades = np.array(model.grades, float)
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(place).cast(pa.string()))):
                n = len(piece)
                bucket, bounds = features(piece, len(model.weights))
                row = np.repeat(np.arange(n), np.diff(bounds))
                x = np.bincount(row, model.weights[bucket], n)
                below = np.concatenate([np.zeros((n, 1)), _sigmoid(model.thresholds[None, :] - x[:, None]), np.ones((n, 1))], 1)
                p = np.diff(below, axis=1)
                expected, tail = p @ grades, p[:, grades >= select].sum(1)
                if len(grades) < 2:
                    tail[:] = 1
                some = np.diff(bounds) > 0
                expected, tail = np.where(some, expected, 0), np.where(some, tail, 0)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(piece.first, n) for c in batch.columns), pa.array(expected), pa.array(tail),
                     pa.array(some & (tail >= least_tail))],
                    [*batch.schema.names, f"{name}_grade", f"{name}_tail", f"{name}_kept"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{own}, `{name}_grade` double, `{name}_tail` double, `{name}_kept` boolean")


def three_grades(labels: DataFrame, *, quality: str, toxic: str) -> DataFrame:
    """`labels` with a column `grade`: 0 toxic, 1 poor, 2 good; null where neither label says so."""
    grade = F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(
        (F.col(quality) == 1) & F.col(toxic).isNotNull(), 2)
    return labels.withColumn("grade", grade)
