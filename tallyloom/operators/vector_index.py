"""A neighbour index: coarse cells with quantised residuals, and exact re-ranking.

Every row lies in the cell of its nearest centre. What is left after the centre is cut into `parts`
slices of a few dimensions, and each slice is stored as the number (one byte) of its nearest codeword,
so the index holds `parts` bytes a row. A query reads the `probes` cells with the nearest centres, adds
up tabulated slice distances, and keeps its `rerank` best rows; their real vectors give exact
distances. Centres and codewords are fitted on a bounded sample of rows (`sample`, by hash of the key);
every row is indexed. With `group`, each query sees the rows of its own group only.

The work of a query is linear in the rows of its cells, which are a share of all rows; what share a
recall needs depends on how far the rows cluster. The k results of a query are its true nearest
neighbours up to that recall, with true distances, ties by candidate key.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators import knn
from tallyloom.session import cut_lineage

MAX_CELLS, WORDS = 1024, 256
# index rows in a block, and queries that meet it at once
BLOCK_ROWS, LOT_ROWS = 65_536, 1024


def lloyd(rows: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """k-means centres of a bounded sample; an empty centre stays where it is."""
    distinct = np.unique(rows, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = nearest_of(rows, centres)
        size = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest_of(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None, :] - 2.0 * (rows @ centres.T)).argmin(1)


def slices(width: int, parts: int) -> list[slice]:
    edges = np.linspace(0, width, parts + 1).round().astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


@dataclass
class VectorIndex:
    """The index table (grp, cell, block, id, code), the vectors (id, v) and the fitted tables."""

    codes: DataFrame
    vectors: DataFrame
    sizes: DataFrame
    centres: np.ndarray
    words: list[np.ndarray]
    metric: str

    @property
    def cells(self) -> int:
        return len(self.centres)


def build(df: DataFrame, key: str, vec: str, metric: str = "euclidean", group: str | None = None, parts: int = 16,
          sample: int = 16_384, cells: int | None = None, block_rows: int = BLOCK_ROWS, seed: int = 42) -> VectorIndex:
    """Index the rows of `df` by whole-number keys; null vectors take no part."""
    spark = df.sparkSession
    grp = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    rows = knn.as_double(df.where(F.col(vec).isNotNull()).withColumn("__g", grp), key, vec, metric, keep={"grp": "__g"})
    vectors = cut_lineage(rows, "vectors")
    total = vectors.count()
    if total == 0:
        raise ValueError("no vectors to index")
    picked = vectors.orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample).select("v").toPandas()
    known = knn.matrix(picked["v"])
    centres = lloyd(known, cells or int(min(MAX_CELLS, max(1, round(2 * total ** 0.5)))), 6, seed)
    parts = min(parts, known.shape[1])
    cuts = slices(known.shape[1], parts)
    rest = known - centres[nearest_of(known, centres)]
    words = [lloyd(rest[:, c], WORDS, 6, seed + i) for i, c in enumerate(cuts)]
    shared = spark.sparkContext.broadcast((centres, words, cuts))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, words, cuts = shared.value
        for pdf in batches:
            if not len(pdf):
                continue
            v = knn.matrix(pdf["v"])
            cell = nearest_of(v, centres)
            left = v - centres[cell]
            code = np.stack([nearest_of(left[:, c], w) for c, w in zip(cuts, words)], axis=1).astype(np.uint8)
            yield pd.DataFrame({"grp": pdf["grp"], "cell": cell.astype("int32"), "id": pdf["id"],
                                "code": [c.tobytes() for c in code]})

    kind = vectors.schema["id"].dataType.simpleString()
    coded = cut_lineage(vectors.mapInPandas(encode, f"grp string, cell int, id {kind}, code binary"), "codes")
    sizes = coded.groupBy("grp").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("blocks"))
    sizes = cut_lineage(sizes, "sizes")
    coded = coded.join(sizes, "grp").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks")
    return VectorIndex(coded, vectors.select("id", "v"), sizes, centres, words, metric)


def search(index: VectorIndex, queries: DataFrame, key: str, vec: str, k: int, probes: int, rerank: int | None = None,
           group: str | None = None, exclude_self: bool = False, block_rows: int = LOT_ROWS) -> DataFrame:
    """(query_id, candidate_id, distance, place): the k nearest rows found in the `probes` nearest cells.

    A block holds a share of every cell, so a query travels once for each block and not for each cell, and
    keeps `rerank` rows of a block."""
    spark = queries.sparkSession
    keep = rerank or max(100, 20 * k)
    if keep < k or probes < 1:
        raise ValueError("rerank is at least k, and one cell at least is probed")
    centres, words = index.centres, index.words
    cuts = slices(centres.shape[1], len(words))
    shared = spark.sparkContext.broadcast((centres, words, cuts))
    grp = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    asked = knn.as_double(queries.where(F.col(vec).isNotNull()).withColumn("__g", grp), key, vec, index.metric, keep={"grp": "__g"})
    asked = cut_lineage(asked, "queries")
    kind = asked.schema["id"].dataType.simpleString()

    lots = asked.groupBy("grp").agg(F.ceil(F.count("*") / block_rows).cast("long").alias("lots"))
    lots = cut_lineage(lots, "lots")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = asked.join(lots, "grp").join(index.sizes, "grp").withColumn("lot", F.pmod(F.xxhash64("id"), F.col("lots"))) \
        .withColumn("block", every("blocks")).select("grp", "block", "lot", "id", "v")
    right = index.codes.join(lots.select("grp", F.col("lots").alias("n")), "grp") \
        .withColumn("lot", every("n")).select("grp", "block", "lot", "cell", "id", "code")

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame()
        centres, words, cuts = shared.value
        c = c.sort_values(["cell", "id"], kind="stable")
        code = np.frombuffer(b"".join(c["code"]), np.uint8).reshape(len(c), len(words))
        v, ids, own, cell = knn.matrix(q["v"]), c["id"].to_numpy(), q["id"].to_numpy(), c["cell"].to_numpy()
        gap = (centres * centres).sum(1)[None, :] - 2.0 * (v @ centres.T)
        visited = np.zeros(gap.shape, bool)
        np.put_along_axis(visited, np.argsort(gap, axis=1, kind="stable")[:, :probes], True, axis=1)
        # |q - centre - word|² in three parts: of the query and the cell, of the row, and of the query and the words
        near = gap + (v * v).sum(1)[:, None]
        row, dots = np.zeros(len(c)), []
        for j, (cut, word) in enumerate(zip(cuts, words)):
            row += ((word * word).sum(1)[None, :] + 2.0 * (centres[:, cut] @ word.T))[cell, code[:, j]]
            dots.append(2.0 * (v[:, cut] @ word.T))
        guess, place = np.full((len(v), keep), np.inf), np.zeros((len(v), keep), np.int64)
        edges = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(c)]])
        for start, end in zip(edges[:-1], edges[1:]):
            who = np.flatnonzero(visited[:, cell[start]])
            step = max(1, (1 << 21) // (end - start))
            for some in (who[i:i + step] for i in range(0, len(who), step)):
                far = near[some, cell[start]][:, None] + row[start:end][None, :]
                for j, table in enumerate(dots):
                    far -= table[some[:, None], code[None, start:end, j]]
                if exclude_self:
                    far[own[some, None] == ids[None, start:end]] = np.inf
                far = np.concatenate([guess[some], far], axis=1)
                at = np.concatenate([place[some], np.broadcast_to(np.arange(start, end), (len(some), end - start))], axis=1)
                kept = np.argpartition(far, keep - 1, axis=1)[:, :keep]
                guess[some], place[some] = np.take_along_axis(far, kept, 1), np.take_along_axis(at, kept, 1)
        r, i = np.nonzero(np.isfinite(guess))
        return pd.DataFrame({"query_id": own[r], "candidate_id": ids[place[r, i]], "guess": guess[r, i]})

    on = ["grp", "block", "lot"]
    found = left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(best, f"query_id {kind}, candidate_id {kind}, guess double")
    rank = W.partitionBy("query_id").orderBy("guess", "candidate_id")
    short = found.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= keep).select("query_id", "candidate_id")
    exact = short.join(index.vectors.select(F.col("id").alias("candidate_id"), F.col("v").alias("cv")), "candidate_id") \
        .join(asked.select(F.col("id").alias("query_id"), F.col("v").alias("qv")), "query_id")
    gap = F.sqrt(F.aggregate(F.zip_with("qv", "cv", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    place = W.partitionBy("query_id").orderBy("distance", "candidate_id")
    return exact.select("query_id", "candidate_id", gap.alias("distance")).withColumn("place", F.row_number().over(place)) \
        .where(F.col("place") <= k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact (query_id, candidate_id) pairs that were found."""
    pairs = exact.select("query_id", "candidate_id").join(
        found.select("query_id", "candidate_id", F.lit(1).alias("hit")), ["query_id", "candidate_id"], "left")
    return pairs.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
