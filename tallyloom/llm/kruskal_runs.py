"""Periodic runs of words, found by uniting suffix classes in descending order of common prefixes.

A run is a stretch of words with smallest period p (words p apart are identical), at least two
periods and `least` words long, that no neighbouring word extends. If positions i < j of a text have
a common prefix of L words and j - i <= L, the words i .. j + L have the period j - i.

1. Only positions whose next `gram` words (half of `least`) occur again in the same text can start
   such a pair; all others are left out.
2. Their suffixes are ranked by doubling, which gives the suffix order and the common prefixes (LCP)
   of suffixes next to each other in it.
3. Kruskal: these neighbours are edges; they are taken by descending LCP and unite classes of
   suffixes, each class an ordered set of positions, the smaller poured into the larger. Two
   positions of different classes that become adjacent have exactly this LCP in common; where
   their distance is not above it they seed a run, and no shorter period exists, since a
   position in between would have been united before.
4. Seeds of one period and one end are one run; the least of them is its start.

Every text is handled whole inside one task, in numpy for a piece of texts at a time; only
the unions are a Python loop over repeated positions. A text costs n log n.

Defined results: null and empty texts have no words and no runs; rows are independent, so
repeated rows give repeated results; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _candidates(h: np.ndarray, parts: tw.Words, gram: int) -> np.ndarray:
    """Words whose next `gram` words occur elsewhere in the same text, ascending."""
    at, row = tw.windows(parts, gram)
    if not len(at):
        return at
    g = tw.mix(tw.hash_runs(h, at, at + gram) + row.astype(np.uint64) * tw.MIX_A)
    order = np.argsort(g, kind="stable")
    same = g[order][1:] == g[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return at[twice]


def _ranks(columns: list[np.ndarray]) -> np.ndarray:
    """Rank of each row of the columns (first column first): how many rows are less."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    new[:1] = True
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return out


def suffix_edges(h: np.ndarray, parts: tw.Words, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with a common prefix of `gram` words or more: (a, b, prefix)."""
    none = np.zeros(0, np.int64)
    starts = _candidates(h, parts, gram)
    if not len(starts):
        return none, none, none
    n = len(h)
    end = parts.bounds[parts.row + 1]
    after = starts + gram
    known = np.union1d(starts, after[after < end[starts]])
    place = np.full(n + 1, -1, np.int64)
    place[known] = np.arange(len(known))
    last = end[known]
    columns = [parts.row[known].astype(np.uint64)]
    for j in range(gram):
        columns.append(np.where(known + j < last, h[np.minimum(known + j, n - 1)] | np.uint64(1), np.uint64(0)))
    rank = _ranks(columns)
    levels, length = [rank], gram
    while True:
        size = np.bincount(rank, minlength=len(known))
        open_ = np.flatnonzero(size[rank] > 1)
        if not len(open_):
            break
        to = known[open_] + length
        second = np.where(to < last[open_], place[np.minimum(to, n)], -1)
        second = np.where(second >= 0, rank[second], -1)
        first = rank[open_]
        order = np.lexsort((second, first))
        f, s = first[order], second[order]
        index = np.arange(len(order))
        head = np.ones(len(order), bool)
        head[1:] = f[1:] != f[:-1]
        part = head.copy()
        part[1:] |= s[1:] != s[:-1]
        base = np.maximum.accumulate(np.where(head, index, 0))
        rank = rank.copy()
        rank[open_[order]] = f + np.maximum.accumulate(np.where(part, index, 0)) - base
        levels.append(rank)
        length *= 2
    order = np.argsort(rank, kind="stable")
    pair = np.flatnonzero(levels[0][order][1:] == levels[0][order][:-1])
    a, b = known[order[pair]], known[order[pair + 1]]
    end_a, end_b = end[a], end[b]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ia = np.where(a + common < end_a, place[np.minimum(a + common, n)], -1)
        ib = np.where(b + common < end_b, place[np.minimum(b + common, n)], -1)
        same = (ia >= 0) & (ib >= 0) & (levels[k][ia] == levels[k][ib])
        common += np.where(same, gram << k, 0)
    open_ = np.ones(len(a), bool)
    for _ in range(gram - 1):
        to_a, to_b = a + common, b + common
        open_ &= (to_a < end_a) & (to_b < end_b)
        open_ &= h[np.minimum(to_a, n - 1)] == h[np.minimum(to_b, n - 1)]
        common += open_
    return a, b, common


def unite(a: list[int], b: list[int], common: list[int]) -> dict[tuple[int, int], int]:
    """{(period, end): start} of the seeds, for edges by descending common prefix."""
    home: dict[int, list[int]] = {}
    seeds: dict[tuple[int, int], int] = {}

    def seed(i: int, j: int, prefix: int) -> None:
        if j - i <= prefix:
            key = (j - i, j + prefix)
            if i < seeds.get(key, j):
                seeds[key] = i

    for x, y, prefix in zip(a, b, common):
        big, small = home.get(x) or [x], home.get(y) or [y]
        if len(big) < len(small):
            big, small = small, big
        before = -1
        for i, p in enumerate(small):
            at = bisect(big, p)
            if at and at != before:
                seed(big[at - 1], p, prefix)
            if at < len(big) and (i + 1 == len(small) or small[i + 1] > big[at]):
                seed(p, big[at], prefix)
            before = at
        if len(small) == 1:
            big.insert(at, small[0])
        else:
            big += small
            big.sort()
        for p in small:
            home[p] = big
        home[big[0]] = home[x] = home[y] = big
    return seeds


def runs_of(h: np.ndarray, parts: tw.Words, least: int) -> np.ndarray:
    """Rows of (start, length, period), by start and period; starts are word numbers of the piece."""
    a, b, common = suffix_edges(h, parts, -(-least // 2))
    order = np.argsort(-common, kind="stable")
    seeds = unite(a[order].tolist(), b[order].tolist(), common[order].tolist())
    found = [(start, end - start, period) for (period, end), start in seeds.items() if end - start >= least]
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def join_words(piece: tw.Texts, parts: tw.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one blank."""
    start, size, row = parts.start[keep], (parts.end - parts.start)[keep], parts.row[keep]
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    width = size + ~last
    to = np.cumsum(width) - width
    total = int(width.sum())
    source = np.repeat(start - to, width) + np.arange(total)
    out = np.append(piece.data, np.uint8(32))[source]
    out[(to + size)[~last]] = 32
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row, weights=width, minlength=len(piece)))]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(piece), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(out.tobytes())]) \
        .cast(pa.string())


def collapse_runs(docs: DataFrame, *, id: str, text: str, least: int = 12) -> DataFrame:
    """One row per row of `docs`: id, n_words, runs (start, length, period, by start and period; words numbered
    from 0) and collapsed_text, the words left, joined by blanks, when of each run only the first
    period stays (a word that any run drops is dropped)."""
    if least < 2:
        raise ValueError("a run has two words at least")
    kind = docs.select(id).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(1))):
                parts = tw.split(piece)
                found = runs_of(tw.hash_spans(piece.data, parts.start, parts.end), parts, least)
                start, length, period = found.T
                gone = tw.cover(len(parts.start), start + period, length - period)
                row = parts.row[start]
                bounds = np.searchsorted(row, np.arange(len(piece) + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(
                    [pa.array(start - parts.bounds[row]), pa.array(length), pa.array(period)], fields=list(RUN)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array(parts.counts()), listed,
                     join_words(piece, parts, ~gone)], ["id", "n_words", "runs", "collapsed_text"])

    out = rows.mapInArrow(scan, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                "collapsed_text string")
    return out.withColumnRenamed("id", id)
