"""Benchmark decontamination as a prefix-filtered set join.

A window is `window` consecutive words of a benchmark item (a shorter item is one
window). Seen as a set of shingles, a window lies in a document only if all its
shingles do, so one of them, the rarest in the documents, is the whole prefix that
has to be joined. A document shingle equal to a window's prefix fixes where the
window would start; bounds on position and length drop starts outside the document;
the rest is verified word by word.

The benchmark's windows are the stated query set: they are cut into blocks of
`block_windows`, each block goes to the tasks as sorted arrays, and every document
passes through all blocks without a shuffle. Nothing of the documents leaves its task
but the counts of benchmark shingles.

Defined results: null text has no words; null item ids give hits but no item;
items of the same id are one item; repeated documents each give a row; an empty
benchmark or table gives rows without hits, or no rows. Only the named columns are
read, so extra columns of any name pass through; for `mark`, one named like an added column is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import cut_lineage

# words: letters a-z and digits after folding A-Z, and everything beyond ASCII
BREAKS = np.ones(256, bool)
BREAKS[48:58] = BREAKS[65:91] = BREAKS[97:123] = BREAKS[128:] = False
SHINGLE = 3
HITS = "array<int>"
ITEMS = "array<string>"


def item_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """One row per distinct window: its words joined by blanks, n_words and its items."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, out, sizes = batch.column(0).to_pylist(), [], []
            texts = tw.texts_of(batch.column(1))
            owner = []
            for row in range(len(texts)):
                body = tw.LOWER[np.frombuffer(texts.bytes_of(row), np.uint8)]
                found = np.where(BREAKS[body], np.uint8(32), body).tobytes().split()
                n = min(window, len(found))
                for at in range(len(found) - n + 1 if n else 0):
                    out.append(b" ".join(found[at:at + n]))
                    sizes.append(n)
                    owner.append(names[row])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(sizes, pa.int32()),
                                              pa.array(owner, pa.string())], ["window", "n_words", "item"])

    rows = benchmark.select(F.col(item).cast("string").alias("a"), F.col(text).cast("string").alias("b"))
    return rows.mapInArrow(cut, "window binary, n_words int, item string").groupBy("window", "n_words").agg(
        F.sort_array(F.collect_set("item")).alias("items"))


def _block_arrays(rows: list) -> dict:
    """Hashes of a block's windows: whole windows, and all their shingles in order."""
    whole, shingles, owner, offset, sizes = [], [], [], [], []
    for number, r in enumerate(rows):
        body = np.frombuffer(bytes(r["window"]), np.uint8)
        texts = tw.Texts(body, np.array([0, len(body)]), np.zeros(1, bool))
        parts = tw.split(texts)
        h = tw.hash_spans(body, parts.start, parts.end)
        n = len(h)
        whole.append(tw.hash_runs(h, np.array([0]), np.array([n]))[0])
        k = min(SHINGLE, n)
        at = np.arange(n - k + 1)
        shingles.append(tw.hash_runs(h, at, at + k))
        owner.append(np.full(len(at), number))
        offset.append(at)
        sizes.append(np.full(len(at), k))
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return {"whole": np.array(whole, np.uint64), "shingle": join(shingles, np.uint64), "owner": join(owner, np.int64),
            "offset": join(offset, np.int64), "k": join(sizes, np.int64),
            "n": np.array([r["n_words"] for r in rows], np.int64), "words": [bytes(r["window"]) for r in rows],
            "items": [list(r["items"]) for r in rows]}


def shingle_counts(docs: DataFrame, text: str, wanted: np.ndarray, sizes: list[int]) -> dict[int, int]:
    """How often each wanted shingle hash occurs in the documents (absent: 0)."""
    wanted = np.unique(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(0))):
                parts = tw.split(piece, BREAKS)
                h = tw.hash_spans(piece.data, parts.start, parts.end, tw.LOWER)
                for k in sizes:
                    at, _ = tw.windows(parts, k)
                    s = tw.hash_runs(h, at, at + k)
                    place = np.minimum(np.searchsorted(wanted, s), len(wanted) - 1)
                    total += np.bincount(place[wanted[place] == s], minlength=len(wanted))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([tw.signed(wanted[seen]), pa.array(total[seen])], ["shingle", "n"])

    rows = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "shingle long, n long")
    return {r["shingle"]: r["n"] for r in rows.groupBy("shingle").agg(F.sum("n").alias("n")).collect()}


def _prefixes(block: dict, counts: dict[int, int]) -> dict:
    """The rarest shingle of each window, sorted by hash; windows with an absent one are out."""
    df = np.array([counts.get(int(x), 0) for x in block["shingle"].view(np.int64)], np.int64)
    order = np.lexsort((block["offset"], block["shingle"], df, block["owner"]))
    first = order[np.unique(block["owner"][order], return_index=True)[1]]
    first = first[df[first] > 0]
    first = first[np.argsort(block["shingle"][first], kind="stable")]
    keep = block["owner"][first]
    return {"prefix": block["shingle"][first], "offset": block["offset"][first], "k": block["k"][first],
            "whole": block["whole"][keep], "n": block["n"][keep],
            "words": [block["words"][i] for i in keep], "items": [block["items"][i] for i in keep]}


def _join_piece(piece: tw.Texts, block: dict, sizes: list[int]):
    """Verified (row, first word in row, n words, window) of one piece, and words per row."""
    parts = tw.split(piece, BREAKS)
    h = tw.hash_spans(piece.data, parts.start, parts.end, tw.LOWER)
    found_at, found_window = [], []
    for k in sizes:
        own = np.flatnonzero(block["k"] == k)
        prefix = block["prefix"][own]
        at, _ = tw.windows(parts, k)
        s = tw.hash_runs(h, at, at + k)
        left = np.searchsorted(prefix, s, "left")
        hit = np.flatnonzero(prefix[np.minimum(left, max(len(prefix) - 1, 0))] == s) if len(prefix) else np.zeros(0, int)
        left, right = left[hit], np.searchsorted(prefix, s[hit], "right")
        n = right - left
        run = np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else left
        window = own[run]
        begin = np.repeat(at[hit], n) - block["offset"][window]
        row = parts.row[np.repeat(at[hit], n)]
        # the window has to start and end inside the document
        fits = (begin >= parts.bounds[row]) & (begin + block["n"][window] <= parts.bounds[row + 1])
        found_at.append(begin[fits])
        found_window.append(window[fits])
    at, window = np.concatenate(found_at), np.concatenate(found_window)
    same = tw.hash_runs(h, at, at + block["n"][window]) == block["whole"][window]
    at, window = at[same], window[same]
    exact = np.ones(len(at), bool)
    folded = tw.LOWER[piece.data]
    for i, (a, w) in enumerate(zip(at, window)):
        ends = range(a, a + int(block["n"][w]))
        exact[i] = b" ".join(folded[parts.start[j]:parts.end[j]].tobytes() for j in ends) == block["words"][w]
    return parts, at[exact], window[exact]


def mark(docs: DataFrame, benchmark: DataFrame, *, text: str, item: str, item_text: str, window: int = 10,
         block_windows: int = 200_000, prefix: str = "_bench") -> DataFrame:
    """All columns of `docs` with `<prefix>_words` (count), `<prefix>_hits` (places of hit
    words, ascending) and `<prefix>_items` (ids as text, ascending)."""
    if window < 1 or block_windows < 1:
        raise ValueError("window and block_windows must be positive")
    wanted = cut_lineage(item_windows(benchmark, item, item_text, window), "windows")
    total = wanted.count()
    n_blocks = max(1, math.ceil(total / block_windows))
    numbered = wanted.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n_blocks)))
    names = [f"{prefix}_words", f"{prefix}_hits", f"{prefix}_items"]
    tw.refuse_names(docs, *names)
    out = docs.withColumn(names[0], F.lit(0)).withColumn(names[1], F.array().cast(HITS)) \
        .withColumn(names[2], F.array().cast(ITEMS))
    schema = out.schema
    place = tw.place_of(docs, text)
    session = docs.sparkSession
    for number in range(n_blocks):
        block = _block_arrays(numbered.where(F.col("block") == number).sort("window").collect() if total else [])
        sizes = sorted(set(block["k"].tolist()))
        counts = shingle_counts(docs, text, block["shingle"], sizes) if sizes else {}
        block = _prefixes(block, counts)
        shared = session.sparkContext.broadcast(block)

        def join(batches: Iterator[pa.RecordBatch], shared=shared, sizes=sizes) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for batch in batches:
                texts = tw.texts_of(batch.column(place).cast(pa.string()))
                counts, hits, items = [], [None] * len(texts), [None] * len(texts)
                old_hits, old_items = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
                for piece in tw.pieces(texts):
                    if sizes:
                        parts, at, which = _join_piece(piece, block, sizes)
                    else:
                        parts = tw.split(piece, BREAKS)
                        at = which = np.zeros(0, np.int64)
                    counts.append(parts.counts())
                    rows = parts.row[at] if len(at) else at
                    for row in np.unique(rows).tolist():
                        own = np.flatnonzero(rows == row)
                        low, high = parts.bounds[row], parts.bounds[row + 1]
                        hit = np.flatnonzero(tw.cover(high - low, at[own] - low, block["n"][which[own]]))
                        hits[piece.first + row] = hit
                        items[piece.first + row] = {x for w in which[own] for x in block["items"][w]}
                for row in range(len(texts)):
                    before = old_hits[row].as_py()
                    if hits[row] is None:
                        hits[row], items[row] = before, old_items[row].as_py()
                    else:
                        hits[row] = np.union1d(np.array(before, np.int64), hits[row]).tolist()
                        items[row] = sorted(items[row] | set(old_items[row].as_py()))
                n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-3], pa.array(n, pa.int32()), pa.array(hits, pa.list_(pa.int32())),
                     pa.array(items, pa.list_(pa.string()))], names=batch.schema.names)

        out = out.mapInArrow(join, schema)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, id: str, text: str, item: str, item_text: str,
                  window: int = 10, block_windows: int = 200_000) -> DataFrame:
    """One row per document: id, n_words, hit word places, item ids and the verdict."""
    rows = mark(docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")), benchmark, text="text",
                item=item, item_text=item_text, window=window, block_windows=block_windows)
    return rows.select(F.col("id").alias(id), F.col("_bench_words").cast("long").alias("n_words"),
                       F.col("_bench_hits").alias("hits"), F.col("_bench_items").alias("items"),
                       (F.size("_bench_hits") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, *, text: str, item: str, item_text: str,
                    window: int = 10, block_windows: int = 200_000) -> DataFrame:
    """The rows of `docs` in which no window occurs, columns unchanged."""
    prefix = tw.unused(docs, "_bench")
    marked = mark(docs, benchmark, text=text, item=item, item_text=item_text, window=window,
                  block_windows=block_windows, prefix=prefix)
    return marked.where(F.size(f"{prefix}_hits") == 0).drop(*(f"{prefix}_{x}" for x in ("words", "hits", "items")))
