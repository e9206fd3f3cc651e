"""Many words or passages looked for in one pass over the texts, inside Arrow tasks.

`word_table` finds all occurrences of a lexicon's words with an Aho-Corasick automaton that each
worker compiles once. A lexicon of more than LOOKUP_WORDS words is not sent to the tasks: there the texts' windows are
counted per text and joined with it, with the same result. `window_hits` finds the windows of passages by
64-bit hashes of fixed numbers of bytes, so that only hits leave a text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# words of an automaton, and windows of a lookup, that are sent to the tasks
LOOKUP_WORDS, LOOKUP_WINDOWS = 200_000, 2_000_000
BEFORE = 3
STEP = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_compiled: dict[int, object] = {}


def _automaton(words) -> object:
    """The automaton of a broadcast list of words, compiled once in a worker."""
    if words.value and id(words.value) not in _compiled:
        _compiled.clear()
        found = ahocorasick.Automaton()
        for w in words.value:
            found.add_word(w, w)
        found.make_automaton()
        _compiled[id(words.value)] = found
    return _compiled.get(id(words.value))


def _occurrences(text: str, automaton, widths: Sequence[int]) -> Iterator[tuple[int, str]]:
    """(place, word) of every occurrence, overlapping ones included; without an automaton, of every window."""
    if automaton is not None:
        for end, word in automaton.iter(text):
            yield end + 1 - len(word), word
    else:
        for w in widths:
            for at in range(len(text) - w + 1):
                yield at, text[at:at + w]


def word_table(df: DataFrame, key: str, text: str, lexicon: DataFrame, word: str, widths: Sequence[int],
               negators: Sequence[str] = ()) -> DataFrame:
    """(key, word, hits, near, pos, prefix) per row and word of the lexicon with a length in `widths`: how often it
    occurs, how often one of the two windows before an occurrence is a negator, and the place and up to three
    characters before the first occurrence. Null texts have none."""
    widths = sorted(set(widths))
    known = lexicon.select(F.col(word).alias("w")).where(F.length("w").isin(*widths)).distinct()
    listed = [r["w"] for r in known.limit(LOOKUP_WORDS + 1).collect()]
    whole = len(listed) <= LOOKUP_WORDS
    shared = df.sparkSession.sparkContext.broadcast(sorted(listed) if whole else [])
    stops = frozenset(negators)
    kind = df.select(key).schema[0].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared) if whole else None
        for batch in batches:
            row, words, hits, near, pos, prefix = [], [], [], [], [], []
            if whole and not shared.value:
                continue
            for i, body in enumerate(batch.column(1).to_pylist()):
                found: dict[str, list] = {}
                for at, w in _occurrences(body or "", automaton, widths):
                    facts = found.get(w)
                    if facts is None:
                        found[w] = facts = [0, 0, at]
                    elif at < facts[2]:
                        facts[2] = at
                    facts[0] += 1
                    if stops and ((at > 0 and body[at - 1:at - 1 + len(w)].strip(" ") in stops)
                                  or (at > 1 and body[at - 2:at - 2 + len(w)].strip(" ") in stops)):
                        facts[1] += 1
                for w, (n, m, at) in found.items():
                    row.append(i)
                    words.append(w)
                    hits.append(n)
                    near.append(m)
                    pos.append(at)
                    prefix.append(body[max(0, at - BEFORE):at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(words, pa.string()), pa.array(hits, pa.int64()),
                 pa.array(near, pa.int64()), pa.array(pos, pa.int64()), pa.array(prefix, pa.string())],
                ["key", "word", "hits", "near", "pos", "prefix"])

    found = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        scan, f"key {kind}, word string, hits long, near long, pos long, prefix string")
    if not whole:
        found = found.join(known, F.col("word") == F.col("w"), "left_semi")
    return found.select(F.col("key").alias(key), F.col("word").alias(word), "hits", "near", "pos", "prefix")


def window_hashes(body: bytes, width: int) -> np.ndarray:
    """64-bit hash of every window of `width` bytes."""
    data = np.frombuffer(body, np.uint8)
    n = len(data)
    if n < width:
        return np.zeros(0, np.uint64)
    up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, STEP, np.uint64)]))
    down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(STEP, -1, 2**64), np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * up[:n])])
    h = (sums[width:] - sums[:-width]) * down[:n - width + 1] + np.uint64(width)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(31))


def passage_windows(passages: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(key, w, h): the distinct windows of every passage, of `width` bytes or of all its bytes if it has fewer."""
    kind = passages.select(key).schema[0].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, size, found = [], [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                raw = (body or "").encode()
                if raw:
                    h = np.unique(window_hashes(raw, min(width, len(raw))))
                    row.append(np.full(len(h), i))
                    size.append(np.full(len(h), min(width, len(raw))))
                    found.append(h.view(np.int64))
            flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(flat(row))), pa.array(flat(size), pa.int32()), pa.array(flat(found))],
                                             ["key", "w", "h"])

    return passages.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        scan, f"key {kind}, w int, h long").withColumnRenamed("key", key)


def window_hits(docs: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(key, h) for the windows (w, h) of `wanted` that occur in a text, once per text. The wanted hashes go to the
    tasks in lots of LOOKUP_WINDOWS, each lot one pass over the texts."""
    spark = docs.sparkSession
    total = wanted.count()
    lots = max(1, -(-total // LOOKUP_WINDOWS))
    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def scan_for(shared):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, body in enumerate(batch.column(1).to_pylist()):
                    raw = (body or "").encode()
                    for width, known in shared.value.items():
                        h = window_hashes(raw, width)
                        if len(h):
                            h = np.unique(h[known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h])
                            row.append(np.full(len(h), i))
                            found.append(h.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(row))), pa.array(np.concatenate(found))], ["key", "h"])

        return scan

    out = None
    for lot in range(lots):
        part = wanted.where(F.pmod(F.xxhash64("h"), F.lit(lots)) == lot).toPandas()
        tables = {int(w): np.sort(g["h"].to_numpy(np.int64).view(np.uint64)) for w, g in part.groupby("w")}
        hits = rows.mapInArrow(scan_for(spark.sparkContext.broadcast(tables)), f"key {kind}, h long")
        out = hits if out is None else out.unionByName(hits)
    return out.withColumnRenamed("key", key)


GROUP_CHARS = 1 << 20


def _counted(texts: list[str], widths: Sequence[int]) -> tuple[list[str], list[int]]:
    """The distinct windows of some texts and how often they occur."""
    body = "".join(texts)
    points = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts])
    grams, counts = [], []
    for lo in range(0, len(points), GROUP_CHARS):
        start = np.arange(lo, min(lo + GROUP_CHARS, len(points)))
        room = ends[np.searchsorted(ends, start, "right")] - start
        for w in widths:
            at = start[room >= w]
            # three code points of 21 bits fill a number; longer windows are hashed to 64 bits
            step = np.uint64(1 << 21) if w <= 3 else np.uint64(STEP)
            h = np.zeros(len(at), np.uint64)
            for j in range(w):
                h = h * step + points[at + j]
            code, distinct = pd.factorize(h)
            first = np.empty(len(distinct), np.int64)
            first[code[::-1]] = at[::-1]
            grams += [body[i:i + w] for i in first.tolist()]
            counts += np.bincount(code, minlength=len(distinct)).tolist()
    return grams, counts


def window_counts(df: DataFrame, text: str, widths: Sequence[int]) -> DataFrame:
    """(gram, n): all overlapping character windows of the widths and how often they occur in the table. Windows are
    counted inside the tasks, about a million characters at a time, before they meet."""
    widths = sorted(set(widths))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, size = [], 0
            bodies = batch.column(0).to_pylist()
            for i, body in enumerate(bodies):
                if body:
                    group.append(body)
                    size += len(body)
                if group and (size >= GROUP_CHARS or i + 1 == len(bodies)):
                    grams, counts = _counted(group, widths)
                    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(counts, pa.int64())], ["gram", "n"])
                    group, size = [], 0

    found = df.select(F.col(text).cast("string").alias("text")).mapInArrow(scan, "gram string, n long")
    return found.groupBy("gram").agg(F.sum("n").alias("n"))
