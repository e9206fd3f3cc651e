"""Words, hashes and windows of Arrow text columns, computed with numpy inside tasks.

Texts are handled as UTF-8 bytes in pieces of about `PIECE` bytes; one longer text
is a piece of its own. Nulls count as empty texts and stay marked in `Texts.null`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20
# odd multipliers of the two rolling hashes and of the finisher
BYTE_STEP, WORD_STEP = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Texts:
    """Concatenated bytes of some rows, their bounds, and which rows were null."""

    data: np.ndarray
    bounds: np.ndarray
    null: np.ndarray
    first: int = 0

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.bounds[row]:self.bounds[row + 1]].tobytes()


@dataclass
class Words:
    """Byte bounds of the words of `Texts`, the row of each, and row bounds."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def texts_of(column: pa.Array) -> Texts:
    """All rows of a string or binary column (any other type reads as text)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string() if not pa.types.is_binary(column.type) else pa.binary())
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    null = column.is_null().to_numpy(zero_copy_only=False)
    if null.any():
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), null)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[bounds[0]:bounds[-1]], bounds - bounds[0], null)


def place_of(docs: DataFrame, name: str) -> int:
    """Place of a column, found as Spark finds names (in any case, unless the session tells cases apart)."""
    docs.select(F.col(f"`{name}`"))  # raises where Spark finds none, or several
    names = docs.columns
    return names.index(name) if name in names else [c.lower() for c in names].index(name.lower())


def refuse_names(docs: DataFrame, *added: str) -> None:
    """Raise if a column of `docs` has, in any case, the name of one that is to be added."""
    taken = {c.lower() for c in docs.columns} & {a.lower() for a in added}
    if taken:
        raise ValueError(f"columns are named like results: {', '.join(sorted(taken))}")


def unused(docs: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `docs` begins with it (in any case)."""
    while any(c.lower().startswith(name.lower()) for c in docs.columns):
        name += "_"
    return name


def pieces(texts: Texts, size: int = PIECE) -> Iterator[Texts]:
    """Runs of whole rows of about `size` bytes; `first` is the place of their first row."""
    at, n = 0, len(texts)
    while at < n:
        to = int(np.searchsorted(texts.bounds, texts.bounds[at] + size, "right")) - 1
        to = min(max(to, at + 1), n)
        lo, hi = texts.bounds[at], texts.bounds[to]
        yield Texts(texts.data[lo:hi], texts.bounds[at:to + 1] - lo, texts.null[at:to], at)
        at = to


def split(texts: Texts, breaks: np.ndarray = SPACES) -> Words:
    """Longest runs of bytes for which `breaks` is false, inside each row."""
    inside = ~breaks[texts.data]
    n = len(inside)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = texts.bounds
    before[edges[:-1][edges[:-1] < n]] = False
    after[edges[1:][edges[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(start, edges)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(start, end, row, bounds)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX_A
    h = (h ^ (h >> np.uint64(27))) * MIX_B
    return h ^ (h >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(step: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """step**i and its inverse modulo 2**64 for i in 0..n (kept up to a few pieces)."""
    known = _powers.get(step)
    if known is None or len(known[0]) <= n:
        size = max(n + 1, 2 * PIECE + 1)
        one = np.ones(1, np.uint64)
        up = np.cumprod(np.concatenate([one, np.full(size, step, np.uint64)]))
        down = np.cumprod(np.concatenate([one, np.full(size, pow(step, -1, 2**64), np.uint64)]))
        known = (up, down)
        if size <= 8 * PIECE:
            _powers[step] = known
    return known


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of each byte span; `fold` maps bytes first (LOWER folds A-Z)."""
    up, down = powers(BYTE_STEP, len(data))
    values = _VALUES if fold is None else _VALUES[fold]
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values[data] * up[:len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def hash_runs(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of consecutive values start..end-1."""
    up, down = powers(WORD_STEP, len(hashes))
    sums = np.empty(len(hashes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts (word numbers) and rows of the windows of `size` consecutive words of one row."""
    n = len(words.start)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.row[:n - size + 1] == words.row[size - 1:])
    return at, words.row[at]


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def cover(n: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, start, 1)
    np.add.at(marks, start + length, -1)
    return np.cumsum(marks[:n]) > 0
