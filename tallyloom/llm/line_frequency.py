"""Cross-document line frequency as a quality rule.

Lines are normalised (A-Z folded, digits made equal, white space collapsed) and hashed
where the document is read. The number of distinct documents that hold a line is counted
per host; exact copies of a text count once. Lines in more than `max_docs` documents of a
host are taken out, and a document that keeps less than `min_left` of its words is
rejected, as is one that fails the base rules (fewer than 50 words, or more than half of
the words inside 3-word windows found twice).

Only hashes and counts leave the scan: they are written once and grouped with partial
aggregates, so a host or line that owns a third of all rows is summed before the shuffle.

Defined results: null or empty text has no words and no lines and fails the base rules;
a null host is a host of its own; repeated rows each give a row and count as one
document; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import cut_lineage

NEWLINES = np.zeros(256, bool)
NEWLINES[10] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
# folding of a normalised line: A-Z and all digits
FOLD = tw.LOWER.copy()
FOLD[48:58] = 48

FACTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, text_key long, "
         "lines array<long>, line_words array<int>, line_places array<int>")


def per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _row_keys(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return tw.mix(hashes ^ tw.mix(rows.astype(np.uint64) + np.uint64(1)))


def _facts(piece: tw.Texts) -> list:
    parts = tw.split(piece)
    data, n = piece.data, len(piece)
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, parts.start, 1)
    np.add.at(inside, parts.end, -1)
    inside = np.cumsum(inside[:-1]) > 0
    chars = per_row(inside & ((data & 0xC0) != 0x80), piece.bounds)
    symbols = per_row(SYMBOLS[data], piece.bounds)
    h = tw.hash_spans(data, parts.start, parts.end)
    at, rows = tw.windows(parts, 3)
    begins = np.zeros(len(h), bool)
    begins[at] = repeated(_row_keys(tw.hash_runs(h, at, at + 3), rows))
    mark = begins.copy()
    mark[1:] |= begins[:-1]
    mark[2:] |= begins[:-2]
    repeats = per_row(mark, parts.bounds)
    lines = tw.split(piece, NEWLINES)
    low, high = np.searchsorted(parts.start, lines.start), np.searchsorted(parts.start, lines.end)
    worded = np.flatnonzero(high > low)
    exact = _row_keys(tw.hash_spans(data, lines.start[worded], lines.end[worded]), lines.row[worded])
    order = np.argsort(exact, kind="stable")
    again = np.zeros(len(worded), bool)
    again[order[1:]] = exact[order][1:] == exact[order][:-1]
    bounds = np.searchsorted(lines.row[worded], np.arange(n + 1))
    dups = per_row(again, bounds)
    folded = tw.hash_spans(data, parts.start, parts.end, FOLD)
    norm = tw.hash_runs(folded, low[worded], high[worded])
    # place of each line: newlines of its document before it
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    place = breaks[lines.start[worded]] - breaks[piece.bounds[:-1]][lines.row[worded]]
    # A text's key stands for the whole text, so that exact copies count once.
    whole = tw.hash_spans(data, piece.bounds[:-1], piece.bounds[1:])
    lists = lambda values, kind: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
    return [pa.array(parts.counts()), pa.array(chars), pa.array(symbols), pa.array(dups), pa.array(repeats),
            tw.signed(whole), lists(norm.view(np.int64), pa.int64()), lists((high - low)[worded], pa.int32()),
            lists(place, pa.int32())]


def text_facts(rows: DataFrame) -> DataFrame:
    """The columns FACTS after those of `rows`, whose last column is the text (left out)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(batch.num_columns - 1))):
                own = [c.slice(piece.first, len(piece)) for c in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*own, *_facts(piece)], names)

    kept = rows.schema[:-1]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), FACTS])
    names = [f.name for f in kept] + [x.split()[0] for x in FACTS.split(", ")]
    return rows.mapInArrow(scan, schema)


def line_rules(docs: DataFrame, *, id: str, text: str, host: str, max_docs: int = 50,
               min_left: float = 0.3) -> DataFrame:
    """One row per document: base counts, `removed_lines` (numbers of its lines, from 0),
    `words_left`, `base_failed` and `kept`."""
    rows = docs.select(F.col(id).alias("id"), F.col(host).cast("string").alias("host"),
                       F.col(text).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    facts = cut_lineage(text_facts(rows.select("id", "host", "row", "text")), "lines")
    lines = facts.select("row", F.coalesce("host", F.lit("")).alias("host"), F.col("host").isNull().alias("no_host"),
                         "text_key", F.explode(F.arrays_zip("lines", "line_words", "line_places")).alias("l")).select(
        "row", "host", "no_host", "text_key", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words"),
        F.col("l.line_places").alias("place"))
    key = ["line", "host", "no_host"]
    common = lines.select(*key, "text_key").distinct().groupBy(*key).agg(F.count("*").alias("n")) \
        .where(F.col("n") > max_docs).select(*key)
    gone = lines.join(common, key, "left_semi").groupBy("row").agg(
        F.sum("words").alias("gone"), F.sort_array(F.collect_list("place")).alias("removed_lines"))
    joined = facts.select("id", "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") \
        .join(gone, "row", "left")
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.select(
        F.col("id").alias(id), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"), left.alias("words_left"),
        failed.alias("base_failed"), (~failed & (left >= min_left * F.col("n_words"))).alias("kept"))


def clean_documents(docs: DataFrame, *, id: str, text: str, host: str, max_docs: int = 50,
                    min_left: float = 0.3) -> DataFrame:
    """The kept rows of `docs` with the common lines taken out of their texts (rows found by id;
    rows that repeat an id without being copies need ids of their own)."""
    verdict = line_rules(docs, id=id, text=text, host=host, max_docs=max_docs, min_left=min_left) \
        .where("kept").select(F.col(id).alias("_line_id"), F.col("removed_lines").alias("_line_gone")) \
        .dropDuplicates(["_line_id"])
    cut = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.array_contains("_line_gone", i)), "\n")
    return docs.join(verdict, F.col(id).eqNullSafe(F.col("_line_id"))).withColumn(
        text, F.when(F.size("_line_gone") > 0, cut).otherwise(F.col(text))).drop("_line_id", "_line_gone")
