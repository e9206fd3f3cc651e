"""Removal of passages that an earlier document, or an earlier place, already holds.

A passage is `window` consecutive words. Every window owns one anchor: of the phrases of
`phrase` words inside it, the one with the least hash. Equal windows have equal anchors,
so it is enough to compare the windows of equal anchors.

1. Confirm. The scan sends one row per run of windows with the same anchor (about one per
   seven words) with short window codes; equal runs of a piece and block are folded first.
   Rows meet by anchor, sorted by place; windows seen twice are confirmed, and for each
   block of documents one sample place is kept, with a flag if the very first place of the
   window lies in that block. Anchors with very many rows (a line in a third of the documents) are
   found first; their windows are counted by Spark per window and block, with partial sums, so
   no task sees all rows of one.
2. Compile. Documents are dealt into blocks of bounded size by a hash of their id. Each block
   gets the samples it needs and compiles one Aho-Corasick automaton of their anchor phrases:
   the automaton is sharded by documents, so each text passes through exactly one.
3. Stream. All documents of the block run through the automaton; around each hit the windows
   are looked up among the confirmed ones. All but the first place are covered.

No group is held whole but a block and the rows of an anchor that has fewer than `hot_rows` (or one in
two million bytes of text, if that is more; an anchor that never recurs within a piece can have one row per piece). Both ways give the same samples.

Defined results: null or empty text has no words and stays empty; texts shorter than a
window keep all words; rows that repeat an id are taken as copies of one document and
each give the same row; rows without an id keep all words and hide nothing elsewhere;
an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import cut_lineage

CODE = 5  # bytes of a window's hash beside its anchor's 8
SCAN_PIECE = 2 << 20
RUNS = "anchor long, doc long, place long, n int, codes binary"
WINDOWS = "anchor long, code long, block long, doc long, place long, nth int, n int"
HOT_BYTES = 2_000_000  # a hot anchor has at least one run in so many bytes, and a run two bytes: at most 1e6 are hot
SAMPLES = "block long, doc long, place long, wanted int, first int"


def block_of(doc: np.ndarray, blocks: int) -> np.ndarray:
    return (tw.mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def anchors(h: np.ndarray, row: np.ndarray, window: int, phrase: int):
    """For the windows inside one row: their starts and hashes, and the place and hash of each anchor."""
    n = len(h) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none, none.view(np.uint64)
    starts = np.arange(len(h) - phrase + 1)
    grams = tw.hash_runs(h, starts, starts + phrase)
    width = window - phrase + 1
    least, place, have = grams, starts, 1
    while have < width:
        step = min(have, width - have)
        a, b = least[:len(least) - step], least[step:]
        later = b < a  # ties stay with the earlier phrase
        place = np.where(later, place[step:], place[:len(place) - step])
        least = np.where(later, b, a)
        have += step
    at = np.flatnonzero(row[:n] == row[window - 1:])
    return at, tw.hash_runs(h, at, at + window), place[at], least[at]


def _runs_of(piece: tw.Texts, window: int, phrase: int):
    """The runs of windows with one anchor: row, place, anchor, size, first window; and the hashes of all windows."""
    parts = tw.split(piece)
    h = tw.hash_spans(piece.data, parts.start, parts.end)
    at, codes, place, least = anchors(h, parts.row, window, phrase)
    row = parts.row[at]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])) if len(at) else at
    where = (at[first] - parts.bounds[row[first]]) * 64 + (place[first] - at[first])
    return row[first], where, least[first], np.diff(np.append(first, len(at))), first, codes


def hot_anchors(docs: DataFrame, least: int, window: int, phrase: int) -> np.ndarray:
    """Anchors, ascending, with at least `least` runs in pieces where they recur."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(1)), SCAN_PIECE):
                key, n = np.unique(_runs_of(piece, window, phrase)[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([tw.signed(key[n > 1]), pa.array(n[n > 1])], ["anchor", "n"])

    found = docs.mapInArrow(scan, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(found.select("anchor").toArrow().column("anchor").to_numpy().view(np.uint64))


def _is_in(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def scan_runs(docs: DataFrame, blocks: int, window: int, phrase: int, hot: np.ndarray, windows: bool = False) -> DataFrame:
    """(id, text) to runs of windows with one anchor; place is 64 * first window + place of the anchor in it.
    Runs of hot anchors are left out, or with `windows` are the only ones and give one row per window."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for piece in tw.pieces(tw.texts_of(batch.column(1)), SCAN_PIECE):
                row, where, least, size, first, codes = _runs_of(piece, window, phrase)
                mine = np.flatnonzero(_is_in(least, hot) == windows)
                if not len(mine):
                    continue
                row, where, least, size, first = row[mine], where[mine], least[mine], size[mine], first[mine]
                doc = ids[piece.first + row]
                block = block_of(doc, blocks)
                # equal runs of this piece and block: the earliest stands for all
                key = tw.mix(tw.hash_runs(codes, first, first + size) ^ least) ^ tw.mix(block.view(np.uint64))
                order = np.lexsort((where, doc, key))
                lead = np.concatenate([[True], key[order][1:] != key[order][:-1]])
                times = np.diff(np.append(np.flatnonzero(lead), len(order)))
                keep = order[lead]
                own = np.zeros(len(first), np.int64)
                own[keep] = times
                keep = np.flatnonzero(own)
                ends = np.cumsum(size[keep])
                nth = np.arange(int(ends[-1])) - np.repeat(ends - size[keep], size[keep])
                code = codes[np.repeat(first[keep], size[keep]) + nth]
                body = np.ascontiguousarray(code.view(np.uint8).reshape(-1, 8)[:, :CODE])
                if windows:
                    wide = np.zeros((len(body), 8), np.uint8)
                    wide[:, :CODE] = body
                    of = np.repeat(keep, size[keep])
                    yield pa.RecordBatch.from_arrays(
                        [tw.signed(least[of]), pa.array(wide.view(np.int64).ravel()), pa.array(block[of]), pa.array(doc[of]),
                         pa.array(where[of]), pa.array(nth, pa.int32()), pa.array(own[of], pa.int32())],
                        ["anchor", "code", "block", "doc", "place", "nth", "n"])
                    continue
                packed = pa.Array.from_buffers(pa.binary(), len(keep), [
                    None, pa.py_buffer(np.append(0, ends * CODE).astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [tw.signed(least[keep]), pa.array(doc[keep]), pa.array(where[keep]),
                     pa.array(own[keep], pa.int32()), packed], ["anchor", "doc", "place", "n", "codes"])

    return docs.mapInArrow(scan, WINDOWS if windows else RUNS)


def confirm_hot(windows: DataFrame) -> DataFrame:
    """Windows of hot anchors to samples, by partial sums per window and block and then per window."""
    here = windows.groupBy("anchor", "code", "block").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc", "place", "nth")).alias("at"))
    here = cut_lineage(here, "hot")
    window = here.groupBy("anchor", "code").agg(F.sum("n").alias("seen"), F.min("at").alias("first_at")).where("seen > 1")
    first = F.col("at") == F.col("first_at")
    bit = F.expr("shiftleft(1, at.nth)")
    return here.join(window, ["anchor", "code"]).where(~first | (F.col("n") > 1)).select(
        "block", "at.doc", "at.place", bit.alias("wanted"), F.when(first, bit).otherwise(0).alias("first"))


def _confirm(t: pa.Table, blocks: int) -> pa.RecordBatch | None:
    """Samples of the windows seen twice among whole anchor groups sorted by place."""
    anchor = t.column("anchor").to_numpy()
    times = t.column("n").to_numpy()
    group = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]])) - 1
    seen = np.bincount(group, times)
    keep = np.flatnonzero(seen[group] > 1)
    if not len(keep):
        return None
    t = t.take(pa.array(keep))
    group, times = group[keep], times[keep]
    doc, place = t.column("doc").to_numpy(), t.column("place").to_numpy()
    codes = t.column("codes").combine_chunks()
    body = tw.texts_of(codes)
    size = np.diff(body.bounds) // CODE
    wide = np.zeros((len(body.data) // CODE, 8), np.uint8)
    wide[:, :CODE] = body.data.reshape(-1, CODE)
    code = wide.view(np.uint64).ravel()
    row = np.repeat(np.arange(len(size)), size)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    block = block_of(doc, blocks)
    order = np.lexsort((row, block[row], code, group[row]))
    g, c, b = group[row][order], code[order], block[row][order]
    new_window = np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])
    new_place = new_window | np.concatenate([[True], b[1:] != b[:-1]])
    of_window, of_place = np.cumsum(new_window) - 1, np.cumsum(new_place) - 1
    n_window = np.bincount(of_window, times[row][order])
    n_place = np.bincount(of_place, times[row][order])
    least = np.minimum.reduceat(row[order], np.flatnonzero(new_window))
    sample = order[new_place]
    window_of_sample = of_window[new_place]
    here = row[sample] == least[window_of_sample]
    wanted = (n_window[window_of_sample] > 1) & (~here | (n_place > 1))
    sample, here = sample[wanted], here[wanted]
    bit = np.int64(1) << nth[sample]
    masks, firsts = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    np.add.at(masks, row[sample], bit)
    np.add.at(firsts, row[sample], bit * here)
    rows = np.flatnonzero(masks)
    return pa.RecordBatch.from_arrays(
        [pa.array(block[rows]), pa.array(doc[rows]), pa.array(place[rows]), pa.array(masks[rows], pa.int32()),
         pa.array(firsts[rows], pa.int32())], ["block", "doc", "place", "wanted", "first"])


def confirm(runs: DataFrame, blocks: int) -> DataFrame:
    """Runs to samples: one row per anchor place that a block of documents has to know."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor = batch.column(0).to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1], "left"))  # the last group may go on
            if cut == 0 and held and held[-1].column(0)[-1].as_py() == anchor[0]:
                held.append(batch)
                continue
            done = pa.Table.from_batches([*held, batch.slice(0, cut)]) if held or cut else None
            if done is not None and done.num_rows and (out := _confirm(done, blocks)) is not None:
                yield out
            held = [batch.slice(cut)]
        if held and (out := _confirm(pa.Table.from_batches(held), blocks)) is not None:
            yield out

    return runs.repartition("anchor").sortWithinPartitions("anchor", "doc", "place").mapInArrow(reduce, SAMPLES)


def _hashed(texts: tw.Texts) -> tuple[np.ndarray, tw.Words]:
    """Word hashes of a block, taken piece by piece, with the row of each word and row bounds."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for piece in tw.pieces(texts):
        parts = tw.split(piece)
        hashes.append(tw.hash_spans(piece.data, parts.start, parts.end))
        counts.append(parts.counts())
    counts = np.concatenate(counts)
    none = np.zeros(0, np.int64)
    return np.concatenate(hashes), tw.Words(none, none, np.repeat(np.arange(len(counts)), counts),
                                            np.concatenate([[0], np.cumsum(counts)]))


def _phrase_places(h: np.ndarray, phrases: np.ndarray, phrase: int) -> np.ndarray:
    """Where the phrases (rows of word hashes) begin among the words.

    The automaton's letters are few: a word of the phrases is spelt with three letters, one of
    each of three alphabets, so that hits fall on whole words; all other words share one letter."""
    known = np.unique(phrases)
    base = max(2, round(len(known) ** (1 / 3)) + 1)

    def spell(words: np.ndarray) -> str:
        at = np.minimum(np.searchsorted(known, words), len(known) - 1).astype(np.uint32)
        letters = np.empty((*at.shape, 3), "<u4")
        letters[..., 0] = at // base**2 + 256
        letters[..., 1] = at // base % base + base + 256
        letters[..., 2] = at % base + 2 * base + 256
        letters[known[at] != words] = 128
        return letters.tobytes().decode("utf-32-le")

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    spelt, size = spell(phrases), 3 * phrase
    for word in {spelt[i:i + size] for i in range(0, len(spelt), size)}:
        automaton.add_word(word)
    automaton.make_automaton()
    return np.array([end for end, _ in automaton.iter(spell(h))], np.int64) // 3 - phrase + 1


def _removed(h: np.ndarray, parts: tw.Words, doc: list, samples: pa.Table, window: int, phrase: int) -> np.ndarray:
    """Which words of a block's documents (ascending ids) go."""
    gone = np.zeros(len(h), bool)
    n = samples.num_rows
    if not n or len(h) < window:
        return gone
    row_of: dict = {}
    for i, d in enumerate(doc):
        row_of.setdefault(d, i)
    rows = np.array([row_of[d] for d in samples.column("doc").to_pylist()], np.int64)
    place = samples.column("place").to_numpy()
    base = parts.bounds[rows] + place // 64
    wanted, first = samples.column("wanted").to_numpy(), samples.column("first").to_numpy()
    bits = np.arange(window - phrase + 1)
    pick = (wanted[:, None] >> bits) & 1 == 1
    starts = (base[:, None] + bits)[pick]
    hashes = tw.hash_runs(h, starts, starts + window)
    here = ((first[:, None] >> bits) & 1 == 1)[pick]
    order = np.argsort(hashes, kind="stable")
    hashes, here = hashes[order], here[order]

    begin = _phrase_places(h, h[(base + place % 64)[:, None] + np.arange(phrase)], phrase)
    row = parts.row[begin]
    inside = (parts.row[begin + phrase - 1] == row) & (np.array([d is not None for d in doc])[row])
    begin, row = begin[inside], row[inside]
    # windows that hold the phrase
    found = np.zeros(len(h) + 1, np.int64)
    low, high = parts.bounds[row], parts.bounds[row + 1]
    np.add.at(found, np.maximum(begin - (window - phrase), low), 1)
    np.add.at(found, np.maximum(np.minimum(begin, high - window), low - 1) + 1, -1)
    around = np.flatnonzero(np.cumsum(found[:-1]) > 0)
    around = around[parts.row[around] == parts.row[np.minimum(around + window - 1, len(h) - 1)]]
    around = around[around + window <= len(h)]
    key = tw.hash_runs(h, around, around + window)
    at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
    match = hashes[at] == key
    around, key, at = around[match], key[match], at[match]
    later = np.ones(len(around), bool)
    own = np.flatnonzero(here[at])
    if len(own):
        order = own[np.lexsort((around[own], key[own]))]
        lead = np.concatenate([[True], key[order][1:] != key[order][:-1]])
        first_of = np.repeat(order[lead], np.diff(np.append(np.flatnonzero(lead), len(order))))
        # a copy of the very row that holds the first place is that place too
        a, b = around[order], around[first_of]
        ra, rb = parts.row[a], parts.row[b]
        ids_of = np.array([-1 if d is None else d for d in doc], np.int64)
        later[order] = ~((ids_of[ra] == ids_of[rb]) & (a - parts.bounds[ra] == b - parts.bounds[rb]))
    return tw.cover(len(h), around[later], window)


def remove_repeats(docs: DataFrame, *, id: str, text: str, window: int = 20, phrase: int = 8,
                   block_bytes: int = 8 << 20, hot_rows: int = 20_000) -> DataFrame:
    """One row per document: id, n_words, n_removed and kept_text (the words left, joined by blanks)."""
    if not 1 <= phrase <= window or window - phrase > 30:
        raise ValueError("phrase must be within the window and at most 30 words shorter")
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    named = rows.where("doc IS NOT NULL")
    hot = hot_anchors(named, max(hot_rows, total // HOT_BYTES), window, phrase)
    samples = confirm(scan_runs(named, blocks, window, phrase, hot), blocks)
    if len(hot):
        samples = samples.unionByName(confirm_hot(scan_runs(named, blocks, window, phrase, hot, windows=True)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = tw.texts_of(batch.column(1))
            missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            spread = np.where(missing, np.arange(len(ids)), ids).astype(np.int64)
            packed = [squeeze.compress(texts.bytes_of(i)) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([pa.array(block_of(spread, blocks)), batch.column(0),
                                              pa.array(packed, pa.binary())], ["block", "doc", "packed"])

    def stream(texts: pa.Table, found: pa.Table) -> pa.Table:
        open_ = zstandard.ZstdDecompressor()
        texts = texts.sort_by([("doc", "ascending")])
        doc = texts.column("doc").to_pylist()
        bodies = [open_.decompress(x) for x in texts.column("packed").to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
        piece = tw.Texts(np.frombuffer(b"".join(bodies), np.uint8), bounds, np.zeros(len(doc), bool))
        h, parts = _hashed(piece)
        gone = _removed(h, parts, doc, found, window, phrase)
        n_gone = np.concatenate([[0], np.cumsum(gone)])
        n_gone = n_gone[parts.bounds[1:]] - n_gone[parts.bounds[:-1]]
        kept = []
        for row, body in enumerate(bodies):
            found_words = body.split()
            if n_gone[row]:
                keep = ~gone[parts.bounds[row]:parts.bounds[row + 1]]
                found_words = [found_words[i] for i in np.flatnonzero(keep).tolist()]
            kept.append(b" ".join(found_words).decode())
        return pa.table({"doc": pa.array(doc, pa.int64()), "n_words": pa.array(parts.counts()),
                         "n_removed": pa.array(n_gone), "kept_text": pa.array(kept, pa.string())})

    packed = rows.mapInArrow(pack, "block long, doc long, packed binary")
    out = packed.groupBy("block").cogroup(samples.groupBy("block")).applyInArrow(
        stream, "doc long, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("doc", id)
