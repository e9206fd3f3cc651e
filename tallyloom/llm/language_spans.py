"""Language of mixed texts: script ranges, word scores, Viterbi over the words.

Learning counts byte trigrams inside words (blanks at both ends) in `BUCKETS` hashed
buckets per language, and the scripts a language's words are written in. Counting runs
over all labelled texts; only bucket sums, at most languages x BUCKETS numbers, reach the
driver.

To label a text, each word is scored under the languages that use the word's script
(all others get a floor), the scores are turned into log shares, and the best path over
the words under a penalty for each change of language gives spans of one language. The
language that owns most letters is the text's; `score` is its share of the letters.

Defined results: `und`, score 0 and no spans for null texts, texts without a letter and
models without languages; ties go to the first language by name; repeated rows each give
a row; rows with null language are not learnt from; an empty table gives no rows. Only the
named columns are read; others pass through, and one named like an added column is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw

BUCKETS = 1 << 15
MAX_LANGUAGES = 256
UNKNOWN = "und"
GROUP_BYTES = 12 << 20
# First code points of runs of one script (block boundaries of Unicode);
# "" marks runs that hold no letters.
SCRIPT_RUNS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, ""), (0x2C00, "other"), (0x2E00, ""), (0x2E80, "han"), (0x3000, ""),
    (0x3041, "kana"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xE000, ""), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"),
    (0xFE00, ""), (0xFE70, "arabic"), (0xFF00, ""), (0xFF21, "latin"), (0xFF5B, ""), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0xFFE0, ""), (0x10000, "other"), (0x1F000, ""), (0x20000, "han"),
]
RUN_STARTS = np.array([a for a, _ in SCRIPT_RUNS])
SCRIPTS = sorted({s for _, s in SCRIPT_RUNS if s}, key=lambda s: (s != "latin", s))
RUN_SCRIPT = np.array([SCRIPTS.index(s) if s else -1 for _, s in SCRIPT_RUNS])
BREAKS = np.ones(256, bool)
BREAKS[65:91] = BREAKS[97:123] = BREAKS[128:] = False


@dataclass
class Model:
    """Languages by name, log shares of buckets (one row each), scripts in use."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray


def lettered(texts: tw.Texts) -> tuple[tw.Words, np.ndarray, np.ndarray]:
    """Runs of letters, the folded bytes with all else blank, and the script of each run."""
    data = tw.LOWER[texts.data]
    lead = np.flatnonzero(data >= 0xC0)
    script_at = np.zeros(0, np.int64)
    if len(lead):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int64)
        b0, b1, b2, b3 = (padded[lead + i] for i in range(4))
        point = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1 & 63, np.where(
            b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63, (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63))
        script_at = RUN_SCRIPT[np.searchsorted(RUN_STARTS, point, "right") - 1]
        # signs of the Latin-1 block: all but the two ordinals and the micro sign
        script_at[(point < 0xC0) & ~np.isin(point, (0xAA, 0xB5, 0xBA)) | np.isin(point, (0xD7, 0xF7))] = -1
        size = np.where(b0 < 0xE0, 2, np.where(b0 < 0xF0, 3, 4))
        blank = script_at < 0
        for i in range(4):
            data[lead[blank & (size > i)] + i] = 32
    parts = tw.split(tw.Texts(data, texts.bounds, texts.null), BREAKS)
    data[BREAKS[data]] = 32
    scripts = np.zeros(len(parts.start), np.int64)
    if len(lead):
        good = lead[script_at > 0]
        np.maximum.at(scripts, np.searchsorted(parts.start, good, "right") - 1, script_at[script_at > 0])
    return parts, data, scripts


def trigrams(data: np.ndarray, parts: tw.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each trigram, and bounds of each word's trigrams."""
    size = parts.end - parts.start
    first = np.cumsum(size) - size
    at = np.repeat(parts.start - first, size) + np.arange(int(size.sum()))
    wide = np.empty(len(data) + 2, np.uint32)
    wide[0] = wide[-1] = 32
    wide[1:-1] = data
    # the neighbours of a word are blanks even where another row begins
    left, mid, right = wide[at], wide[at + 1], wide[at + 2]
    left[first] = 32
    right[first + size - 1] = 32
    code = (left << np.uint32(16) | mid << np.uint32(8) | right) * np.uint32(2654435761)
    return (code >> np.uint32(17)).astype(np.int64), first, first + size


def fit(labelled: DataFrame, *, text: str, lang: str, least_share: float = 0.005) -> Model:
    """Count all rows with a text and a language."""
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"),
                                                          F.col(text).cast("string").alias("text"))
    scripts_from = BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for piece in tw.pieces(tw.texts_of(batch.column(1))):
                parts, data, scripts = lettered(piece)
                buckets, first, last = trigrams(data, parts)
                of_row = names[piece.first:piece.first + len(piece)]
                for name in dict.fromkeys(of_row.tolist()):
                    own = of_row == name
                    words = own[parts.row]
                    total = sums.setdefault(name, np.zeros(BUCKETS + len(SCRIPTS), np.int64))
                    total[:BUCKETS] += np.bincount(buckets[np.repeat(words, last - first)], minlength=BUCKETS)
                    total[BUCKETS:] += np.bincount(scripts[words], minlength=len(SCRIPTS))
        for name, total in sums.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(seen), pa.string()), pa.array(seen, pa.int32()),
                                              pa.array(total[seen])], ["lang", "bucket", "n"])

    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n"))
    names = [r[0] for r in rows.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = counts.toArrow()
    place = {name: i for i, name in enumerate(names)}
    total = np.zeros((len(names), BUCKETS + len(SCRIPTS)))
    if table.num_rows:
        which = np.array([place[x] for x in table.column("lang").to_pylist()])
        total[which, table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    logs = np.log((total[:, :BUCKETS] + 0.5) / (total[:, :BUCKETS].sum(1, keepdims=True) + 0.5 * BUCKETS))
    shares = total[:, scripts_from:] / np.maximum(total[:, scripts_from:].sum(1, keepdims=True), 1)
    return Model(names, logs.astype(np.float32), shares >= least_share)


def word_scores(model: Model, data: np.ndarray, parts: tw.Words, scripts: np.ndarray) -> np.ndarray:
    """Log share of each language (columns) for each word."""
    buckets, first, _ = trigrams(data, parts)
    out = np.empty((len(first), len(model.languages)), np.float32)
    for i in range(len(model.languages)):
        out[:, i] = np.add.reduceat(model.logs[i][buckets], first) if len(first) else 0
    allowed = model.scripts[:, scripts].T
    allowed |= ~allowed.any(1, keepdims=True)
    out[~allowed] = -np.inf
    top = out.max(1, keepdims=True)
    out -= top + np.log(np.exp(out - top).sum(1, keepdims=True))
    return np.maximum(out, -20)


def best_paths(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """Language of each word; all texts step together, longest first."""
    n_words, n = scores.shape
    label = np.zeros(n_words, np.int64)
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    starts, counts = bounds[:-1][order], counts[order]
    if not len(counts) or not counts[0]:
        return label
    active = np.searchsorted(-counts, -np.arange(int(counts[0])), "left")  # texts with more than t words
    back = np.empty((n_words, n), np.uint8)
    value = np.zeros((len(counts), n), np.float32)
    own = np.arange(n)
    for t, k in enumerate(active):
        at = starts[:k] + t
        v = value[:k]
        top = v.argmax(1)
        change = v[np.arange(k), top] - penalty
        stay = v >= change[:, None]
        back[at] = np.where(stay, own, top[:, None])
        value[:k] = np.maximum(v, change[:, None]) + scores[at]
    state = value.argmax(1)
    for t in range(len(active) - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        label[at] = state[:k]
        state[:k] = back[at, state[:k]]
    return label


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def label_spans(docs: DataFrame, model: Model, *, text: str, penalty: float = 6.0, name: str = "lang") -> DataFrame:
    """All columns of `docs` with `<name>_pred`, `<name>_score` and `<name>_spans` (language, first
    word, words; words are runs of letters)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = tw.place_of(docs, text)
    tw.refuse_names(docs, f"{name}_pred", f"{name}_score", f"{name}_spans")
    spans_type = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(place).cast(pa.string())), GROUP_BYTES):
                n = len(piece)
                parts_of, scores, letters, base = [], [], [], 0
                bounds = np.zeros(n + 1, np.int64)
                for part in tw.pieces(piece):
                    parts, data, scripts = lettered(part)
                    bounds[part.first + 1:part.first + len(part) + 1] = parts.bounds[1:] + base
                    base += len(parts.start)
                    letters.append(parts.end - parts.start)
                    parts_of.append(parts)
                    if model.languages:
                        scores.append(word_scores(model, data, parts, scripts))
                weight = np.concatenate(letters) if letters else np.zeros(0, np.int64)
                row = np.repeat(np.arange(n), np.diff(bounds))
                pred, score = np.full(n, len(model.languages)), np.zeros(n)
                labels = np.zeros(len(row), np.int64)
                if model.languages:
                    labels = best_paths(np.concatenate(scores), bounds, penalty)
                    k = len(model.languages)
                    share = np.bincount(row * k + labels, weight, n * k).reshape(n, k)
                    total = share.sum(1)
                    # what counts as a letter is settled by its general category
                    ascii_letter = np.add.reduceat(
                        np.append(((piece.data | 32) >= 97) & ((piece.data | 32) <= 122), False), piece.bounds[:-1]) > 0 \
                        if len(piece.data) else np.zeros(n, bool)
                    ascii_letter &= np.diff(piece.bounds) > 0
                    for r in np.flatnonzero(~ascii_letter & (total > 0)).tolist():
                        total[r] *= _has_letter(piece.bytes_of(r))
                    for r in np.flatnonzero((total == 0) & (np.diff(piece.bounds) > 0)).tolist():
                        if _has_letter(piece.bytes_of(r)):
                            share[r, 0], total[r] = 1, k
                    good = total > 0
                    pred[good] = share[good].argmax(1)
                    score[good] = share[good].max(1) / total[good]
                    labels = np.where(good[row], labels, k)
                cuts = np.flatnonzero(np.concatenate([[True], (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])])) \
                    if len(row) else np.zeros(0, np.int64)
                cuts = cuts[pred[row[cuts]] < len(model.languages)]
                length = np.diff(np.append(cuts, len(row)))
                ends = np.searchsorted(row[cuts], np.arange(n + 1))
                spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(names[labels[cuts]], pa.string()), pa.array(cuts - bounds[row[cuts]], pa.int32()),
                     pa.array(np.minimum(length, bounds[row[cuts] + 1] - cuts), pa.int32())],
                    ["lang", "first", "words"]))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(piece.first, n) for c in batch.columns), pa.array(names[pred], pa.string()),
                     pa.array(score), spans.cast(spans_type)],
                    [*batch.schema.names, f"{name}_pred", f"{name}_score", f"{name}_spans"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(tag, f"{own}, `{name}_pred` string, `{name}_score` double, "
                                f"`{name}_spans` array<struct<lang:string,first:int,words:int>>")
