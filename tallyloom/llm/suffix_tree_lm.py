"""Probabilistic suffix tree over words, for scoring texts.

The tree's symbols are lower-cased words and one end mark per text. Its root is the add-one
distribution of all training tokens. A context of up to `depth` words becomes a state if its
next-symbol distribution diverges from that of its longest retained suffix: the gain in log
likelihood must pay `gain` for each continuation kept, and continuations seen `LEAST` times
are kept whatever the size of the corpus. A state gives its kept continuations
their own probability, and shares the rest by its suffix's distribution, so every state sums to
one. A text is scored from the longest retained suffix of the words before each token.

Counting. Words, states and continuations are tables that grow with the corpus. Sequences are
counted level by level: a sequence seen `LEAST` times has parts seen as often, so a bit filter of
the level before leaves out most others (a filter never loses a key).

Scoring. What a state or a continuation adds to what its suffix gives is one number, so the score of
a token is a sum over its contexts. Hot states all of whose words have a share of `node_share` are
arrays (the head), and other numbers of keys seen with a share of `lookup_share` are looked up where a
text is read; both are bounded by the shares. All others are joined with the tables, in `TURNS` parts.

Disk. A level's tables are deleted when the next level is written, and shuffle files when the table they
lead to is; what stays is the words, the kept states and continuations, and the keys to be joined.

Defined results: a null text is the empty text, which has its end mark only; without
training texts every token is unknown and the probability of each is one; a null id is
trained on and not held out; repeated rows each give a row; an empty table gives no rows.
Only the named columns are read; kept columns named like results or `WORKING` are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import discard, written

END = np.uint64(0xE4D)  # the end mark's key; words have 64-bit hashes
BITS = 20  # a sequence of up to three word numbers is one 60-bit key
LEAST = 2  # occurrences of a kept continuation
WORKING = ("_text", "_tokens", "_known", "_base", "_gain", "_asked", "_rare", "_row", "_more", "_add", "_deltas")  # columns of `score`
STEP = np.uint64(0x9FB21C651E98DF25)  # an odd multiplier
STATE = np.uint64(0x5A17E5)  # tells the key of a context from that of the same words as a continuation
FILTER_BITS = 28  # a bit filter has at most 2**28 bits
TURNS = 2  # the joins of scoring take the keys in so many parts, one after the other, to shuffle less at a time
PART = 1 << 21  # rows of a part of a shuffle, on average; a key with more is dealt by its rows' own keys
FLUSH = 1 << 20  # rows that a task packs at a time
MARKS = (58, 52, 46)  # where the six bits of a key that choose a bit of its filter word begin


@dataclass
class Tree:
    """Counts of words (a table), totals, and the arrays tasks score with."""

    counts: DataFrame
    tokens: int
    types: int
    keys: np.ndarray  # hashes of looked-up words, ascending
    n: np.ndarray  # their counts
    number: np.ndarray  # their symbol numbers, or -1
    states: list  # head, per context length: (contexts, log of the share left to the suffix)
    nodes: list  # head, per context length: (context and symbol, log of probability over the root's)
    depth: int
    deltas: DataFrame | None  # all other states and continuations: (key, n, delta in nats)
    hot: np.ndarray  # keys of deltas looked up in tasks, ascending
    hot_delta: np.ndarray
    known: np.ndarray  # bit filter of the keys of deltas
    looked: int  # words and keys of deltas seen so often are looked up in tasks


def _tokens(piece: tw.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with the end marks, their rows, and row bounds."""
    parts = tw.split(piece)
    h = tw.hash_spans(piece.data, parts.start, parts.end, tw.LOWER)
    bounds = parts.bounds + np.arange(len(piece) + 1)
    out = np.empty(bounds[-1], np.uint64)
    row = np.repeat(np.arange(len(piece)), np.diff(bounds))
    ends = bounds[1:] - 1
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word], out[ends] = h, END
    return out, row, bounds


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `wanted` in ascending `keys`, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _sums(batches: Iterator[pa.RecordBatch], keys_of) -> Iterator[pa.RecordBatch]:
    """Counts of the keys of each batch."""
    for batch in batches:
        found = [keys_of(p) for p in tw.pieces(tw.texts_of(batch.column(0)))]
        if found:
            keys, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([tw.signed(keys), pa.array(n)], ["key", "n"])


def _count(texts: DataFrame, keys_of) -> DataFrame:
    return texts.mapInArrow(lambda b: _sums(b, keys_of), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _collect(counts: DataFrame, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of at least `least` occurrences, ascending; their number is bounded by tokens / least."""
    t = counts.where(F.col("n") >= least).toArrow()
    key, n = t.column("key").to_numpy(), t.column("n").to_numpy()
    return key, n


def _numbers(h: np.ndarray, keys: np.ndarray, number: np.ndarray) -> np.ndarray:
    at, there = _find(keys, h)
    return np.where(there, number[at] if len(number) else 0, -1)


def _parts(rows: DataFrame, n: int) -> int:
    """Into how many parts `n` rows are dealt."""
    return max(1, -(-n // PART), min(n >> 16, rows.sparkSession.sparkContext.defaultParallelism))


def _packet_type(width: int) -> str:
    return "part int, side int, " + ", ".join(f"f{i} binary" for i in range(width))


def _packet(place: np.ndarray, fields: list[np.ndarray], parts: int, side: int = 0, width: int = 0) -> pa.RecordBatch:
    """Rows in ascending order of `place` as one row of bytes for each part, which is a range of places."""
    limits = -(-(np.arange(1, parts) << 32) // parts).astype(np.uint64) << np.uint64(32)
    bounds = np.concatenate([[0], np.searchsorted(place, limits), [len(place)]])
    filled = np.flatnonzero(np.diff(bounds))
    ends = np.append(bounds[filled], len(place))
    out = [pa.array(filled, pa.int32()), pa.array(np.full(len(filled), side, np.int32))]
    for f in fields:
        offsets = pa.py_buffer((ends * f.itemsize).astype(np.int32))
        out.append(pa.Array.from_buffers(pa.binary(), len(filled), [None, offsets, pa.py_buffer(np.ascontiguousarray(f))]))
    out += [pa.nulls(len(filled), pa.binary())] * (width - len(fields))
    return pa.RecordBatch.from_arrays(out, ["part", "side", *(f"f{i}" for i in range(len(out) - 2))])


def _blocks(rows: Iterable[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
    """Joins columns of some rows until they are about `FLUSH` rows."""
    held, n = [], 0
    for fields in rows:
        held.append(fields)
        n += len(fields[0])
        if n >= FLUSH:
            yield [np.concatenate(f) for f in zip(*held, strict=True)]
            held, n = [], 0
    if n:
        yield [np.concatenate(f) for f in zip(*held, strict=True)]


def _columns(batches: Iterator[pa.RecordBatch], types: list[str]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        yield [c.to_numpy(zero_copy_only=False).astype(t, copy=False) for c, t in zip(batch.columns, types, strict=True)]


def _packets(rows: Iterable[list[np.ndarray]], place: Callable, parts: int, side: int, width: int) -> Iterator[pa.RecordBatch]:
    """Columns of some rows, dealt by the place that `place` gives each row."""
    for fields in _blocks(rows):
        at = place(*fields)
        order = np.argsort(at)
        yield _packet(at[order], [f[order] for f in fields], parts, side, width)


def _dealt(rows: DataFrame, types: list[str], place: Callable, parts: int, side: int = 0, width: int = 0) -> DataFrame:
    width = width or len(types)
    return rows.mapInArrow(lambda b: _packets(_columns(b, types), place, parts, side, width), _packet_type(width))


def _unpacked(batches: Iterator[pa.RecordBatch], *types: list[str]) -> list[list[np.ndarray]]:
    """The columns of each side, from all packets of one part."""
    found = [[[np.zeros(0, t)] for t in side] for side in types]
    for batch in batches:
        side_of = batch.column(1).to_numpy()
        for side, columns in enumerate(types):
            rows = batch.filter(pa.array(side_of == side))
            for i, t in enumerate(columns if rows.num_rows else []):
                _, offsets, data = rows.column(2 + i).buffers()
                first = rows.column(2 + i).offset
                ends = np.frombuffer(offsets, np.int32)
                found[side][i].append(np.frombuffer(data, np.uint8)[ends[first]:ends[first + rows.num_rows]].view(t))
    return [[np.concatenate(c) for c in side] for side in found]


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    if not len(ordered):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))


def _filter(keys: DataFrame, n: int) -> np.ndarray:
    """Words of bits by key of the column `key`: each key sets a bit of its word for each of `MARKS`."""
    slots = 1 << min(FILTER_BITS, max(10, int(16 * n).bit_length())) - 6
    scale = np.uint64(64 - slots.bit_length() + 1)
    parts = _parts(keys, n)

    def combined(slot: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(slot)
        first = _starts(slot[order])
        return [slot[order][first], np.bitwise_or.reduceat(mask[order], first) if len(first) else mask]

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, in _blocks(_columns(batches, ["u8"])):
            mask = np.zeros(len(key), np.uint64)
            for at in MARKS:
                mask |= np.uint64(1) << (key >> np.uint64(at) & np.uint64(63))
            slot, mask = combined(key & np.uint64(slots - 1), mask)
            yield _packet(slot << scale, [slot.astype("u4"), mask], parts)

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (slot, mask), = _unpacked(batches, ["u4", "u8"])
        slot, mask = combined(slot, mask)
        if len(slot):
            yield pa.RecordBatch.from_arrays([pa.array([f.tobytes()]) for f in (slot, mask)], ["slot", "mask"])

    t = keys.select("key").mapInArrow(marked, _packet_type(2)).repartitionById(parts, F.col("part")) \
        .mapInArrow(united, "slot binary, mask binary").toArrow()
    out = np.zeros(slots, np.uint64)
    for slot, mask in zip(t.column("slot"), t.column("mask"), strict=True):
        out[np.frombuffer(slot.as_buffer(), "u4")] = np.frombuffer(mask.as_buffer(), "u8")
    return out


def _maybe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter."""
    word = bits[(keys & np.uint64(len(bits) - 1)).astype(np.int64)]
    for at in MARKS:
        word = word & (word >> (keys >> np.uint64(at) & np.uint64(63)) & np.uint64(1)) * ~np.uint64(0)
    return word != 0


def _key(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of a sequence from the keys of all but its last and all but its first token."""
    return tw.mix(tw.mix(context) * STEP + suffix)


def _runs(h: np.ndarray, length: int) -> np.ndarray:
    """Keys of the sequences of `length` tokens from each place on, whatever their rows."""
    for _ in range(length - 1):
        h = _key(h[:-1], h[1:])
    return h


def _grams(rows: DataFrame, length: int, bits: np.ndarray, least: int, named: tuple, parts: int) -> DataFrame:
    """Sequences seen `LEAST` times: key, context (all but the last), suffix (all but the first), n, and the
    word numbers packed of those seen `least` times (else -1); `named` has those of the level before by key."""
    shared = rows.sparkSession.sparkContext.broadcast((bits, *named))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        bits = shared.value[0]
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(0))):
                h, row, _ = _tokens(piece)
                n = len(h) - length + 1
                if n <= 0:
                    continue
                part = _runs(h, length - 1)
                there = _maybe(bits, part)
                at = np.flatnonzero((row[:n] == row[length - 1:]) & there[:n] & there[1:n + 1])
                yield [part[at], part[at + 1]]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for context, suffix in _blocks(found(batches)):
            key = _key(context, suffix)
            order = np.argsort(key)
            key = key[order]
            first = _starts(key)
            times = np.diff(first, append=len(key)).astype("i4")
            order = order[first]
            yield _packet(key[first], [context[order], suffix[order], times], parts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (context, suffix, n), = _unpacked(batches, ["u8", "u8", "i4"])
        if not len(n):
            return
        key = _key(context, suffix)
        order = np.argsort(key)
        first = _starts(key[order])
        times = np.add.reduceat(n[order].astype(np.int64), first)
        kept = times >= LEAST
        order, times = order[first[kept]], times[kept]
        packed = np.full(len(order), -1, np.int64)
        often = np.flatnonzero(times >= least)
        if length <= 3 and len(often):
            _, names, numbers = shared.value
            left, right = (_find(names, part[order[often]]) for part in (context, suffix))
            whole = left[1] & right[1]
            packed[often[whole]] = numbers[left[0][whole]] << BITS | numbers[right[0][whole]] & ((1 << BITS) - 1)
        yield pa.RecordBatch.from_arrays([*(tw.signed(f[order]) for f in (key, context, suffix)), pa.array(times), pa.array(packed)],
                                         ["key", "context", "suffix", "n", "packed"])

    return rows.mapInArrow(scan, _packet_type(3)).repartitionById(parts, F.col("part")) \
        .mapInArrow(count, "key long, context long, suffix long, n long, packed long")


def _ended(grams: DataFrame, level: DataFrame, hot: dict, parts: int) -> DataFrame:
    """Sequences with what the level before gives for their suffix, and `seen` of hot contexts (else 0)."""
    shared = grams.sparkSession.sparkContext.broadcast(hot)
    sent = ["u8", "u8", "u8", "i8", "i8"], ["u8", "f8", "f8", "?"]

    def place(key: np.ndarray, context: np.ndarray, suffix: np.ndarray, n: np.ndarray, packed: np.ndarray) -> np.ndarray:
        return np.where(_find(shared.value["key"], suffix)[1], key, suffix)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (key, context, suffix, n, packed), before = _unpacked(batches, *sent)
        hot = shared.value
        before = [np.concatenate([f, hot[c]]) for f, c in zip(before, ("key", "root", "gain", "headed"), strict=True)]
        order = np.argsort(before[0])
        at, there = _find(before[0][order], suffix)
        at = order[at[there]] if len(order) else at
        own, often = _find(hot["key"], context[there])
        seen = np.where(often, hot["n"][own] if len(hot["n"]) else 0, 0)
        yield pa.RecordBatch.from_arrays(
            [tw.signed(key[there]), tw.signed(context[there]), pa.array(n[there]), pa.array(packed[there]),
             *(pa.array(f[at]) for f in before[1:]), pa.array(seen)],
            ["key", "context", "n", "packed", "root", "parent", "headed", "seen"])

    return _dealt(grams, sent[0], place, parts).union(
        _dealt(level.select("key", "root", "gain", "headed"), sent[1], lambda key, *_: key, parts, 1, 5)) \
        .repartitionById(parts, F.col("part")) \
        .mapInArrow(join, "key long, context long, n long, packed long, root double, parent double, headed boolean, seen long")


def _tested(p: np.ndarray, q: np.ndarray, diverge: np.ndarray, kinds: np.ndarray, seen: np.ndarray,
            gain: float) -> tuple[np.ndarray, np.ndarray]:
    """Log of the share a context leaves to its suffix over the suffix's own, and whether it becomes a state."""
    share = np.maximum(1 - p, 1e-12)
    rest = np.log(share / np.maximum(1 - q, 1e-12))
    return rest, seen * (diverge + share * rest) >= gain * (kinds + 1)


def _hot_states(ended: DataFrame, least: int, gain: float) -> dict:
    """The test of hot contexts, whose continuations are in many parts; at most one in `PART` tokens is hot."""
    own, parent = F.log(F.col("n") / (F.col("seen") + 1)), F.col("root") + F.col("parent")
    t = ended.where("seen > 0").groupBy("context").agg(
        F.sum(F.exp(own)).alias("p"), F.sum(F.exp(parent)).alias("q"), F.sum(F.exp(own) * (own - parent)).alias("diverge"),
        F.count("*").alias("kinds"), F.max("seen").alias("seen"),
        (F.every("headed") & (F.min("packed") >= 0) & (F.min("n") >= least)).alias("head")).toArrow()
    c = {name: t.column(name).to_numpy() for name in t.column_names}
    order = np.argsort(c["context"].view(np.uint64))
    rest, state = _tested(*(c[name] for name in ("p", "q", "diverge", "kinds", "seen")), gain)
    return {"context": c["context"].view(np.uint64)[order], "seen": c["seen"][order], "rest": rest[order],
            "state": state[order], "head": c["head"][order].astype(bool)}


def _level(ended: DataFrame, level: DataFrame, hot: dict, least: int, gain: float, parts: int) -> DataFrame:
    """Sequences (with `root`) with what the tree gives them, and the states outside the head (without)."""
    shared = ended.sparkSession.sparkContext.broadcast(hot)
    sent = ["u8", "u8", "i8", "i8", "f8", "f8", "?", "i8"], ["u8", "i8"]

    def place(key: np.ndarray, context: np.ndarray, *rest: np.ndarray) -> np.ndarray:
        return np.where(rest[-1] > 0, key, context)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, (keys, times) = _unpacked(batches, *sent)
        order = np.argsort(rows[1])
        key, context, n, packed, root, parent, headed, seen = (f[order] for f in rows)
        if not len(key):
            return
        hot = shared.value
        first = _starts(context)
        kinds = np.diff(first, append=len(key))
        group = np.repeat(np.arange(len(first)), kinds)
        order = np.argsort(keys)
        at, _ = _find(keys[order], context[first])
        often = seen[first] > 0
        total = seen[first]
        total[~often] = times[order[at[~often]]]
        own, below = np.log(n / (total[group] + 1)), root + parent
        p, q, diverge = (np.add.reduceat(x, first) for x in (np.exp(own), np.exp(below), np.exp(own) * (own - below)))
        rest, state = _tested(p, q, diverge, kinds, total, gain)
        head = np.logical_and.reduceat(headed, first) & (np.minimum.reduceat(packed, first) >= 0) & (
            np.minimum.reduceat(n, first) >= least)
        at = _find(hot["context"], context[first[often]])[0]
        rest[often], state[often], head[often] = (hot[c][at] for c in ("rest", "state", "head"))
        head &= state
        apart = state & ~head
        gained = np.where(state[group], own - root, parent)
        yield pa.RecordBatch.from_arrays(
            [tw.signed(key), pa.array(n), pa.array(packed), pa.array(root), pa.array(gained),
             pa.array(np.where(state[group], head[group], headed)), pa.array(head[group]), pa.array(rest[group], mask=~state[group]),
             pa.array(gained - rest[group] - parent, mask=~apart[group])], names)
        out = np.flatnonzero(apart & ~often)
        none = pa.nulls(len(out), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [tw.signed(context[first[out]] ^ STATE), pa.array(total[out]), pa.array(np.full(len(out), -1)), none, none,
             pa.array(np.zeros(len(out), bool)), pa.array(np.zeros(len(out), bool)), none, pa.array(rest[out])], names)

    names = ["key", "n", "packed", "root", "gain", "headed", "head", "rest", "delta"]
    return _dealt(ended, sent[0], place, parts).union(
        _dealt(level.select("key", "n"), sent[1], lambda key, _: key, parts, 1, 8)) \
        .repartitionById(parts, F.col("part")) \
        .mapInArrow(join, "key long, n long, packed long, root double, gain double, headed boolean, head boolean, "
                          "rest double, delta double")


def fit(texts: DataFrame, *, text: str, node_share: float = 4e-6, lookup_share: float = 1e-6,
        gain: float = 10.0, depth: int = 3) -> Tree:
    """Learn from all rows of `texts`."""
    if depth < 0 or not 2.0**-BITS < node_share < 1 or not 0 < lookup_share <= node_share:
        raise ValueError("depth is not negative, lookup_share at most node_share, node_share above 2**-20")
    spark = texts.sparkSession
    rows = texts.select(F.col(text).cast("string").alias("text"))
    counts, _ = written(_count(rows, lambda p: _tokens(p)[0]), "words")
    total = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, types = total[0] or 0, total[1]
    looked = max(2, int(np.ceil(lookup_share * tokens)))
    key, n = _collect(counts, looked)
    key = key.view(np.uint64)
    order = np.argsort(key)
    keys, n = key[order], n[order].astype(np.int64)
    least = max(2, int(np.ceil(node_share * tokens)))
    frequent = np.flatnonzero(n >= least)
    number = np.full(len(keys), -1, np.int64)
    number[frequent] = np.arange(len(frequent))
    states, nodes, deltas, before = [], [], [], []
    named = keys[frequent], number[frequent]
    # sequences of the level before: how often, the root's probability of the last symbol, what the
    # tree so far gives over the root, and whether that is all in the head
    level = counts.where(F.col("n") >= LEAST).select(
        "key", "n", F.log((F.col("n") + 1) / F.lit(float(tokens + types + 1))).alias("root"),
        F.lit(0.0).alias("gain"), F.lit(True).alias("headed"))
    for length in range(2, depth + 2):
        size = level.count()
        if not size:
            break
        grams, grams_at = written(_grams(rows, length, _filter(level, size), least, named, _parts(rows, tokens)), "grams")
        parts = _parts(rows, size + grams.count())
        t = level.where(F.col("n") >= PART).toArrow()
        often = {c: t.column(c).to_numpy() for c in ("key", "n", "root", "gain", "headed")}
        often = {c: f[np.argsort(often["key"].view(np.uint64))] for c, f in often.items()}
        often |= {"key": often["key"].view(np.uint64), "headed": often["headed"].astype(bool)}
        # two shuffles and two tables, so that the files of one go before the other begins
        ended, ended_at = written(_ended(grams, level, often, parts), "ended")
        discard(spark, grams_at)
        hot = _hot_states(ended, least, gain)
        found, found_at = written(_level(ended, level, hot, least, gain, parts), "level")
        discard(spark, ended_at, *before)
        before = [found_at]
        level = found.where("root IS NOT NULL")
        deltas.append(written(found.where("delta IS NOT NULL").select("key", "n", "delta"), "deltas")[0])
        apart = np.flatnonzero(hot["state"] & ~hot["head"])
        if len(apart):
            deltas.append(spark.createDataFrame(pa.table(
                {"key": tw.signed(hot["context"][apart] ^ STATE), "n": hot["seen"][apart], "delta": hot["rest"][apart]})))
        if length <= 3:
            t = level.where("packed >= 0").select("key", "packed").toArrow()
            names, numbers = t.column("key").to_numpy().view(np.uint64), t.column("packed").to_numpy()
            order = np.argsort(names)
            named = names[order], numbers[order]
            t = level.where("head").select("packed", "gain", "rest").toArrow()
            packed, gained, left = (t.column(c).to_numpy() for c in ("packed", "gain", "rest"))
            order = np.argsort(packed)
            heads, first = np.unique(packed[order] >> BITS, return_index=True)
            states.append((heads, left[order][first]))
            nodes.append((packed[order], gained[order]))
    discard(spark, *before)
    none = np.zeros(0, np.uint64)
    if not deltas:
        return Tree(counts, tokens, types, keys, n, number, states, nodes, depth, None, none, np.zeros(0), np.zeros(1, np.uint64), looked)
    table = deltas[0]
    for more in deltas[1:]:
        table = table.unionByName(more)
    t = table.where(F.col("n") >= looked).toArrow()
    hot, delta = t.column("key").to_numpy().view(np.uint64), t.column("delta").to_numpy()
    order = np.argsort(hot)
    return Tree(counts, tokens, types, keys, n, number, states, nodes, depth, table.where(F.col("n") < looked), hot[order],
                delta[order], _filter(table, table.count()), looked)


def _backed(states: list, nodes: list, key: np.ndarray) -> np.ndarray:
    """Log of probability over the root's of each packed sequence's last symbol, from the longest
    retained suffix of the symbols before it."""
    out = np.zeros(len(key))
    open_ = np.ones(len(key), bool)
    for length in range(len(states), 0, -1):
        own = key & ((1 << BITS * (length + 1)) - 1)
        at, state = _find(states[length - 1][0], own >> BITS)
        state &= open_
        place, node = _find(nodes[length - 1][0], own)
        node &= state
        out[node] += nodes[length - 1][1][place[node]]
        left = state & ~node
        out[left] += states[length - 1][1][at[left]]
        open_ &= ~node
    return out


def _gains(ids: np.ndarray, row: np.ndarray, states: list, nodes: list) -> np.ndarray:
    """As `_backed`, for each token of running texts."""
    n = len(ids)
    out, open_ = np.zeros(n), np.ones(n, bool)
    for length in range(len(states), 0, -1):
        if n <= length:
            continue
        context = np.zeros(n - length, np.int64)
        good = row[:n - length] == row[length:]
        for i in range(length):
            good &= ids[i:n - length + i] >= 0
            context = context << BITS | np.maximum(ids[i:n - length + i], 0)
        at, state = _find(states[length - 1][0], context)
        state &= good & open_[length:]
        symbol = ids[length:]
        place, node = _find(nodes[length - 1][0], context << BITS | np.maximum(symbol, 0))
        node &= state & (symbol >= 0)
        gain = np.where(node, nodes[length - 1][1][place] if len(nodes[length - 1][1]) else 0,
                        states[length - 1][1][at] if len(states[length - 1][1]) else 0)
        out[length:] += np.where(state, gain, 0)
        open_[length:] &= ~node
    return out


def _added(asked: DataFrame, known: DataFrame, deltas: DataFrame, turn: int, parts: int, row_parts: int) -> DataFrame:
    """For each row: how many of its keys are words, the sum of their logs, and the sum of the other keys' deltas."""
    sent = ["u8", "i8"], ["u8", "f8"], ["u8", "f8"]

    def in_turn(rows: Iterable[list[np.ndarray]]) -> Iterator[list[np.ndarray]]:
        for fields in rows:
            now = fields[0] % np.uint64(TURNS) == turn
            yield [f[now] for f in fields]

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for batch in batches:
            piece = tw.texts_of(batch.column(1))
            yield [piece.data.view(np.uint64), np.repeat(batch.column(0).to_numpy(), np.diff(piece.bounds) // 8)]

    def send(rows_of: Callable, side: int) -> Callable:
        return lambda b: _packets(in_turn(rows_of(b)), lambda key, _: key, parts, side, 2)

    def summed(row: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
        order = np.argsort(row)
        first = _starts(row[order])
        return [row[order][first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (key, row), *tables = _unpacked(batches, *sent)
        values = []
        for keys, number in tables:
            order = np.argsort(keys)
            at, there = _find(keys[order], key)
            value = np.zeros(len(key))
            value[there] = number[order[at[there]]]
            values += [there.astype("i8"), value]
        more, add, hit, delta = values
        hit = np.flatnonzero(more | hit)
        yield from _packets([summed(row[hit], [more[hit], add[hit], delta[hit]])], lambda row, *_: tw.mix(row.view(np.uint64)),
                            row_parts, 0, 4)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (row, *values), = _unpacked(batches, ["i8", "i8", "f8", "f8"])
        yield pa.RecordBatch.from_arrays([pa.array(f) for f in summed(row, values)], ["_row", "_more", "_add", "_deltas"])

    dealt = asked.mapInArrow(send(keys_of, 0), _packet_type(2))
    for side, rows in enumerate((known, deltas), 1):
        dealt = dealt.union(rows.mapInArrow(send(lambda b: _columns(b, ["u8", "f8"]), side), _packet_type(2)))
    return dealt.repartitionById(parts, F.col("part")).mapInArrow(join, _packet_type(4)) \
        .repartitionById(row_parts, F.col("part")).mapInArrow(total, "_row long, _more long, _add double, _deltas double")


def score(docs: DataFrame, tree: Tree, *, text: str, keep: list[str]) -> DataFrame:
    """Columns `keep` of every row with n_tokens, n_known, train_tokens, base_score and score
    (log10 probabilities under the root alone and under the tree)."""
    rows = docs.select(*keep)
    tw.refuse_names(rows, "n_tokens", "n_known", "train_tokens", "base_score", "score", *WORKING)
    rows = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(
        {"keys": tree.keys, "n": tree.n, "number": tree.number, "states": tree.states, "nodes": tree.nodes,
         "hot": tree.hot, "delta": tree.hot_delta, "known": tree.known, "depth": tree.depth})
    whole = float(np.log10(tree.tokens + tree.types + 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        logs = np.log10(t["n"] + 1.0)
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(batch.num_columns - 1))):
                n = len(piece)
                h, row, bounds = _tokens(piece)
                at, there = _find(t["keys"], h)
                base = np.bincount(row[there], logs[at[there]], n)
                known = np.bincount(row[there], minlength=n)
                ids = np.where(there, t["number"][at] if len(t["number"]) else 0, -1)
                gain = np.bincount(row, _gains(ids, row, t["states"], t["nodes"]), n)
                rare = np.flatnonzero(~there)
                more_rows, more_keys = [row[rare]], [h[rare]]
                part = h
                for length in range(1, t["depth"] + 1):
                    if len(h) <= length:
                        break
                    good = row[:-length] == row[length:]
                    context, part = part, _key(part[:-1], part[1:])
                    for key in (context[:len(good)] ^ STATE, part):
                        place = np.flatnonzero(good & _maybe(t["known"], key))
                        key = key[place]
                        at, found = _find(t["hot"], key)
                        gain += np.bincount(row[place[found]], t["delta"][at[found]], n)
                        more_rows.append(row[place[~found]])
                        more_keys.append(key[~found])
                more_rows, more_keys = np.concatenate(more_rows), np.concatenate(more_keys)
                order = np.argsort(more_rows, kind="stable")
                asked = np.bincount(more_rows, minlength=n)
                ends = pa.py_buffer((np.append(0, np.cumsum(asked)) * 8).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(piece.first, n) for c in batch.columns[:-1]), pa.array(np.diff(bounds)),
                     pa.array(known.astype(np.int64)), pa.array(base.astype(float)), pa.array(gain / np.log(10)),
                     pa.array(asked), pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(more_keys[order])])], names)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    names = [*keep, "_tokens", "_known", "_base", "_gain", "_asked", "_rare"]
    scanned = rows.mapInArrow(scan, f"{own}{', ' if own else ''}_tokens long, _known long, _base double, "
                                    "_gain double, _asked long, _rare binary").withColumn(
        "_row", F.monotonically_increasing_id())
    scanned, _ = written(scanned, "scored")
    zero = F.lit(0.0)
    known = tree.counts.where(F.col("n") < tree.looked).select("key", F.log10(F.col("n") + F.lit(1.0)).alias("log"))
    deltas = known.select("key", F.lit(0.0).alias("delta")).where("false") if tree.deltas is None else tree.deltas.select(
        "key", (F.col("delta") / F.lit(float(np.log(10)))).alias("delta"))
    asked = scanned.agg(F.sum("_asked"), F.count("*")).first()
    parts = _parts(docs, ((asked[0] or 0) + known.count() + deltas.count()) // TURNS)
    row_parts = _parts(docs, asked[1] * parts)
    found = None
    for turn in range(TURNS):
        part = _added(scanned.select("_row", "_rare"), known, deltas, turn, parts, row_parts)
        part, _ = written(part, "sums")
        found = part if found is None else found.unionByName(part)
    found = found.groupBy("_row").agg(*(F.sum(c).alias(c) for c in ("_more", "_add", "_deltas")))
    base = F.col("_base") + F.coalesce("_add", zero) - F.col("_tokens") * F.lit(whole)
    return scanned.join(found, "_row", "left").select(
        *keep, F.col("_tokens").alias("n_tokens"), (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"),
        F.lit(tree.tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("_gain") + F.coalesce("_deltas", zero)).alias("score"))


def held_out(id: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the id as text falls in `fold` (never for null)."""
    return F.coalesce(F.crc32(id.cast("string")) % folds == fold, F.lit(False))
