"""Exact Jaccard join over word shingles, in tiles of one band of set sizes with bitmap signatures.

Every text has a set of shingles (`shingle` consecutive words, A-Z folded); equal sets are one set
from here on. Two sets are linked if they share at least `similarity` of their union.

1. Tiles. Linked sets of n shingles share k of each other's first n - ceil(similarity * n) + k
   in any common order; here that of hashes, with shingles that many sets hold at the end.
   Sets whose prefix has too few shingles in common with others are out; of the rest, the rarest
   shingles of the prefix are kept, by the same rule. A tile holds the sets with one such shingle in
   one band of sizes (a doubling); sets that may have partners in the next band are guests there.
   Shingles with the same sets make one tile.
2. Bitmaps. Each set has a bitmap of two to four bits a shingle, each shingle toggling one. Sets that
   differ in d shingles differ in d bits at most, so the bit count bounds the overlap from above.
   Inside a tile, sets whose bound allows a link are tied; the components of all ties are clusters.
   Tiles of more than `tile_rows` sets are cut: inside a part the first of similar sets lead, every
   set is tied to the leaders in reach, and only leaders meet across parts (bit counts are a metric,
   so a reach widened by the triangle inequality loses no link).
3. Intersection. Members of a cluster are sent once, in blocks of bounded size, and compared by size, by
   bit count and then by exact intersection of sorted arrays. Sets already joined are not compared
   again. Across blocks one set of each class is asked first, then all outside the largest class.

The order and the ties steer the work only; the links are exact (shingles are 64-bit hashes).

Defined results: texts without words, and null texts, have empty sets and link with nothing; a text
of fewer words than a shingle is one shingle; rows without an id link with nothing and have a null
class; rows that repeat an id are copies of one document and each give a row; an empty table gives
no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.llm.components import components
from tallyloom.llm.lsh_forest import shingle_sets
from tallyloom.session import cut_lineage

# a shingle with this share of all shingles is common: at most 1 / COMMON of them
COMMON = 4e-6
# prefixes are longer by this part of the set, so that partners share as many more of their shingles
SPARE = 10
SKETCH = "doc long, n_shingles long, key long, bits binary, often binary"
TILE = "token long, band int, part int, n long, key long, bits binary"
_BIT = np.uint64(0xA24BAED4963EE407)


def _keys(s: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """An order-free 64-bit key of each set (0 for empty ones)."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = tw.mix(np.add.reduceat(tw.mix(s ^ _BIT), bounds[full]))
    return out


def _reduced(percent: int, n: np.ndarray) -> np.ndarray:
    """How many shingles of a set a partner shares at least."""
    return -(-percent * n // 100)


def _band(n: np.ndarray) -> np.ndarray:
    return np.frexp(np.maximum(n, 1))[1] - 1


def _width(percent: int, n: np.ndarray) -> np.ndarray:
    """Bits of a set's map: 2 to 4 a shingle, for guests of the next band those of that band; 64 at least."""
    band = _band(n)
    guest = 100 * n >= percent * (2 << band)
    return np.maximum(64, 4 << (band + guest))


def bitmaps(s: np.ndarray, bounds: np.ndarray, width: np.ndarray) -> list[np.ndarray]:
    """One map of `width` bits (powers of two) for each set; a shingle toggles one bit."""
    first = np.cumsum(width) - width
    owner = np.repeat(np.arange(len(width)), np.diff(bounds))
    bit = first[owner] + (tw.mix(s * _BIT) & (width[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = (np.bincount(bit, minlength=int(width.sum())) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little")
    return np.split(packed, (first // 8)[1:])


def sketch(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(doc, text) to set sizes, keys and bitmaps; the first row of a piece also carries the shingles
    that several of its sets hold, each with their number."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(1))):
                s, bounds = shingle_sets(piece, shingle)
                n, keys = np.diff(bounds), _keys(s, bounds)
                _, once = np.unique(keys, return_index=True)
                new = np.zeros(len(n), bool)
                new[once] = True
                tokens, count = np.unique(s[np.repeat(new, n)], return_counts=True)
                often = np.stack([tokens[count > 1], count[count > 1].astype(np.uint64)]).tobytes()
                maps = bitmaps(s, bounds, _width(percent, n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array(n), tw.signed(keys),
                     pa.array([m.tobytes() for m in maps], pa.binary()),
                     pa.array([often if i == 0 and len(often) else None for i in range(len(n))], pa.binary())],
                    ["doc", "n_shingles", "key", "bits", "often"])

    return rows.mapInArrow(scan, SKETCH)


def common_shingles(sketches: DataFrame) -> np.ndarray:
    """Shingles that hold a share of COMMON or more of all shingles (64 at least), sorted: a bounded list."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                pair = np.frombuffer(packed, np.uint64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([tw.signed(pair[0]), pa.array(pair[1].astype(np.int64))], ["token", "c"])

    total = sketches.agg(F.sum("n_shingles")).first()[0] or 0
    often = sketches.where("often IS NOT NULL").select("often").mapInArrow(unpack, "token long, c long")
    found = often.groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= max(64, total * COMMON)).select("token")
    return np.sort(found.toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def prefixes(rows: DataFrame, shingle: int, percent: int, often: np.ndarray) -> DataFrame:
    """(token, n, key): the shingles by which a set can be met, once for each set of a task."""
    shared = rows.sparkSession.sparkContext.broadcast(often)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = shared.value, set()
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(0))):
                s, bounds = shingle_sets(piece, shingle)
                n, keys = np.diff(bounds), _keys(s, bounds)
                new = np.zeros(len(n), bool)
                for i, key in enumerate(keys.tolist()):
                    if n[i] and key not in seen:
                        seen.add(key)
                        new[i] = True
                s, owner = s[np.repeat(new, n)], np.repeat(np.flatnonzero(new), n[new])
                if len(common):
                    late = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
                    if late.any():
                        order = np.lexsort((s, late, owner))
                        s, owner = s[order], owner[order]
                start = np.cumsum(n * new) - n * new
                most = n - _reduced(percent, n) + 1 + n // SPARE
                pick = np.arange(len(s)) - start[owner] < most[owner]
                yield pa.RecordBatch.from_arrays([tw.signed(s[pick]), pa.array(n[owner[pick]]), tw.signed(keys[owner[pick]])],
                                                 ["token", "n", "key"])

    return rows.select("text").mapInArrow(scan, "token long, n long, key long")


def survivors(found: DataFrame, percent: int) -> DataFrame:
    """(token, n, key): the rarest of the prefix shingles of the sets that may have a partner.

    A partner shares `least` of a set's prefix at least, so a set with fewer shingles that any
    other set's prefix holds is out; of the others one partner's shingle lies among all but the last
    `least` - 1, in the order of the number of sets, then of hashes."""
    met = found.repartition("token").groupBy("token", "key").agg(F.max("n").alias("n"))
    # the same columns as in the join, so that both read one shuffle
    shared = met.groupBy("token").agg(F.count("*").alias("sets"), F.max("n").alias("longest")).where("sets > 1 AND longest > 0")
    listed = met.join(shared, "token").groupBy("key", "n").agg(
        F.sort_array(F.collect_list(F.struct("sets", "token"))).alias("tokens"))
    need = F.floor((percent * F.col("n") + 99) / 100)
    rest = F.size("tokens") - F.floor(need / SPARE).cast("int")
    return listed.where(rest > 0).select(F.explode(F.slice(F.col("tokens.token"), F.lit(1), rest)).alias("token"), "n", "key")


def tile_rows_of(found: DataFrame, sketches: DataFrame, percent: int, tile_rows: int) -> DataFrame:
    """Rows of the tiles: sets of a band that share a shingle, with their bitmaps."""
    band = F.floor(F.log2("n") + 1e-9).cast("int")
    guest = 100 * F.col("n") >= percent * F.pow(F.lit(2.0), F.col("band") + 1)
    met = found.withColumn("band", band).withColumn(
        "band", F.explode(F.when(guest, F.array("band", F.col("band") + 1)).otherwise(F.array("band"))))
    tiles = met.groupBy("token", "band").agg(F.count("*").alias("sets"), F.bit_xor(F.xxhash64("key")).alias("who")).where("sets > 1")
    # shingles with the same sets make one tile
    tiles = tiles.groupBy("band", "sets", "who").agg(F.min("token").alias("token")).select(
        "token", "band", F.ceil(F.col("sets") / tile_rows).cast("int").alias("parts"))
    met = met.join(tiles, ["token", "band"])
    maps = sketches.where("n_shingles > 0").groupBy("key").agg(F.min("bits").alias("bits"))
    return met.join(maps, "key").select("token", "band", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"),
                                        "n", "key", "bits", "parts")


def _maps_of(bits: list[bytes], band: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit numbers at the width of the band; wider ones are folded."""
    width = max(64, 4 << band) // 8
    out = np.empty((len(bits), width // 8), np.uint64)
    for i, b in enumerate(bits):
        words = np.frombuffer(b, np.uint64)
        while len(words) > out.shape[1]:
            words = words[:len(words) // 2] ^ words[len(words) // 2:]
        out[i] = words
    return out


def _differ(maps: np.ndarray, i: int, rest: np.ndarray) -> np.ndarray:
    return np.bitwise_count(maps[rest] ^ maps[i]).sum(1, dtype=np.int64)


def spanning(n: int, near) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs (i, j) of 0 .. n - 1 for which `near(i, rest)` holds."""
    rest, a, b = np.arange(n), [], []
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            hit = near(i, rest)
            found = rest[hit].tolist()
            a += [i] * len(found)
            b += found
            todo += found
            rest = rest[~hit]
    return a, b


def tied(n: np.ndarray, maps: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Ties of one whole tile: pairs that sizes and bit counts allow to be linked."""

    def near(i: int, rest: np.ndarray) -> np.ndarray:
        return (_differ(maps, i, rest) * (100 + percent) <= (n[rest] + n[i]) * (100 - percent)) \
            & (100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i]))

    return spanning(len(n), near)


def led(n: np.ndarray, maps: np.ndarray, percent: int) -> tuple[list[int], list[int], list[int]]:
    """Leaders of a part of a tile, and ties of its sets to the leaders in reach (one for each class of leaders
    that other ties have not joined yet).

    A set no leader can be linked with leads. For a set X under leader L and a set Y linked with X the
    bits of Y and L differ by r(|X| + |L|) + r(|Y| + |X|) at most, with r = (100 - percent) / (100 + percent)
    and |X| <= 100 |Y| / percent; that is the reach of a tie."""
    r, more = (100 - percent) / (100 + percent), 200 / percent + 1
    leaders, group, a, b = np.zeros(0, np.int64), np.zeros(0, np.int64), [], []
    for i in range(len(n)):
        leads, own = True, i
        if len(leaders):
            d = _differ(maps, i, leaders)
            size = 100 * np.minimum(n[leaders], n[i]) >= percent * np.maximum(n[leaders], n[i])
            reach = np.flatnonzero(d <= r * (more * n[i] + n[leaders]) + 1e-6)
            classes, first = np.unique(group[reach], return_index=True)
            a += [i] * len(first)
            b += leaders[reach[first]].tolist()
            if len(classes):
                own = int(classes[0])
            if len(classes) > 1:
                group[np.isin(group, classes)] = own
            leads = not (size & (d <= r * (n[leaders] + n[i]) + 1e-6)).any()
        if leads:
            leaders, group = np.append(leaders, i), np.append(group, own)
    return leaders.tolist(), a, b


def met_leaders(n: np.ndarray, maps: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Ties between the leaders of all parts of a tile: the reach of linked sets below two leaders."""
    r, more = (100 - percent) / (100 + percent), 200 / percent + 1
    return spanning(len(n), lambda i, rest: _differ(maps, i, rest) <= r * more * (n[i] + n[rest]) + 1e-6)


def _ties(percent: int, across: bool):
    """Ties of sorted tile rows; parts of cut tiles also give their leaders (no b), unless `across`."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in _then_none(batches):
            if batch is not None and not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch]) if batch is not None else None
            t = pa.concat_tables([x for x in (held, t) if x is not None]) if held is not None or t is not None else None
            if t is None:
                break
            place = np.stack([t.column(c).to_numpy() for c in ("token", "band", "part")])
            edges = np.flatnonzero((np.diff(place, axis=1) != 0).any(0)) + 1
            whole = t.num_rows if batch is None else (int(edges[-1]) if len(edges) else 0)
            held = t.slice(whole)
            starts = np.concatenate([[0], edges[edges < whole]]) if whole else np.zeros(0, np.int64)
            n, key = t.column("n").to_numpy(), t.column("key").to_numpy()
            band, parts = t.column("band").to_numpy(), t.column("parts").to_numpy()
            bits = t.column("bits")
            a, b, lead = [], [], []
            for lo, hi in zip(starts.tolist(), np.append(starts[1:], whole).tolist()):
                if hi - lo < 2 and parts[lo] == 1:
                    continue
                maps = _maps_of(bits.slice(lo, hi - lo).to_pylist(), int(band[lo]))
                if across:
                    x, y = met_leaders(n[lo:hi], maps, percent)
                elif parts[lo] == 1:
                    x, y = tied(n[lo:hi], maps, percent)
                else:
                    own, x, y = led(n[lo:hi], maps, percent)
                    lead += [lo + i for i in own]
                a += key[lo + np.array(x, np.int64)].tolist()
                b += key[lo + np.array(y, np.int64)].tolist()
            links = pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
            for name, kind in (("token", pa.int64()), ("band", pa.int32()), ("part", pa.int32()), ("n", pa.int64()),
                               ("key", pa.int64()), ("bits", pa.binary()), ("parts", pa.int32())):
                links = links.append_column(name, pa.nulls(len(a), kind))
            leaders = t.take(pa.array(lead, pa.int64())).select(["token", "band", "part", "n", "key", "bits", "parts"])
            leaders = leaders.add_column(0, "b", pa.nulls(len(lead), pa.int64())).add_column(0, "a", pa.nulls(len(lead), pa.int64()))
            yield from pa.concat_tables([links, leaders.cast(links.schema)]).combine_chunks().to_batches()
            if batch is None:
                break

    return scan


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def candidate_edges(tiles: DataFrame, percent: int) -> DataFrame:
    """Ties (a, b) between keys of sets."""
    columns = ["token", "band", "part", "n", "key", "bits", "parts"]
    schema = f"a long, b long, {TILE}, parts int"
    place = ["token", "band", "part"]
    first = tiles.select(*columns).repartition(*place).sortWithinPartitions(*place, "n", "key").mapInArrow(
        _ties(percent, False), schema)
    first = cut_lineage(first, "ties")
    leaders = first.where("a IS NULL").select(*columns).withColumn("part", F.lit(0))
    more = leaders.repartition("token", "band").sortWithinPartitions("token", "band", "n", "key").mapInArrow(
        _ties(percent, True), schema)
    return first.where("a IS NOT NULL").select("a", "b").unionByName(more.select("a", "b")).distinct()


class _Block:
    """Sorted shingle arrays of some sets, ascending by size, with bitmaps of one width."""

    def __init__(self, t: pa.Table, shingle: int, width: int = 0):
        open_ = zstandard.ZstdDecompressor()
        bodies = [open_.decompress(x) for x in t.column("packed").to_pylist()]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in bodies])]).astype(np.int64)
        sets = []
        for piece in tw.pieces(tw.Texts(np.frombuffer(b"".join(bodies), np.uint8), bounds, np.zeros(len(bodies), bool))):
            s, at = shingle_sets(piece, shingle)
            sets += np.split(s, at[1:-1])
        size = np.array([len(s) for s in sets], np.int64)
        doc = t.column("doc").to_numpy()
        order = np.lexsort((doc, size))
        self.doc, self.size = doc[order], size[order]
        self.root = t.column("root").to_numpy()[order] if "root" in t.column_names else None
        self.sets = [sets[i] for i in order]
        self.every = np.concatenate(self.sets) if sets else np.zeros(0, np.uint64)
        self.first = np.cumsum(self.size) - self.size
        # room for the larger sets, within bounds
        self.width = width or min(1 << 14, max(256, 4 << int(_band(np.median(self.size))))) if sets else 256
        ends = np.concatenate([[0], np.cumsum(self.size)])
        maps = bitmaps(self.every, ends, np.full(len(sets), self.width))
        self.maps = np.stack([np.frombuffer(m.tobytes(), np.uint64) for m in maps]) if sets else np.zeros((0, self.width // 64), np.uint64)

    def linked(self, s: np.ndarray, bits: np.ndarray, rest: np.ndarray, percent: int) -> np.ndarray:
        """Which of `rest` (ascending places) are linked with the set `s`."""
        n = len(s)
        rest = rest[(100 * self.size[rest] >= percent * n) & (percent * self.size[rest] <= 100 * n)]
        differ = np.bitwise_count(self.maps[rest] ^ bits).sum(1, dtype=np.int64)
        rest = rest[differ * (100 + percent) <= (self.size[rest] + n) * (100 - percent)]
        out = []
        # a bounded number of shingles at a time
        step = max(1, (1 << 22) // max(1, 2 * n))
        for at in range(0, len(rest), step):
            some = rest[at:at + step]
            size = self.size[some]
            to = np.cumsum(size) - size
            tokens = self.every[np.repeat(self.first[some] - to, size) + np.arange(int(size.sum()))]
            hit = s[np.minimum(np.searchsorted(s, tokens), n - 1)] == tokens
            common = np.add.reduceat(hit.astype(np.int64), to)
            out.append(some[100 * common >= percent * (size + n - common)])
        return np.concatenate(out) if out else rest


def _inside(percent: int, shingle: int):
    """A spanning forest of the links inside a block."""

    def link(t: pa.Table) -> pa.Table:
        block = _Block(t, shingle)
        rest, a, b = np.arange(len(block.doc)), [], []
        while len(rest):
            todo, rest = [int(rest[0])], rest[1:]
            while todo and len(rest):
                i = todo.pop()
                found = block.linked(block.sets[i], block.maps[i], rest, percent)
                a += [block.doc[i]] * len(found)
                b += block.doc[found].tolist()
                todo += found.tolist()
                rest = np.setdiff1d(rest, found, assume_unique=True)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _across(percent: int, shingle: int):
    """Links from a block of asked sets to the classes of a block of members."""

    def link(members: pa.Table, asked: pa.Table) -> pa.Table:
        a, b = [], []
        if members.num_rows and asked.num_rows:
            block = _Block(members, shingle)
            queries = _Block(asked, shingle, block.width)
            every = np.arange(len(block.doc))
            for i, s in enumerate(queries.sets):
                hit = block.linked(s, queries.maps[i], every[block.root != queries.root[i]], percent)
                for j in hit[np.unique(block.root[hit], return_index=True)[1]].tolist():
                    a.append(queries.doc[i])
                    b.append(block.doc[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _classes(members: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return members.join(found, members.doc == found.node, "left").withColumn("root", F.coalesce("root", "doc")).drop("node")


def _pieces_of(column: str, of: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1)).alias(column)


def confirm(members: DataFrame, shingle: int, percent: int, block_shingles: int) -> DataFrame:
    """Links (a, b) that join the sets of each cluster into their classes."""
    pair = "a long, b long"
    links = cut_lineage(members.groupBy("cluster", "block").applyInArrow(_inside(percent, shingle), pair), "links")
    split = members.where("blocks > 1")
    for step in ("one of each class", "all but the largest class"):
        if split.isEmpty():
            break
        now = cut_lineage(_classes(split, links), "classes")
        if step == "one of each class":
            asked = now.join(now.groupBy("cluster", "root", "block").agg(F.min("doc").alias("doc")),
                             ["cluster", "root", "block", "doc"], "left_semi")
        else:
            largest = now.groupBy("cluster", "root").agg(F.count("*").alias("c")).groupBy("cluster").agg(
                F.max_by("root", F.struct("c", -F.col("root"))).alias("largest"))
            asked = now.join(largest, "cluster").where("root <> largest").drop("largest")
        asked = cut_lineage(asked, "asked")
        lots = asked.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / block_shingles).cast("long").alias("lots"))
        asked = asked.join(lots, "cluster").withColumn("lot", F.pmod(F.xxhash64("doc", F.lit(1)), F.col("lots")))
        asked = asked.select("cluster", "lot", "doc", "root", "packed", _pieces_of("block", "blocks"))
        listed = now.join(lots, "cluster").select("cluster", "block", "doc", "root", "packed", _pieces_of("lot", "lots"))
        on = ["cluster", "block", "lot"]
        more = listed.groupBy(*on).cogroup(asked.groupBy(*on)).applyInArrow(_across(percent, shingle), pair)
        links = links.unionByName(cut_lineage(more, "links"))
    return links


def jaccard_classes(docs: DataFrame, *, id: str, text: str, shingle: int = 5, similarity: float = 0.8,
                    tile_rows: int = 1024, block_shingles: int = 2_000_000) -> DataFrame:
    """One row per row of `docs`: id, n_shingles and component_id (least id reachable by links)."""
    percent = round(similarity * 100)
    if shingle < 1 or not 0.5 <= similarity <= 1 or abs(percent - similarity * 100) > 1e-9:
        raise ValueError("similarity is a whole number of hundredths from 0.5 to 1")
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    sketches = cut_lineage(sketch(rows, shingle, percent), "sketches")
    known = sketches.where("doc IS NOT NULL AND n_shingles > 0")
    sets = cut_lineage(known.groupBy("key").agg(F.min("doc").alias("doc"), F.first("n_shingles").alias("n_shingles")), "sets")
    found = prefixes(rows.where("doc IS NOT NULL"), shingle, percent, common_shingles(sketches))
    found = cut_lineage(survivors(found, percent), "prefixes")
    clusters = components(candidate_edges(tile_rows_of(found, known, percent, tile_rows), percent))
    members = clusters.select(F.col("node").alias("key"), F.col("root").alias("cluster")).join(sets, "key")
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / block_shingles).cast("long").alias("blocks"))
    members = members.join(sizes, "cluster").select(
        "doc", "cluster", "n_shingles", "blocks", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = tw.texts_of(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([squeeze.compress(texts.bytes_of(i)) for i in range(len(texts))], pa.binary())],
                ["doc", "packed"])

    packed = rows.where("doc IS NOT NULL").mapInArrow(pack, "doc long, packed binary")
    # a repeated id is sent once
    members = cut_lineage(members.join(packed, "doc").groupBy("doc", "cluster", "n_shingles", "blocks", "block").agg(
        F.min("packed").alias("packed")), "members")
    classes = components(confirm(members, shingle, percent, block_shingles))
    roots = sets.join(classes, F.col("doc") == F.col("node"), "left").select("key", F.coalesce("root", "doc").alias("class"))
    out = sketches.select("doc", "n_shingles", "key").join(roots, "key", "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc").isNotNull(), F.col("class"))).otherwise(F.col("doc"))
    return out.select(F.col("doc").alias(id), "n_shingles", component.alias("component_id"))
