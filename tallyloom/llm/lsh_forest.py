"""Near duplicates with an LSH forest over word shingles.

Every text has a set of shingles (`shingle` consecutive words, A-Z folded) and a signature of
min-hashes. Texts with equal sets are one text from here on.

Candidates. A tree of the forest is the signature read from another place on: texts are sorted
by it, a region is a run with the same first `DEPTH` values, and neighbours in the order have
the longest common prefixes. Regions of more than `crowd` texts are cut deeper, by the next
value too, and the parts are tied by their least texts. Neighbours whose signatures agree enough
are candidate edges, and components of these make clusters of texts that may be linked.

Confirmation. Each cluster's texts are sent once, in blocks of bounded size. A block computes
exact similarities on full sets; texts that are already in one class are not compared
again. Where a cluster has several blocks, one text of each class, and then every text outside
the cluster's largest class, is compared with all its blocks, so no link between classes is left
out and no pairs are written but those that join classes.

Defined results: texts without words, and null texts, have empty sets and link with nothing; a text
of fewer words than a shingle is one shingle; rows without an id link with nothing and have a
null class; rows that repeat an id are copies of one document and each give a row; an empty
table gives no rows. Only the named columns are read.
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
from tallyloom.session import cut_lineage

VALUES, TREES, DEPTH = 48, 16, 2
# signatures of a pair at the threshold agree in this share less with a chance of about 1e-5
SLACK = 0.25
_STEPS = np.random.default_rng(6).integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SKETCH = "doc long, n_shingles long, key_a long, key_b long, signature binary"
BRANCH = "tree int, region long, next long, doc long, marks binary"


def shingle_sets(piece: tw.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, row after row, and row bounds."""
    parts = tw.split(piece)
    h = tw.hash_spans(piece.data, parts.start, parts.end, tw.LOWER)
    at, row = tw.windows(parts, size)
    s = tw.hash_runs(h, at, at + size)
    few = np.flatnonzero((parts.counts() > 0) & (parts.counts() < size))
    s = np.concatenate([s, tw.hash_runs(h, parts.bounds[few], parts.bounds[few + 1])])
    row = np.concatenate([row, few])
    order = np.lexsort((s, row))
    s, row = s[order], row[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (row[1:] != row[:-1])
    s, row = s[new], row[new]
    return s, np.searchsorted(row, np.arange(len(piece) + 1))


def _sketches(s: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two order-free keys of each non-empty set, and its min-hashes."""
    full = np.flatnonzero(np.diff(bounds))
    first = bounds[full]
    mins = np.empty((len(full), VALUES), np.uint32)
    if len(full):
        for i, step in enumerate(_STEPS):
            mins[:, i] = np.minimum.reduceat(((s ^ (s >> np.uint64(29))) * step) >> np.uint64(32), first)
        a = np.add.reduceat(tw.mix(s), first)
        b = np.bitwise_xor.reduceat(tw.mix(s * np.uint64(3)), first) + np.add.reduceat(s, first)
    else:
        a = b = np.zeros(0, np.uint64)
    return a, b, mins


def sketch(rows: DataFrame, shingle: int) -> DataFrame:
    """(doc, text) to set sizes, set keys and signatures; empty sets have no signature."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(1))):
                s, bounds = shingle_sets(piece, shingle)
                a, b, mins = _sketches(s, bounds)
                n = np.diff(bounds)
                key_a, key_b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                key_a[n > 0], key_b[n > 0] = a, b
                packed = [None] * len(n)
                for place, row in enumerate(np.flatnonzero(n).tolist()):
                    packed[row] = mins[place].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), pa.array(n), tw.signed(key_a), tw.signed(key_b),
                     pa.array(packed, pa.binary())], ["doc", "n_shingles", "key_a", "key_b", "signature"])

    return rows.mapInArrow(scan, SKETCH)


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text and tree: its region, the values after it and one byte of each value."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        doc = batch.column(0).to_numpy()
        values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, VALUES)
        marks = np.ascontiguousarray(values.astype(np.uint8))
        ends = np.arange(n + 1, dtype=np.int32) * VALUES
        packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(marks.tobytes())])
        wide = values.astype(np.uint64)
        for tree in range(TREES):
            at = tree * VALUES // TREES
            v = [wide[:, (at + i) % VALUES] for i in range(DEPTH + 2)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, tree), pa.int32()), tw.signed(v[0] << np.uint64(32) | v[1]),
                 tw.signed(v[2] << np.uint64(32) | v[3]), pa.array(doc), packed],
                ["tree", "region", "next", "doc", "marks"])


def candidate_edges(reps: DataFrame, similarity: float, crowd: int) -> DataFrame:
    """Edges (a, b) between texts with long common prefixes and signatures that agree."""
    branches = reps.select("doc", "signature").mapInArrow(_branches, BRANCH)
    crowded = branches.groupBy("tree", "region").agg(F.count("*").alias("n")).where(F.col("n") > crowd) \
        .select("tree", "region", F.lit(True).alias("deep"))
    rows = branches.join(crowded, ["tree", "region"], "left").withColumn(
        "part", F.when(F.col("deep"), F.shiftright("next", 32)).otherwise(F.lit(0)))
    tied = rows.where("deep").groupBy("tree", "region", "part").agg(F.min("doc").alias("a"))
    tied = tied.join(tied.groupBy("tree", "region").agg(F.min("a").alias("b")), ["tree", "region"]).select("a", "b")
    least = similarity - SLACK

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if held is not None:
                t = pa.concat_tables([held, t])
            held = t.slice(max(0, t.num_rows - 2))
            n = t.num_rows
            place = np.stack([t.column(c).to_numpy() for c in ("tree", "region", "part")])
            doc = t.column("doc").to_numpy()
            marks = np.frombuffer(b"".join(t.column("marks").to_pylist()), np.uint8).reshape(n, VALUES)
            a, b = [], []
            for step in (1, 2):
                if n <= step:
                    continue
                near = (place[:, step:] == place[:, :-step]).all(0)
                agree = (marks[step:] == marks[:-step]).mean(1)
                hit = np.flatnonzero(near & ((agree - 1 / 256) / (1 - 1 / 256) >= least))
                a.append(doc[hit])
                b.append(doc[hit + step])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    keys = ["tree", "region", "part"]
    near = rows.repartition(*keys).sortWithinPartitions(*keys, "next", "doc").select(*keys, "doc", "marks") \
        .mapInArrow(neighbours, "a long, b long")
    return near.unionByName(tied).where("a <> b").distinct()


class _Sets:
    """Full sets of a block's texts, by shingle."""

    def __init__(self, docs: list[int], packed: list[bytes], shingle: int):
        open_ = zstandard.ZstdDecompressor()
        bodies = [open_.decompress(x) for x in packed]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in bodies])]).astype(np.int64)
        texts = tw.Texts(np.frombuffer(b"".join(bodies), np.uint8), bounds, np.zeros(len(bodies), bool))
        sets = []
        for piece in tw.pieces(texts):
            s, at = shingle_sets(piece, shingle)
            sets += np.split(s, at[1:-1])
        self.docs, self.sets = docs, sets
        self.size = np.array([len(s) for s in sets])
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(every, kind="stable")
        self.shingles, self.owner = every[order], owner[order]

    def linked(self, s: np.ndarray, percent: int) -> np.ndarray:
        """Members whose set is similar to `s`."""
        low, high = np.searchsorted(self.shingles, s, "left"), np.searchsorted(self.shingles, s, "right")
        n = high - low
        total = int(n.sum())
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(total)
        common = np.bincount(self.owner[at], minlength=len(self.sets))
        return np.flatnonzero(100 * common >= percent * (self.size + len(s) - common))


def _inside(percent: int, shingle: int):
    """Links that join the classes inside a block."""

    def link(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc", "ascending")])
        block = _Sets(t.column("doc").to_pylist(), t.column("packed").to_pylist(), shingle)
        n = len(block.docs)
        root = np.arange(n)
        a, b = [], []
        done = np.zeros(n, bool)

        def join(i: int) -> None:
            done[i] = True
            for j in block.linked(block.sets[i], percent).tolist():
                if root[i] != root[j]:
                    a.append(block.docs[i])
                    b.append(block.docs[j])
                    low, high = min(root[i], root[j]), max(root[i], root[j])
                    root[root == high] = low

        while True:
            # texts outside the largest class, and one text of it to begin with
            main = np.bincount(root, minlength=n).argmax()
            rest = np.flatnonzero(~done & (root != main))
            if not len(rest):
                break
            join(int(rest[0]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _across(percent: int, shingle: int):
    """Links from asked texts of a cluster to the members of one block in other classes."""

    def link(members: pa.Table, asked: pa.Table) -> pa.Table:
        if not members.num_rows or not asked.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        block = _Sets(members.column("doc").to_pylist(), members.column("packed").to_pylist(), shingle)
        root = members.column("root").to_numpy()
        queries = _Sets(asked.column("doc").to_pylist(), asked.column("packed").to_pylist(), shingle)
        a, b = [], []
        for doc, own, s in zip(queries.docs, asked.column("root").to_pylist(), queries.sets):
            hit = block.linked(s, percent)
            hit = hit[root[hit] != own]
            # one link for each class met
            for j in hit[np.unique(root[hit], return_index=True)[1]].tolist():
                a.append(doc)
                b.append(block.docs[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return link


def _classes(members: DataFrame, links: DataFrame) -> DataFrame:
    """`members` with their root in the link graph (themselves if alone)."""
    found = components(links)
    return members.join(found, members.doc == found.node, "left").withColumn(
        "root", F.coalesce("root", "doc")).drop("node")


def near_duplicates(docs: DataFrame, *, id: str, text: str, shingle: int = 5, similarity: float = 0.8,
                    crowd: int = 10_000, block_shingles: int = 2_000_000) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id (least id reachable) and kept."""
    percent = round(similarity * 100)
    if shingle < 1 or not SLACK < similarity <= 1 or abs(percent - similarity * 100) > 1e-9:
        raise ValueError("similarity is a whole number of hundredths above 0.25")
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    sketches = cut_lineage(sketch(rows, shingle), "sketches")
    sets = sketches.where("doc IS NOT NULL AND n_shingles > 0").groupBy("key_a", "key_b", "n_shingles").agg(
        F.min("doc").alias("doc"), F.min("signature").alias("signature"))
    sets = cut_lineage(sets, "sets")
    clusters = components(candidate_edges(sets, similarity, crowd))
    members = clusters.select(F.col("node").alias("doc"), F.col("root").alias("cluster")).join(
        sets.select("doc", "n_shingles"), "doc")
    sizes = members.groupBy("cluster").agg(
        F.ceil(F.sum("n_shingles") / block_shingles).cast("int").alias("blocks"))
    members = members.join(sizes, "cluster").select(
        "doc", "cluster", "blocks", F.pmod(F.xxhash64("doc"), F.col("blocks")).alias("block"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = tw.texts_of(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([squeeze.compress(texts.bytes_of(i)) for i in range(len(texts))], pa.binary())],
                ["doc", "packed"])

    packed = rows.where("doc IS NOT NULL").mapInArrow(pack, "doc long, packed binary")
    # a repeated id is sent once
    members = cut_lineage(members.join(packed, "doc").groupBy("doc", "cluster", "blocks", "block").agg(
        F.min("packed").alias("packed")), "members")
    pair = "a long, b long"
    links = members.groupBy("cluster", "block").applyInArrow(_inside(percent, shingle), pair)
    links = cut_lineage(links, "links")
    for step in ("one of each class", "all but the largest class"):
        split = members.where("blocks > 1")
        if split.isEmpty():
            break
        split = cut_lineage(_classes(split, links), "classes")
        if step == "one of each class":
            asked = split.join(split.groupBy("cluster", "root", "block").agg(F.min("doc").alias("doc")),
                               ["cluster", "root", "block", "doc"], "left_semi")
        else:
            largest = split.groupBy("cluster", "root").agg(F.count("*").alias("n")).groupBy("cluster").agg(
                F.max_by("root", F.struct("n", -F.col("root"))).alias("largest"))
            asked = split.join(largest, "cluster").where("root <> largest").drop("largest")
        asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - F.lit(1).cast("long"))))
        asked = cut_lineage(asked, "asked")
        more = split.groupBy("cluster", "block").cogroup(asked.groupBy("cluster", "block")).applyInArrow(
            _across(percent, shingle), pair)
        links = links.unionByName(cut_lineage(more, "links"))
    found = components(links)
    roots = sets.select("key_a", "key_b", "n_shingles", "doc").join(found, F.col("doc") == F.col("node"), "left").select(
        "key_a", "key_b", "n_shingles", F.coalesce("root", "doc").alias("class"))
    out = sketches.drop("signature").join(roots, ["key_a", "key_b", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("doc").isNotNull(), F.col("class"))).otherwise(F.col("doc"))
    return out.select(F.col("doc").alias(id), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, *, id: str, text: str, shingle: int = 5, similarity: float = 0.8, **more) -> DataFrame:
    """The rows of `docs` whose id is the least of its class, columns unchanged. Of rows that repeat an id,
    one stays; rows without an id stay."""
    kept = near_duplicates(docs, id=id, text=text, shingle=shingle, similarity=similarity, **more) \
        .where(F.col("kept") & F.col(id).isNotNull()).select(F.col(id).alias("_near_id")).distinct()
    known = docs.where(F.col(id).isNotNull())
    known = known.join(kept, F.col(id).cast("long") == F.col("_near_id"), "left_semi").dropDuplicates([id])
    return known.unionByName(docs.where(F.col(id).isNull()))
