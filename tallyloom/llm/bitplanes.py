"""Token ids in files of shuffled bit or byte planes.

Documents are dealt by ranges of their id and sorted, so the files in order of their part
hold all documents in ascending id order. A task encodes its texts, appends the end id to
each, and fills blocks of a fixed number of ids. A block is transposed: plane p holds byte (or
bit) p of every id, and each plane is compressed with zstandard on its own.

File: MAGIC; the compressed planes of all blocks one after the other; then a tail, compressed as
one frame of 64-bit little-endian numbers, and its length in the last 8 bytes. The tail
holds: ids per block, bits per plane (8 or 1), number of blocks, number of documents; the chunk
index (per block: place in the file, number of ids, number of planes, and the length of each
plane, padded with zeros to 32); then the ids and token counts of the documents.

Files are written by the tasks under names of their own; only those a finished task reports
are in the manifest, so a lost executor leaves at most files that nobody reads.

Defined results: a null text is empty and has the end id only; rows without an id come first;
rows that repeat an id each have their place, ordered by text; an empty table gives an empty
manifest and no rows. Only the named columns are read.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import words as tw
from tallyloom.session import cut_lineage, scratch_path

MAGIC = b"BITPLANE1\n"
PLANES = 32
CACHE = 1 << 20
NO_ID = -(1 << 63)  # stands for a null id in the files
MANIFEST = "part int, uri string, n_ids long, n_docs long"
READ_BYTES = 8 << 20

# White space that a pre-tokeniser may join to what follows: texts are cut only before
# ASCII white space that follows anything else.
AFTER_ODD = {b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80\xa8", b"\xe2\x80\xa9", b"\xe2\x80\xaf",
             b"\xe2\x81\x9f", b"\xe3\x80\x80", *(bytes((0xE2, 0x80, i)) for i in range(0x80, 0x8B))}


def shuffle(ids: np.ndarray, bits: int) -> list[bytes]:
    """Planes of a block, the highest ones left out when all zero."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    if bits == 8:
        raw = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
        return [np.ascontiguousarray(raw[:, p]).tobytes() for p in range((top + 7) // 8)]
    return [np.packbits((ids >> np.uint32(p) & np.uint32(1)).astype(np.uint8)).tobytes() for p in range(top)]


def unshuffle(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    ids = np.zeros(n, np.uint32)
    for p, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        part = raw if bits == 8 else np.unpackbits(raw, count=n)
        ids |= part.astype(np.uint32) << np.uint32(p * bits)
    return ids


class PlaneWriter:
    """Appends documents to one file."""

    def __init__(self, out, block_ids: int, bits: int, level: int):
        self.out, self.block_ids, self.bits = out, block_ids, bits
        self.squeeze = zstandard.ZstdCompressor(level=level)
        self.place = len(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.n_ids = 0, 0
        self.index: list[list[int]] = []
        self.docs: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        out.write(MAGIC)

    def add(self, docs: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs)
        self.counts.append(counts)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            every = np.concatenate(self.waiting)
            whole = len(every) // self.block_ids * self.block_ids
            for at in range(0, whole, self.block_ids):
                self._block(every[at:at + self.block_ids])
            self.waiting, self.n_waiting = [every[whole:]], len(every) - whole

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.squeeze.compress(p) for p in shuffle(ids, self.bits)]
        sizes = [len(p) for p in planes]
        self.index.append([self.place, len(ids), len(planes), *sizes, *[0] * (PLANES - len(sizes))])
        for plane in planes:
            self.out.write(plane)
        self.place += sum(sizes)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        docs = np.concatenate([np.zeros(0, np.int64), *self.docs])
        tail = np.concatenate([
            np.array([self.block_ids, self.bits, len(self.index), len(docs)], np.int64),
            np.array(self.index, np.int64).ravel(), docs, np.concatenate([np.zeros(0, np.int64), *self.counts])])
        packed = self.squeeze.compress(tail.astype("<i8").tobytes())
        self.out.write(packed)
        self.out.write(struct.pack("<q", len(packed)))
        self.out.close()


class PlaneReader:
    """Documents and blocks of one file."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        source.seek(size - 8)
        n = struct.unpack("<q", source.read(8))[0]
        source.seek(size - 8 - n)
        tail = np.frombuffer(zstandard.ZstdDecompressor().decompress(source.read(n)), "<i8")
        self.block_ids, self.bits, blocks, docs = (int(x) for x in tail[:4])
        width = 3 + PLANES
        self.index = tail[4:4 + blocks * width].reshape(blocks, width)
        self.docs = tail[4 + blocks * width:][:docs]
        self.counts = tail[4 + blocks * width + docs:][:docs]

    def block(self, number: int) -> np.ndarray:
        place, n, planes, *sizes = self.index[number].tolist()
        self.source.seek(place)
        open_ = zstandard.ZstdDecompressor()
        return unshuffle([open_.decompress(self.source.read(s)) for s in sizes[:planes]], n, self.bits)


# cuts that are handed to the tokenizer at a time
LOT = 1 << 16


class _Encoder:
    """Encodes texts cut before white space, each distinct cut once while it is remembered.

    A byte-level pre-tokeniser never joins what stands before white space to what
    follows, so the ids of a text are those of its cuts in a row. Strings of special tokens hold no
    white space, so none is cut; they are their own ids, or ordinary text with `plain_specials`."""

    def __init__(self, path: str, plain_specials: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if plain_specials:
            self.tokenizer.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def cuts(self, texts: tw.Texts) -> tuple[np.ndarray, np.ndarray]:
        data = texts.data
        space = tw.SPACES[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = space[1:] & ~space[:-1] & ~((data[:-1] >= 0x1C) & (data[:-1] <= 0x1F))
        odd = np.flatnonzero(cut & np.concatenate([[False], data[:-1] >= 0x80]))
        if len(odd):
            two = (data[odd - 2].astype(np.int64) << 8) | data[odd - 1]
            maybe = odd[np.isin(two, [0xC285, 0xC2A0, 0x9A80, 0x819F, 0x8080, *range(0x8080, 0x808B), 0x80A8, 0x80A9, 0x80AF])]
            for i in maybe.tolist():
                if data[i - 2:i].tobytes() in AFTER_ODD or data[i - 3:i].tobytes() in AFTER_ODD:
                    cut[i] = False
        edges = texts.bounds[:-1][np.diff(texts.bounds) > 0]
        cut[edges] = True
        start = np.flatnonzero(cut)
        return start, np.append(start[1:], len(data)) if len(start) else start

    def coded(self, texts: tw.Texts, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some cuts in a row, and their numbers; a lot of cuts is one list of words to the tokenizer."""
        body, flat, numbers = texts.data.tobytes(), [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(start), LOT):
            strings = [body[a:b].decode() for a, b in zip(start[at:at + LOT].tolist(), end[at:at + LOT].tolist())]
            found = self.tokenizer.encode(strings, is_pretokenized=True, add_special_tokens=False)
            flat.append(np.array(found.ids, np.uint32))
            numbers.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(strings)))
        return np.concatenate(flat), np.concatenate(numbers)

    def encode(self, texts: tw.Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        start, end = self.cuts(texts)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        key = tw.hash_spans(texts.data, start, end)
        back, seen = pd.factorize(key)
        where = np.empty(len(seen), np.int64)
        where[back[::-1]] = np.arange(len(key))[::-1]
        order = np.argsort(seen, kind="stable")
        seen, where = seen[order], where[order]
        turn = np.empty(len(order), np.int64)
        turn[order] = np.arange(len(order))
        back = turn[back]
        place = np.searchsorted(self.keys, seen)
        known = np.zeros(len(seen), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == seen[inside]
        if not known.all():
            if len(self.keys) + (~known).sum() > CACHE:
                self.forget()
                known[:], place[:] = False, 0
            new = np.flatnonzero(~known)
            flat, n = self.coded(texts, start[where[new]], end[where[new]])
            first = len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, flat])
            # both lists of keys are sorted: the new ones go between the old
            self.keys = np.insert(self.keys, place[new], seen[new])
            self.first = np.insert(self.first, place[new], first)
            self.n = np.insert(self.n, place[new], n)
            place = np.searchsorted(self.keys, seen)
        n = self.n[place][back]
        ends = np.cumsum(n)
        at = np.repeat(self.first[place][back] - (ends - n), n) + np.arange(int(ends[-1]))
        total = np.concatenate([[0], ends])
        bounds = total[np.searchsorted(start, texts.bounds)]
        return self.ids[at], np.diff(bounds)


_encoders: dict[tuple[str, bool], _Encoder] = {}


def _open(uri: str):
    """File system and path of a URI that names its scheme."""
    scheme, rest = uri.split(":", 1)
    if scheme == "file":
        return pyarrow.fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _qualified(spark, path: str) -> str:
    """`path` with the scheme Spark's file systems give it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    return str(fs.makeQualified(at).toString())


def write_tokens(docs: DataFrame, *, id: str, text: str, tokenizer: str, end_id: int, folder: str | None = None,
                 block_ids: int = 1 << 16, bits: int = 8, level: int = 3, plain_specials: bool = False) -> DataFrame:
    """Write the files and return their manifest: part, uri, n_ids, n_docs, start. Strings of special tokens in a text
    become their ids, as the tokenizer does by itself, or with `plain_specials` those of ordinary text."""
    if bits not in (1, 8) or block_ids < 1:
        raise ValueError("bits is 1 or 8, block_ids positive")
    spark = docs.sparkSession
    base = _qualified(spark, folder or scratch_path(spark, "planes")).rstrip("/")
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, uri = None, ""
        way = (tokenizer, plain_specials)
        coder = _encoders.get(way) or _encoders.setdefault(way, _Encoder(*way))
        for batch in batches:
            doc = batch.column(0).fill_null(NO_ID).to_numpy()
            for piece in tw.pieces(tw.texts_of(batch.column(1)), 4 * tw.PIECE):
                ids, n = coder.encode(piece)
                ends = np.cumsum(n)
                ids = np.insert(ids, ends, np.uint32(end_id))
                if writer is None:
                    uri = f"{base}/part-{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}.planes"
                    fs, path = _open(uri)
                    writer = PlaneWriter(fs.open_output_stream(path), block_ids, bits, level)
                writer.add(doc[piece.first:piece.first + len(piece)].astype(np.int64), n + 1, ids)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([uri]), pa.array([writer.n_ids]),
                 pa.array([sum(map(len, writer.docs))])], ["part", "uri", "n_ids", "n_docs"])

    files = rows.repartitionByRange("doc").sortWithinPartitions("doc", "text").mapInArrow(write, MANIFEST)
    files = cut_lineage(files, "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_tokens(manifest: DataFrame, *, id: str) -> DataFrame:
    """One row per document of the files: id, start (ids before it) and ids (little-endian 32-bit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = _open(uri)
                with fs.open_input_file(path) as source:
                    file = PlaneReader(source)
                    yield from _documents(file, start, id)

    few = manifest.select("part", "uri", "start").repartition(max(1, manifest.count()), "part")
    return few.select("uri", "start").mapInArrow(read, f"`{id}` long, start long, ids binary")


def _documents(file: PlaneReader, start: int, id: str) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(file.counts)
    step = max(1, READ_BYTES // 4)
    at, block, held = 0, 0, np.zeros(0, np.uint32)
    while at < len(ends):
        begin = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, begin + step, "right")))
        need = int(ends[to - 1]) - begin
        got = [held]
        have = len(held)
        while have < need:
            got.append(file.block(block))
            have += len(got[-1])
            block += 1
        held = np.concatenate(got)
        body, held = np.ascontiguousarray(held[:need].astype("<u4")), held[need:]
        bounds = np.concatenate([[begin], ends[at:to]])
        packed = pa.Array.from_buffers(pa.binary(), to - at, [
            None, pa.py_buffer(((bounds - begin) * 4).astype(np.int32).tobytes()), pa.py_buffer(body.tobytes())])
        doc = file.docs[at:to]
        yield pa.RecordBatch.from_arrays([pa.array(doc, mask=doc == NO_ID), pa.array(start + bounds[:-1]), packed],
                                         [id, "start", "ids"])
        at = to
