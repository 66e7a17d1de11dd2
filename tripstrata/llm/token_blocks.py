"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of a range of documents, one after another, in blocks of ``BLOCK`` ids. A block
stores its minimum, the differences to it packed at the bit width that ``PERCENTILE`` percent of them
need, and the high bits of the others in a list of exceptions. Behind the blocks come the documents'
ids and lengths and the place of every block, so that any stretch of ids is read by opening only its
blocks.

    magic, blocks, footer (document ids, lengths, block places), counts of both, magic

Each task writes a file under a name of its own and reports it in a row; the stored rows are the
manifest, and a file that is not in it, left by a lost or repeated task, is never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.components import written
from tripstrata.llm.subword import Subwords
from tripstrata.session import scratch_dir

TEXTS = 4 << 20
BLOCK = 512
PERCENTILE = 90
MAGIC = b"PFORTOK1"
NO_ID = -(1 << 63)
_HEAD = struct.Struct("<IHBH")


def _width(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def _unsigned(width: int) -> np.dtype:
    """The integers that numbers of so many bits are packed from."""
    return np.dtype("<u2" if width <= 16 else "<u4")


def pack(ids: np.ndarray) -> list[bytes]:
    """Blocks of at most ``BLOCK`` ids each."""
    if not len(ids):
        return []
    count = -(-len(ids) // BLOCK)
    sizes = np.full(count, BLOCK)
    sizes[-1] = len(ids) - BLOCK * (count - 1)
    table = np.full(count * BLOCK, ids[-1], ids.dtype)
    table[: len(ids)] = ids
    table = table.reshape(count, BLOCK)
    base = table.min(axis=1)
    rest = (table - base[:, None]).astype("<u2" if ids.dtype.itemsize <= 2 else "<u4", copy=False)
    ranked = np.sort(rest, axis=1)
    width = _width(ranked[:, (BLOCK - 1) * PERCENTILE // 100])
    out: list[bytes] = [b""] * count
    for w in np.unique(width).tolist():
        for rows in np.array_split(np.flatnonzero(width == w), max(1, (width == w).sum() // 256)):
            values = rest[rows]
            raw = values.astype(_unsigned(w)).view(np.uint8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(rows), BLOCK, -1)[:, :, :w]
            packed = np.packbits(bits.reshape(len(rows), -1), axis=1)
            over = values.astype(np.int64) >> w
            over[np.arange(BLOCK) >= sizes[rows, None]] = 0
            row, at = np.nonzero(over)
            high = over[row, at].astype("<u4").tobytes()
            at = at.astype("<u2").tobytes()
            ends = np.cumsum(np.bincount(row, minlength=len(rows))).tolist()
            heads = zip(rows.tolist(), base[rows].tolist(), sizes[rows].tolist(), [0, *ends], ends, strict=False)
            for body, (k, low, n, a, b) in zip(packed, heads, strict=True):
                out[k] = (
                    _HEAD.pack(low, n, w, b - a)
                    + body[: -(-n * w // 8)].tobytes()
                    + at[2 * a : 2 * b]
                    + high[4 * a : 4 * b]
                )
    return out


def unpack(block: bytes) -> np.ndarray:
    return unpack_all(block, np.array([0, len(block)]))


def unpack_all(blocks: bytes, places: np.ndarray) -> np.ndarray:
    """The ids of blocks that follow one another; ``places`` are where each begins, and the end of the last."""
    data, begin = np.frombuffer(blocks, np.uint8), places[:-1]
    fields = [("base", "<u4"), ("n", "<u2"), ("width", "u1"), ("exceptions", "<u2")]
    heads = data[begin[:, None] + np.arange(_HEAD.size)].view(fields)[:, 0]
    sizes, widths = heads["n"].astype(np.int64), heads["width"].astype(np.int64)
    first = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), "<u4")
    for n, w in sorted(set(zip(sizes.tolist(), widths.tolist(), strict=True))):
        rows = np.flatnonzero((sizes == n) & (widths == w))
        at = begin[rows] + _HEAD.size
        size = -(-n * w // 8)
        bits = np.unpackbits(data[at[:, None] + np.arange(size)], axis=1, count=n * w)
        wide = np.zeros((len(rows), n, 8 * _unsigned(w).itemsize), np.uint8)
        wide[:, :, :w] = bits.reshape(len(rows), n, w)
        low = np.packbits(wide.reshape(-1), bitorder="little").view(_unsigned(w)).reshape(len(rows), n)
        values = low + heads["base"][rows, None]
        at, more = at + size, heads["exceptions"][rows].astype(np.int64)
        owner, k = W.segments(more)
        place = data[(at[owner] + 2 * k)[:, None] + np.arange(2)].view("<u2")[:, 0]
        high = data[(at[owner] + 2 * more[owner] + 4 * k)[:, None] + np.arange(4)].view("<u4")[:, 0]
        values[owner, place] += high << np.uint32(w)
        out[first[rows, None] + np.arange(n)] = values
    return out


class Writer:
    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self._out = system.open_output_stream(path)
        self._out.write(MAGIC)
        self._at = len(MAGIC)
        self._docs: list[np.ndarray] = []
        self._lengths: list[np.ndarray] = []
        self._places: list[int] = []
        self._rest = np.zeros(0, np.uint16)

    def add(self, doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self._docs.append(doc_ids.astype("<i8"))
        self._lengths.append(lengths.astype("<u4"))
        ids = np.concatenate([self._rest, ids])
        full = len(ids) // BLOCK * BLOCK
        self._put(ids[:full])
        self._rest = ids[full:]

    def _put(self, ids: np.ndarray) -> None:
        for block in pack(ids):
            self._places.append(self._at)
            self._out.write(block)
            self._at += len(block)

    def close(self) -> None:
        self._put(self._rest)
        places = np.array([*self._places, self._at], "<u8")
        for part in (*self._docs, *self._lengths):
            self._out.write(part.tobytes())
        self._out.write(places.tobytes())
        self._out.write(struct.pack("<QQ", sum(map(len, self._docs)), len(places)) + MAGIC)
        self._out.close()


class Reader:
    def __init__(self, uri: str):
        system, path = fs.FileSystem.from_uri(uri)
        self._file = system.open_input_file(path)
        size = self._file.size()
        tail = self._file.read_at(24, size - 24)
        docs, places = struct.unpack_from("<QQ", tail)
        if tail[16:] != MAGIC:
            raise ValueError(f"{uri} is not a complete file of token blocks")
        footer = self._file.read_at(12 * docs + 8 * places, size - 24 - 12 * docs - 8 * places)
        self.doc_ids = np.frombuffer(footer, "<i8", docs)
        self.lengths = np.frombuffer(footer, "<u4", docs, 8 * docs).astype(np.int64)
        self.places = np.frombuffer(footer, "<u8", places, 12 * docs).astype(np.int64)
        self.ends = np.cumsum(self.lengths)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop`` of the file; reads the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // BLOCK, (stop - 1) // BLOCK
        data = self._file.read_at(
            int(self.places[last + 1] - self.places[first]), int(self.places[first])
        )
        found = unpack_all(data, self.places[first : last + 2] - self.places[first])
        return found[start - first * BLOCK : stop - first * BLOCK]

    def documents(self, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """Place and ids of each document; about ``most`` ids are in memory."""
        row = 0
        while row < len(self.ends):
            start = int(self.ends[row] - self.lengths[row])
            stop = max(row + 1, int(np.searchsorted(self.ends, start + most, side="right")))
            ids = self.ids(start, int(self.ends[stop - 1]))
            for k in range(row, stop):
                end = int(self.ends[k]) - start
                yield k, start, ids[end - int(self.lengths[k]) : end]
            row = stop

    def close(self) -> None:
        self._file.close()


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> DataFrame:
    """Encode all texts, with ``end_id`` after each, into files in ascending ``doc_id`` order.

    Returns the manifest: ``path, n_docs, n_tokens, first_doc, first_hash`` of each file. The folder's file system is
    any that pyarrow opens by its address, and has to be one that all executors share. A NULL text is
    an empty one, NULL ``doc_id`` come first, equal ones in the order of a hash of their texts, so that the rows
    of one id are dealt to several files.
    """
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)

    def rows(batches):
        words, out, uri = Subwords.of(tokenizer), None, ""
        docs = tokens = 0
        first = first_hash = None
        for piece in W.pieces(batches, budget=TEXTS):
            if out is None:
                uri = f"{folder}/tokens-{uuid.uuid4().hex}.pfor"
                out, first = Writer(uri), piece.column("doc_id")[0].as_py()
                first_hash = piece.column("text_hash")[0].as_py()
            ids, lengths = words.encode_array(piece.column("text"))
            kind = np.promote_types(ids.dtype, np.min_scalar_type(end_id))
            ids = np.insert(ids.astype(kind, copy=False), np.cumsum(lengths), end_id)
            lengths += 1
            out.add(piece.column("doc_id").fill_null(NO_ID).to_numpy(), lengths, ids)
            docs, tokens = docs + len(lengths), tokens + len(ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict(
                {
                    "path": pa.array([uri]),
                    "n_docs": pa.array([docs], pa.int64()),
                    "n_tokens": pa.array([tokens], pa.int64()),
                    "first_doc": pa.array([first], pa.int64()),
                    "first_hash": pa.array([first_hash], pa.int64()),
                }
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
        .repartitionByRange("doc_id", "text_hash")
        .sortWithinPartitions("doc_id", "text_hash", "text")
    )
    schema = "path string, n_docs long, n_tokens long, first_doc long, first_hash long"
    return written(ordered.mapInArrow(rows, schema), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from its ids in the files."""

    def rows(batches):
        for batch in batches:
            for path, offset in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
                reader, crc = Reader(path), []
                for _, _, ids in reader.documents():
                    crc.append(zlib.crc32(ids))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(reader.doc_ids, mask=reader.doc_ids == NO_ID),
                        "start": pa.array(reader.ends - reader.lengths + offset),
                        "n_tokens": pa.array(reader.lengths),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )
                reader.close()

    before = Window.orderBy(F.col("first_doc").asc_nulls_first(), "first_hash").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = manifest.select(
        "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset")
    )
    files = max(1, manifest.count())
    return placed.repartition(files).mapInArrow(
        rows, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_files_roundtrip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the ids of all documents and read them back."""
    folder = scratch_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer, end_id, folder))
