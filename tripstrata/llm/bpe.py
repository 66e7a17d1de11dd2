"""Encoding and decoding of texts by chunks that documents share.

1. *Chunks.* A rolling hash over 16 bytes cuts each text where the hash has ``CUT_BITS`` zero bits, so
   equal passages give equal chunks wherever they stand.
2. *Reuse.* Digests of all chunks are counted. Chunks found more than once are encoded once, in a
   dictionary table; the others are encoded where they stand. A document without shared chunks is
   finished there and then, and its text never moves.
3. *Joints.* A chunk ends anywhere, also inside a word. Its ids are sure between its first and last safe
   cut (see ``subword``). What lies between the last safe cut of a chunk and the first of the next is
   encoded again as one text, over as many chunks as it takes to reach a safe cut, and takes the place
   of the ids there unless both agree.

The chunk counts, the dictionary and the documents with shared chunks are shuffled; a chunk in very many
documents is counted and deduplicated before the shuffle, and its ids meet its places in a join that
Spark can split. NULL text is an empty one. Rows may repeat; columns other than those used are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.buckets import BucketFilter
from tripstrata.llm.components import written
from tripstrata.llm.subword import Subwords, ends, odd

U64 = np.uint64
CUT_BITS = 10
SHORTEST, LONGEST = 256, 8192


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """Where the chunks of each text end, as byte places in ``data``."""
    h = W._BYTE[data]
    power = W._BASE
    for width in (1, 2, 4, 8):
        shifted = np.zeros_like(h)
        shifted[width:] = h[:-width]
        h = h + shifted * power
        power = U64(int(power) * int(power) & (2**64 - 1))
    cut = (W.mix(h) >> U64(64 - CUT_BITS)) == 0
    whole = np.ones(len(data) + 1, bool)  # places where a character begins
    whole[:-1] = (data & 0xC0) != 0x80
    places = np.flatnonzero(cut & whole[1:]) + 1
    out = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        found, at = [], begin
        near = places[np.searchsorted(places, begin) : np.searchsorted(places, end)].tolist()
        for place in [*near, end]:
            while place - at > LONGEST:
                stop = at + LONGEST
                while not whole[stop]:
                    stop -= 1
                found.append(stop)
                at = stop
            if place - at >= SHORTEST or place == end:
                if place > at or not found:
                    found.append(place)
                at = place
        out.append(found)
    return out


def _chunks(piece: pa.RecordBatch):
    """Per text: its bytes and the chunks' digests and texts. Odd texts are a single chunk."""
    data, offsets = W.raw(piece.column("text"))
    blob = data.tobytes()
    for begin, stops in zip(offsets[:-1].tolist(), chunk_ends(data, offsets), strict=True):
        parts, at = [], begin
        for stop in stops:
            parts.append(blob[at:stop])
            at = stop
        if len(parts) > 1 and odd(blob[begin:at].decode()):
            parts = [blob[begin:at]]
        yield [(xxhash.xxh3_128_intdigest(x), x) for x in parts]


def _halves(digest: int) -> tuple[int, int]:
    low, high = digest & (2**64 - 1), digest >> 64
    return low - (low >> 63 << 64), high - (high >> 63 << 64)


def _digest_rows(batches):
    for piece in W.pieces(batches):
        found = [_halves(d) for chunks in _chunks(piece) for d, _ in chunks]
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _shared_rows(wanted: BucketFilter):
    """Texts of the chunks that may be shared, once per batch."""

    def rows(batches):
        for piece in W.pieces(batches):
            found = {}
            for chunks in _chunks(piece):
                for digest, text in chunks:
                    if digest not in found and digest & (2**64 - 1) in wanted:
                        found[digest] = text.decode()
            a, b = zip(*map(_halves, found), strict=True) if found else ((), ())
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(a, pa.int64()),
                    "b": pa.array(b, pa.int64()),
                    "text": pa.array(list(found.values()), pa.string()),
                }
            )

    return rows


_PART = {
    "ids": pa.binary(),
    "head": pa.string(),
    "tail": pa.string(),
    "n_head": pa.int32(),
    "n_tail": pa.int32(),
}
_PART_DDL = "ids binary, head string, tail string, n_head int, n_tail int"


def _encoded(words: Subwords, texts: list[str]) -> dict[str, list]:
    """Ids of chunks, with the texts outside their safe cuts and the ids those have so far."""
    cuts = [ends(x) for x in texts]
    head = [x if a < 0 else x[:a] for x, (a, _) in zip(texts, cuts, strict=True)]
    tail = [None if b < 0 else x[b:] for x, (_, b) in zip(texts, cuts, strict=True)]
    n_head = [len(x) // words.kind.itemsize for x in words.encode(head)]
    n_tail = [len(x) // words.kind.itemsize for x in words.encode([x or "" for x in tail])]
    return {"ids": words.encode(texts), "head": head, "tail": tail, "n_head": n_head, "n_tail": n_tail}


def joined(words: Subwords, parts: list[dict]) -> bytes:
    """The ids of a text from those of its chunks."""
    if len(parts) == 1:
        return parts[0]["ids"]
    size, out, open_text, open_ids = words.kind.itemsize, [], "", b""
    for part in parts:
        ids = part["ids"]
        if part["tail"] is None:  # no safe cut: the whole chunk may join with both neighbours
            open_text, open_ids = open_text + part["head"], open_ids + ids
            continue
        split = part["n_head"] * size
        out.append(_repaired(words, open_text, part["head"], open_ids, ids[:split]))
        last = len(ids) - part["n_tail"] * size
        out.append(ids[split:last])
        open_text, open_ids = part["tail"], ids[last:]
    out.append(_repaired(words, open_text, "", open_ids, b""))
    return b"".join(out)


def _repaired(words: Subwords, left: str, right: str, left_ids: bytes, right_ids: bytes) -> bytes:
    again = words.encode([left + right])[0] if left or right else b""
    return left_ids + right_ids if again == left_ids + right_ids else again


def _result(words: Subwords, doc_id: list, ids: list[bytes], keep_ids: bool) -> dict:
    wide = [words.wide(x) for x in ids]
    decoded = [words.decode(x).encode() for x in ids]
    out = {
        "doc_id": pa.array(doc_id, pa.int64()),
        "n_tokens": pa.array([len(x) // 4 for x in wide], pa.int64()),
        "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in wide], pa.string()),
        "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
    }
    if keep_ids:
        out["ids"] = pa.array(wide, pa.binary())
        out["decoded"] = pa.array([x.decode() for x in decoded], pa.string())
    return out


def _document_rows(tokenizer: str, wanted: BucketFilter, keep_ids: bool):
    """Finished documents, and for the others a row per chunk: encoded, or named by its digest."""

    def rows(batches):
        words = Subwords.of(tokenizer)
        for piece in W.pieces(batches):
            key, doc_id = piece.column("key").to_pylist(), piece.column("doc_id").to_pylist()
            whole, texts, at, alone = [], [], [], []
            for k, chunks in enumerate(_chunks(piece)):
                shared = [d & (2**64 - 1) in wanted for d, _ in chunks]
                if not any(shared):
                    whole.append(k)
                    continue
                for place, ((digest, text), common) in enumerate(zip(chunks, shared, strict=True)):
                    at.append((key[k], doc_id[k], place, *_halves(digest)))
                    alone.append(not common)
                    if not common:
                        texts.append(text.decode())
            text = piece.column("text")
            done = words.encode([text[k].as_py() for k in whole])
            first = _result(words, [doc_id[k] for k in whole], done, keep_ids)
            found = _encoded(words, texts)
            fill = {c: iter(v) for c, v in found.items()}
            second = {
                c: pa.array([next(fill[c]) if own else None for own in alone], kind)
                for c, kind in _PART.items()
            }
            for c, values in zip(
                ("key", "doc_id", "place", "a", "b"), zip(*at, strict=True) if at else [()] * 5, strict=True
            ):
                second[c] = pa.array(values, pa.int64())
            names = [*_DONE, *(("ids_out", "decoded") if keep_ids else ())]
            if keep_ids:
                first["ids_out"] = first.pop("ids")
            yield _stacked(first, second, names)

    return rows


_DONE = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
_OUT = {"ids_out": pa.binary(), "decoded": pa.string()}


def _stacked(first: dict, second: dict, done: list[str]) -> pa.RecordBatch:
    n, m = len(first["doc_id"]), len(second["doc_id"])
    kinds = {"key": pa.int64(), "doc_id": pa.int64(), "place": pa.int64(), "a": pa.int64(), "b": pa.int64()}
    kinds |= _PART | {c: (_DONE | _OUT)[c] for c in done}
    columns = {}
    for c, kind in kinds.items():
        top = first[c] if c in first else pa.nulls(n, kind)
        low = second[c] if c in second else pa.nulls(m, kind)
        columns[c] = pa.concat_arrays([top, low])
    return pa.RecordBatch.from_pydict(columns)


def _dictionary_rows(tokenizer: str):
    def rows(batches):
        words = Subwords.of(tokenizer)
        for piece in W.pieces(batches):
            found = _encoded(words, piece.column("text").to_pylist())
            columns = {"a": piece.column("a"), "b": piece.column("b")}
            yield pa.RecordBatch.from_pydict(
                columns | {c: pa.array(found[c], kind) for c, kind in _PART.items()}
            )

    return rows


def _joined_rows(tokenizer: str, keep_ids: bool):
    def rows(batches):
        words = Subwords.of(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                ids = [joined(words, x) for x in part.column("parts").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    _result(words, part.column("doc_id").to_pylist(), ids, keep_ids)
                )

    return rows


def encode_documents(
    docs: DataFrame, tokenizer: str, text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``.

    ``keep_ids`` adds the ids (binary, 32-bit little-endian) and the decoded text. The digests are those of
    the same bytes and of the decoded text in UTF-8.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    shared = written(
        plain.mapInArrow(_digest_rows, "a long, b long")
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("a"),
        "shared_chunks",
    )
    wanted = BucketFilter(shared, F.col("a"))
    dictionary = (
        plain.mapInArrow(_shared_rows(wanted), "a long, b long, text string")
        .groupBy("a", "b", "text")
        .agg(F.lit(1))
        .mapInArrow(_dictionary_rows(tokenizer), f"a long, b long, {_PART_DDL}")
    )
    dictionary = written(dictionary, "chunk_dictionary")
    extra = ", ids_out binary, decoded string" if keep_ids else ""
    rows = written(
        plain.withColumn("key", F.monotonically_increasing_id()).mapInArrow(
            _document_rows(tokenizer, wanted, keep_ids),
            "key long, doc_id long, place long, a long, b long, "
            f"{_PART_DDL}, n_tokens long, ids_sha256 string, decoded_sha256 string{extra}",
        ),
        "encoded",
    )
    columns = [F.col(c.split()[0]) for c in _PART_DDL.split(", ")]
    part = F.struct("place", *columns).alias("part")
    open_rows = rows.where("key IS NOT NULL")
    own = open_rows.where("ids IS NOT NULL").select("key", "doc_id", part)
    reused = (
        open_rows.where("ids IS NULL")
        .select("key", "doc_id", "place", "a", "b")
        .join(dictionary, ["a", "b"])
        .select("key", "doc_id", part)
    )
    assembled = (
        own.unionByName(reused)
        .groupBy("key", "doc_id")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .select("doc_id", "parts")
    )
    done = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if keep_ids:
        done += [F.col("ids_out").alias("ids"), "decoded"]
    finished = rows.where("key IS NULL").select(*done)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids binary, decoded string" if keep_ids else ""
    return finished.unionByName(assembled.mapInArrow(_joined_rows(tokenizer, keep_ids), schema))
