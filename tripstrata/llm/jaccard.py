"""Join of documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

Exact, and without comparing all pairs:

1. A document's set is its distinct n-grams as 64-bit hashes; documents with equal sets (128-bit
   digest) form a class, which a single representative stands for.
2. *Size bands.* A set of n elements belongs to the band of its binary logarithm, and to the next one
   if a partner there could still be similar. In a band the elements are dealt into classes by hash
   prefix. Similar sets differ in at most ``d = floor(n * (1 - t) / t)`` elements, each of which spoils
   one class. So whatever the order of classes, two similar sets have an equal one among the first
   ``d + 1`` filled classes of either; those classes are the keys. The order is rare first, by a count
   of all n-grams in a fixed number of hash buckets: a passage that many documents share stays out of
   the keys. The number of classes of a band is doubled until every set in it fills more than ``d``.
3. *Tiles.* Sets with a common key are compared with the first of them, in tiles of a few hundred.
   A tile compares hashed bitmaps of 2 to 4 bits per element of the band: a bit tells whether its bucket
   holds an odd number of elements. Every bit in which two bitmaps differ is an element that one side
   lacks, which bounds the overlap from above, at any size. Only what passes is sent as whole sets and
   intersected exactly, as sorted arrays.
4. Links make components. Where a key still has sets of several components, those outside its largest
   one are compared with all sets of the key of other components, in blocks of bounded size, by bitmaps;
   what passes makes families, and the whole sets of a family are compared once, whatever the number of
   its keys (``grouping``). No link between components is lost.

A NULL text is an empty one; empty sets link with nothing. Rows without a ``doc_id`` link and connect
like others but never name a component: theirs is NULL only where no named row is in reach. Rows may
repeat, and columns other than ``doc_id`` and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.buckets import BucketFilter
from tripstrata.llm.components import written
from tripstrata.llm.grouping import Grouping, digests, fresh, near_sizes
from tripstrata.llm.shingles import shingles

U64 = np.uint64
LEAST_BITS = 256
MARK_ELEMENTS = 16_000_000
ORDER_BUCKETS = 1 << 16


def _log2(n: np.ndarray) -> np.ndarray:
    return np.frexp(n.astype(np.float64))[1].astype(np.int64) - 1


def _differences(n: np.ndarray, percent: int) -> np.ndarray:
    """How many elements a similar set may differ in."""
    return n * (100 - percent) // percent


def _classes(sets: np.ndarray, owner: np.ndarray, depth: np.ndarray) -> np.ndarray:
    shift = (64 - depth[owner]).astype(U64)
    return np.where(shift >= U64(64), U64(0), sets >> np.minimum(shift, U64(63)))


def _bands(n: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their bands: the own band, and the next one for those within reach of it."""
    own = _log2(np.maximum(n, 1))
    rows = np.flatnonzero(n > 0)
    yield rows, own[rows]
    near = rows[100 * n[rows] >= percent * (1 << (own[rows] + 1))]
    yield near, own[near] + 1


def _pick(sets: np.ndarray, n: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Elements of the chosen rows, in order."""
    if len(rows) == len(n):
        return sets
    owner, place = W.segments(n[rows])
    return sets[(np.cumsum(n) - n)[rows][owner] + place]


def _needed_depth(sets, n, rows, band, percent) -> np.ndarray:
    """Bits by which each set's band must be refined to fill more classes than can be spoiled."""
    extra = np.zeros(len(rows), np.int64)
    todo = np.arange(len(rows))
    for step in range(64):
        own = n[rows[todo]]
        owner, _ = W.segments(own)
        cls = _classes(_pick(sets, n, rows[todo]), owner, np.minimum(band[todo] + step, 64))
        fresh = np.ones(len(cls), bool)
        fresh[1:] = (cls[1:] != cls[:-1]) | (owner[1:] != owner[:-1])
        filled = np.bincount(owner[fresh], minlength=len(todo))
        todo = todo[filled <= _differences(own, percent)]
        extra[todo] = step + 1
        if not len(todo):
            break
    return extra


def _order_bucket(sets: np.ndarray) -> np.ndarray:
    return (sets & U64(ORDER_BUCKETS - 1)).astype(np.int64)


def _set_rows(width: int, percent: int):
    """A row per document, and one per task with its share of the bucket counts."""

    def rows(batches):
        counts = np.zeros(ORDER_BUCKETS, np.int64)
        for piece in W.pieces(batches, budget=1 << 20):
            sets, n = shingles(piece.column("text"), width)
            counts += np.bincount(_order_bucket(sets), minlength=ORDER_BUCKETS)
            sid = digests(sets, n)
            refine = np.zeros(len(n), np.int64)
            refine_next = np.zeros(len(n), np.int64)
            for (rows, band), out in zip(_bands(n, percent), (refine, refine_next), strict=True):
                out[rows] = _needed_depth(sets, n, rows, band, percent)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id").cast(pa.int64()),
                    "n_shingles": pa.array(n, pa.int64()),
                    "sid": pa.array(np.ascontiguousarray(sid[:, 0])),
                    "sid_b": pa.array(np.ascontiguousarray(sid[:, 1])),
                    "refine": pa.array(refine, pa.int32()),
                    "refine_next": pa.array(refine_next, pa.int32()),
                    "marks": pa.array(parity_bitmaps(sets, n), pa.binary()),
                    "counts": pa.nulls(len(n), pa.binary()),
                }
            )
        empty = {name: pa.nulls(1, kind) for name, kind in _SET_TYPES.items()}
        yield pa.RecordBatch.from_pydict(empty | {"counts": pa.array([counts.tobytes()])})

    return rows


_SET_TYPES = {
    "doc_id": pa.int64(),
    "n_shingles": pa.int64(),
    "sid": pa.int64(),
    "sid_b": pa.int64(),
    "refine": pa.int32(),
    "refine_next": pa.int32(),
    "marks": pa.binary(),
}


def _count_rows(batches):
    for batch in batches:
        for blob in batch.column("counts").to_pylist():
            counts = np.frombuffer(blob, np.int64)
            bucket = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({"bucket": bucket, "n": counts[bucket]})


def _key_rows(width: int, percent: int, depth, common, wanted: BucketFilter | None):
    """(key, sid) of every set, once in a task; with ``wanted`` only of the keys in it."""

    def rows(batches):
        seen: set = set()
        for piece in W.pieces(batches, budget=1 << 20):
            sets, n = shingles(piece.column("text"), width)
            sid = digests(sets, n)
            new = np.flatnonzero((n > 0) & fresh(seen, sid[:, 0], sid[:, 1]))
            sets, sid, n = _pick(sets, n, new), sid[new, 0], n[new]
            found = []
            for rows, band in _bands(n, percent):
                if not len(rows):
                    continue
                own = n[rows]
                owner, _ = W.segments(own)
                part = _pick(sets, n, rows)
                cls = _classes(part, owner, np.minimum(band + depth[band], 64))
                starts = np.ones(len(cls), bool)
                starts[1:] = (cls[1:] != cls[:-1]) | (owner[1:] != owner[:-1])
                begin = np.flatnonzero(starts)
                value = np.add.reduceat(W.mix(part ^ W.PLACES[1]), begin)
                whose = owner[begin]
                key = W.mix(value + W.mix(cls[begin]) * W.PLACES[2] + band[whose].astype(U64))
                rarity = np.minimum.reduceat(common.value[_order_bucket(part)], begin)
                order = np.lexsort((key, rarity, whose))
                rank = W.segments(np.bincount(whose, minlength=len(rows)))[1]
                keep = order[rank <= _differences(own, percent)[whose]]
                found.append(np.stack([key[keep].view(np.int64), sid[rows][whose[keep]]]))
            if not found:
                continue
            key, sid_of = np.concatenate(found, axis=1)
            if wanted is not None:
                ok = wanted.passes(key)
                key, sid_of = key[ok], sid_of[ok]
            for lo in range(0, len(key), 1 << 17):
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(key[lo : lo + (1 << 17)]),
                        "sid": pa.array(sid_of[lo : lo + (1 << 17)]),
                    }
                )

    return rows


def parity_bitmaps(sets: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A bitmap for each set: whether a hash bucket holds an odd number of elements.

    A bucket that is odd on one side only holds an element that the other side lacks. There are 2 to 4 buckets
    per element, a power of two.
    """
    found = [b""] * len(n)
    depth = _log2(np.maximum(n, LEAST_BITS // 4)) + 2
    for d in np.unique(depth):
        rows = np.flatnonzero(depth == d)
        for lo in range(0, len(rows), max(1, (1 << 23) >> int(d))):
            some = rows[lo : lo + max(1, (1 << 23) >> int(d))]
            owner, _ = W.segments(n[some])
            at = (owner << d) + (_pick(sets, n, some) & U64((1 << int(d)) - 1)).astype(np.int64)
            odd = (np.bincount(at, minlength=len(some) << int(d)) & 1).astype(np.uint8)
            packed = np.packbits(odd.reshape(len(some), -1), axis=1, bitorder="little")
            for k, row in zip(some.tolist(), packed, strict=True):
                found[k] = row.tobytes()
    return found


def _folded(marks: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps of half as many buckets, and so on, until ``width`` words are left."""
    while marks.shape[1] > width:
        half = marks.shape[1] // 2
        marks = marks[:, :half] ^ marks[:, half:]
    return marks


def _alike(marks: pa.ChunkedArray, size: np.ndarray, percent: int):
    """Sets whose size and bitmap allow a link.

    The bits in which two bitmaps differ are so many different elements at least, which bounds the overlap
    from above. Of two bitmaps the longer one is folded to the length of the other.
    """
    blobs = marks.to_pylist()
    width = np.array([len(x) for x in blobs]) // 8
    place = np.zeros(len(blobs), np.int64)
    of_width = {}
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        place[rows] = np.arange(len(rows))
        of_width[w] = np.frombuffer(b"".join([blobs[k] for k in rows]), U64).reshape(len(rows), w)

    def pick(i: int, js: np.ndarray) -> np.ndarray:
        js = near_sizes(size, i, js, percent)
        own = int(width[i])
        mine = of_width[own][place[i]][None, :]
        found = []
        for w in (own // 2, own, own * 2):
            rows = js[width[js] == w]
            if not len(rows):
                continue
            theirs = of_width[w][place[rows]]
            least = min(w, own)
            differ = np.bitwise_count(_folded(theirs, least) ^ _folded(mine, least)).sum(axis=1).astype(np.int64)
            both = size[rows] + size[i]
            found.append(rows[(100 + percent) * (both - differ) >= 2 * percent * both])
        return np.concatenate(found) if found else js[:0]

    return pick


class _Join(Grouping):
    alike = staticmethod(_alike)
    mark_elements = MARK_ELEMENTS

    def __init__(self, docs: DataFrame, text: str, width: int, percent: int):
        super().__init__(docs, text, width, percent)
        found = written(
            self.docs.mapInArrow(
                _set_rows(width, percent),
                "doc_id long, n_shingles long, sid long, sid_b long, refine int, refine_next int, "
                "marks binary, counts binary",
            ),
            "sets",
        )
        self.common = _bucket_counts(found.where("counts IS NOT NULL").select("counts"))
        sets = found.where("counts IS NULL")
        self.depth = _band_depths(sets, percent)
        self.signed = sets.select("doc_id", "n_shingles", "sid", "sid_b", "marks")

    def keys(self, wanted: BucketFilter | None = None) -> DataFrame:
        rows = _key_rows(self.width, self.percent, self.depth, self.common, wanted)
        return self.docs.mapInArrow(rows, "key long, sid long")

    def members(self) -> DataFrame:
        """As above, from one shuffle of all keys that both sides of the join read: few keys repeat within a
        task, so counting them there saves nothing, while making them again from the texts costs as much."""
        keys = self.keys().repartition("key")
        shared = keys.groupBy("key").agg(F.min("sid").alias("low"), F.max("sid").alias("high"))
        shared = shared.where("low < high").select("key", "low")
        return written(keys.join(shared.hint("merge"), "key").select("key", "low", "sid").distinct(), "members")


def jaccard_components(
    docs: DataFrame, text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``; see the module."""
    found = _Join(docs, text, width, percent).rows()
    return found.select("doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id"))


def _bucket_counts(blobs: DataFrame):
    """The number of n-grams in each of ``ORDER_BUCKETS`` buckets, sent to every executor."""
    rows = (
        blobs.mapInArrow(_count_rows, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    )
    total = np.zeros(ORDER_BUCKETS, np.int64)
    for bucket, n in rows:
        total[bucket] = n
    return blobs.sparkSession.sparkContext.broadcast(total)


def _band_depths(sets: DataFrame, percent: int) -> np.ndarray:
    """Refinement of each of the 65 bands: the largest that any of its sets needs."""
    own = F.floor(F.log2("n_shingles")).cast("int")
    rows = (
        sets.where("n_shingles > 0")
        .select(
            F.explode(
                F.array(
                    F.struct(own.alias("band"), F.col("refine").alias("refine")),
                    F.struct((own + 1).alias("band"), F.col("refine_next").alias("refine")),
                )
            ).alias("x")
        )
        .groupBy("x.band")
        .agg(F.max("x.refine").alias("refine"))
        .collect()
    )
    depth = np.zeros(66, np.int64)
    for row in rows:
        depth[row["band"]] = max(depth[row["band"]], row["refine"])
    return depth


