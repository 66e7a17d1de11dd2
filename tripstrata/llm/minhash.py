"""Near copies by SuperMinHash signatures.

1. *Signatures.* A set is a document's distinct word n-grams. Each element draws a random permutation of the
   ``LANES`` places step by step and offers its j-th place the rank ``j + r``; a place keeps its least rank.
   As soon as every place holds a rank below the next step, no element can win any more and all stop. Ranks
   of one element are spread over the places without repetition, which makes the share of equal places
   less variable than independent permutations do.
2. *Banding.* ``BAND`` places make a key. Sets of a similarity of 0.8 share none of the 32 keys with a
   probability of 5e-8 at most, more similar ones far less often.
3. *Verification.* The sets of a key are compared with its first one, in tiles of bounded size. Where fewer
   than ``AGREE`` of the places agree, the pair is left (at 0.8 that happens to a pair with a
   probability of 1e-7 at most); what remains is decided on whole sets, as sorted arrays.
4. *Union-find.* Links make components, inside a tile by a forest, between tiles by rounds of joins. A key that
   still holds several components has the sets outside its largest one compared with all of its sets of other
   components, block by block; families of what passes are then verified on whole sets, each family once.
   No key and no family is cut for its size.

Equal sets are one node, so copies are never compared. A NULL text is an empty one; empty sets link with nothing.
Rows without a ``doc_id`` link and connect like others, but never name a component: theirs is NULL only where
no named row is in reach. Rows may repeat; columns other than ``doc_id`` and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.buckets import BucketFilter
from tripstrata.llm.components import written
from tripstrata.llm.grouping import Grouping, digests, near_sizes
from tripstrata.llm.shingles import shingles

U64 = np.uint64
LANES, BAND = 128, 4
AGREE = 77
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def superminhash(elements: np.ndarray, counts: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Signatures of several sets, whose 64-bit elements follow one another; a row of 32-bit ranks each.

    A place an element has swapped away is looked up among its few earlier steps, so no element holds
    a permutation of its own. Empty sets get rows of the largest value.
    """
    rank = np.full((len(counts), lanes), np.iinfo(U64).max, U64)
    flat = rank.reshape(-1)
    owner, _ = W.segments(counts)
    live = elements
    swapped: list[tuple[np.ndarray, np.ndarray]] = []
    for j in range(lanes):
        if not len(live):
            break
        draw = W.mix(live + U64((j + 1) * _STEP & _MASK))
        k = j + (((draw >> U64(32)) * U64(lanes - j)) >> U64(32)).astype(np.int64)
        place, here = k.copy(), np.full(len(k), j, np.int64)
        for target, moved in swapped:
            np.copyto(place, moved, where=target == k)
            np.copyto(here, moved, where=target == j)
        np.minimum.at(flat, owner * lanes + place, (U64(j) << U64(32)) | (draw & U64(0xFFFFFFFF)))
        settled = (rank.max(axis=1) >> U64(32)) <= U64(j)
        keep = ~settled[owner]
        swapped.append((k, here))
        owner, live = owner[keep], live[keep]
        swapped = [(a[keep], b[keep]) for a, b in swapped]
    return (W.mix(rank) >> U64(32)).astype(np.uint32)


def _signed_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, budget=1 << 20):
            sets, n = shingles(piece.column("text"), width)
            sid = digests(sets, n)
            marks = superminhash(sets, n)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": piece.column("doc_id").cast(pa.int64()),
                    "n_shingles": pa.array(n, pa.int64()),
                    "sid": pa.array(np.ascontiguousarray(sid[:, 0])),
                    "sid_b": pa.array(np.ascontiguousarray(sid[:, 1])),
                    "marks": pa.array([x.tobytes() for x in marks], pa.binary()),
                }
            )

    return rows


def _bands(marks: np.ndarray) -> np.ndarray:
    """The keys of each signature, a column for each band."""
    parts = marks.reshape(len(marks), -1, BAND).astype(U64)
    key = np.arange(parts.shape[1], dtype=U64)[None, :] + np.zeros((len(marks), 1), U64)
    for k in range(BAND):
        key = W.mix(key * W.PLACES[1] + parts[:, :, k])
    return key.view(np.int64)


def _marks_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), LANES)


def _key_rows(wanted: BucketFilter | None) -> Callable:
    """(key, sid) of every signature, once for each batch; with ``wanted`` only of the keys in it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, first = np.unique(batch.column("sid").to_numpy(), return_index=True)
            if not len(sid):
                continue
            key = _bands(_marks_of(batch.column("marks").take(pa.array(first))))
            whose = np.repeat(sid, key.shape[1])
            key = key.ravel()
            if wanted is not None:
                ok = wanted.passes(key)
                key, whose = key[ok], whose[ok]
            for lo in range(0, len(key), 1 << 17):
                part = slice(lo, lo + (1 << 17))
                yield pa.RecordBatch.from_pydict({"key": pa.array(key[part]), "sid": pa.array(whose[part])})

    return rows


def _alike(marks: pa.ChunkedArray, size: np.ndarray, percent: int):
    """Sets whose size and signature allow a link."""
    signed = _marks_of(marks)

    def pick(i: int, js: np.ndarray) -> np.ndarray:
        js = near_sizes(size, i, js, percent)
        return js[(signed[js] == signed[i]).sum(axis=1) >= AGREE] if len(js) else js

    return pick


class _Copies(Grouping):
    alike = staticmethod(_alike)

    def __init__(self, docs: DataFrame, text: str, width: int, percent: int):
        super().__init__(docs, text, width, percent)
        self.signed = written(
            self.docs.mapInArrow(
                _signed_rows(width),
                "doc_id long, n_shingles long, sid long, sid_b long, marks binary",
            ),
            "signed",
        )

    def keys(self, wanted: BucketFilter | None = None) -> DataFrame:
        filled = self.signed.where("n_shingles > 0").select("sid", "marks")
        return filled.mapInArrow(_key_rows(wanted), "key long, sid long")


def near_copies(
    docs: DataFrame, text: str = "text", width: int = 2, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``; see the module.

    ``kept`` is true where a row's id names its component, and for rows without an id that no named
    row is linked with.
    """
    component = F.coalesce("name", "doc_id")
    return _Copies(docs, text, width, percent).rows().select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )
