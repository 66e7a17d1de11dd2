"""Words of a batch of texts as arrays: the ground on which several operators stand.

A word is a longest run of bytes other than space and the controls 9 to 13. These bytes never occur
inside a longer UTF-8 character, so a text can be cut at byte level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_FOLDING = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LONG = 64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_IN_WORDS, _IN_FOLDED = (np.where(SPACE, U64(0), x) for x in (_BYTE, _FOLDED))
_BASE = U64(0x9E3779B97F4A7C15)
PLACES = _RANDOM.integers(1, 2**63, 8, dtype=U64) * U64(2) + U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits; one to one on 64-bit values."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def pieces(
    batches: Iterator[pa.RecordBatch], text: str = "text", budget: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``budget`` bytes of text, or one row; nulls become ''."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(text)
        filled = batch.column(at).cast(pa.large_string()).fill_null("")
        batch = batch.set_column(at, text, filled)
        ends = np.cumsum(np.diff(_offsets(filled)))
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + budget, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _offsets(texts: pa.LargeStringArray) -> np.ndarray:
    whole = np.frombuffer(texts.buffers()[1], np.int64)
    return whole[texts.offset : texts.offset + len(texts) + 1]


@dataclass
class Words:
    """``data`` are the bytes of all texts; word k is ``data[start[k]:end[k]]`` of text ``doc[k]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)


def raw(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts and where each begins."""
    offsets = _offsets(texts)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.LargeStringArray) -> Words:
    data, offsets = raw(texts)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, start, end, doc, first)


def with_space(texts: pa.LargeStringArray, whole: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The texts cut behind every word, so that a piece is a word and the space before it, and each text's first piece.

    Space at the end of a text is a piece, a text marked ``whole`` is one, and an empty text has none.
    """
    data, offsets = raw(texts)
    space = SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    np.logical_and(~space[:-1], space[1:], out=cut[1:-1])
    for k in np.flatnonzero(whole):
        cut[offsets[k] : offsets[k + 1]] = False
    cut[offsets] = True
    at = np.flatnonzero(cut).astype(np.int64, copy=False)
    found = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data))
    return found, np.searchsorted(at, offsets)


def hashes(words: Words, fold: bool) -> np.ndarray:
    """A 64-bit hash of each word; ``fold`` takes A-Z as a-z.

    Sums of powers modulo 2^64 can be made equal for long words (in Thue-Morse order, for one), so words
    of more than ``LONG`` bytes are hashed by BLAKE2.
    """
    if not len(words.start):
        return np.zeros(0, U64)
    low, high = words.start[0], words.end[-1]
    values = (_IN_FOLDED if fold else _IN_WORDS)[words.data[low:high]]
    begin = words.start - low
    place = np.arange(high - low) - np.repeat(begin, np.diff(begin, append=high - low))
    powers = np.full(int(place.max()) + 1, _BASE, U64)
    powers[0] = 1
    values *= np.cumprod(powers)[place]
    size = words.end - words.start
    found = mix(np.add.reduceat(values, begin) + size.astype(U64))
    for k in np.flatnonzero(size > LONG):
        word = words.data[words.start[k] : words.end[k]].tobytes()
        word = word.translate(_FOLDING) if fold else word
        found[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return found


def segments(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: the group of each element, and its place in the group."""
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - begin[owner]


def group_sums(values: np.ndarray, owner: np.ndarray, groups: int) -> np.ndarray:
    """Sums of 64-bit integers by sorted owner, exact modulo 2^64."""
    total = np.zeros(groups, values.dtype)
    if len(values):
        begin = np.flatnonzero(np.diff(owner, prepend=-1))
        total[owner[begin]] = np.add.reduceat(values, begin)
    return total
