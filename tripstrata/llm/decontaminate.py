"""Benchmark passages in documents, found by q-gram counting and banded alignment.

Texts are compared in lower case with every run of other characters than letters and digits as one
blank. An item of n characters may differ from a passage by ``k = floor(rate * n)`` edits; by the q-gram
lemma the two then share at least ``n - q + 1 - k * q`` q-grams, on at most ``k + 1`` neighbouring diagonals
(place in the document minus place in the item). Diagonals are dealt into bands of ``2 * (k + 1)`` that overlap
by half, so one band holds them all. Bands that reach the count are verified by a banded alignment.

Where ``k`` would leave no q-gram to count on, it is lowered until one is left. Items with fewer than
``min_chars`` characters are no evidence and are not searched. The index of the items is sent to all
executors in blocks of at most about ``BLOCK_CHARS`` characters, one scan of the documents for each.

NULL texts hold nothing and equal none; rows may repeat, and further columns are ignored or kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.private import free_name

U64 = np.uint64
Q = 12
RATE = 0.06
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000
_TABLE_BITS = 22
_WORDLIKE = np.zeros(0x110000, bool)
_BLANK = 32


def _wordlike() -> np.ndarray:
    """Which code points are letters or digits; filled once per process."""
    if not _WORDLIKE[97]:
        for code in range(len(_WORDLIKE)):
            _WORDLIKE[code] = chr(code).isalnum()
    return _WORDLIKE


def plain(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The compared code points of a text, and the place of each in it."""
    lower = text.lower()
    if len(lower) != len(text):  # a letter whose small form has two characters
        lower = "".join(x if len(x) == 1 else c for c, x in zip(text, map(str.lower, text), strict=True))
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    solid = _wordlike()[codes]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    places = np.flatnonzero(keep)
    codes = np.where(solid[places], codes[places], _BLANK)
    return codes, places


def grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the ``Q`` code points from each place on."""
    if len(codes) < Q:
        return np.zeros(0, U64)
    h = codes.astype(U64) * W.PLACES[0] + W.PLACES[1]
    width, power = 1, int(W._BASE)
    total, done, shift = None, 0, 1
    bits = Q
    while bits:
        if bits & 1:
            part = h[done:] if done else h
            if total is None:
                total, shift = part, power
            else:
                n = len(part)
                total = total[:n] * U64(power) + part
                shift = shift * power & (2**64 - 1)
            done += width
        bits >>= 1
        if bits:
            h = h[:-width] * U64(power) + h[width:]
            width, power = 2 * width, power * power & (2**64 - 1)
    return W.mix(total[: len(codes) - Q + 1])


@dataclass
class Index:
    """Items by number, and their q-grams sorted by hash."""

    ids: list[int]
    codes: list[np.ndarray]
    budget: np.ndarray
    least: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray


def build_index(items: list[tuple[int, str]], rate: float = RATE, min_chars: int = MIN_CHARS) -> Index:
    kept = [(i, plain(text)[0]) for i, text in items]
    kept = [(i, codes[: len(codes) - (codes[-1:] == _BLANK).sum()]) for i, codes in kept]
    kept = [(i, codes) for i, codes in kept if len(codes) >= max(min_chars, Q)]
    sizes = np.array([len(codes) for _, codes in kept], np.int64)
    budget = np.minimum((rate * sizes).astype(np.int64), (sizes - Q) // Q)
    found = [grams(codes) for _, codes in kept]
    item = np.repeat(np.arange(len(kept)), [len(x) for x in found])
    place = np.concatenate([np.arange(len(x)) for x in found]) if found else np.zeros(0, np.int64)
    h = np.concatenate(found) if found else np.zeros(0, U64)
    order = np.argsort(h, kind="stable")
    hashes, begin = np.unique(h[order], return_index=True)
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(hashes >> U64(64 - _TABLE_BITS)).astype(np.int64)] = True
    return Index(
        [i for i, _ in kept],
        [codes for _, codes in kept],
        budget,
        sizes - Q + 1 - budget * Q,
        hashes,
        np.append(begin, len(h)),
        item[order],
        place[order],
        table,
    )


def align(item: np.ndarray, text: np.ndarray, most: int, spread: int) -> tuple[int, int, int] | None:
    """Fewest edits between the item and a stretch of the text, with that stretch, if at most ``most``.

    The stretch begins at one of the first ``spread`` places. Cell o of a row stands for the text up to
    place ``row + o``, so the table is a band of ``spread + most`` cells.
    """
    far = most + 1 + len(item)
    width = spread + most + 1
    steps = np.arange(width)
    cost = np.where(steps < spread, 0, far)
    start = steps.copy()
    padded = np.full(len(item) + width, -1, np.int64)
    padded[: min(len(text), len(padded))] = text[: len(padded)]
    for row, code in enumerate(item):
        change = cost + (padded[row : row + width] != code)
        drop = np.append(cost[1:], far) + 1
        best = np.minimum(change, drop)
        origin = np.where(change <= drop, start, np.append(start[1:], 0))
        run = np.minimum.accumulate((best - steps) * width + steps)
        source = run % width
        cost = (run - source) // width + steps
        start = origin[source]
        if cost.min() > most:
            return None
    o = int(np.argmin(cost))
    end = len(item) + o
    if cost[o] > most or end > len(text):
        return None
    return int(cost[o]), int(start[o]), end


def search(index: Index, text: str) -> list[tuple[int, int, int, int]]:
    """``(item_id, start, end, edits)`` of the passages in a text, in its own code points."""
    if not len(index.hashes) or len(text) < Q:
        return []
    codes, places = plain(text)
    h = grams(codes)
    at = np.flatnonzero(index.table[(h >> U64(64 - _TABLE_BITS)).astype(np.int64)])
    if not len(at):
        return []
    found = np.minimum(np.searchsorted(index.hashes, h[at]), len(index.hashes) - 1)
    same = index.hashes[found] == h[at]
    at, found = at[same], found[same]
    if len(at) < index.least.min():
        return []
    owner, k = W.segments(index.begin[found + 1] - index.begin[found])
    posting = index.begin[found][owner] + k
    item, diagonal = index.item[posting], at[owner] - index.place[posting]
    half = index.budget[item] + 1
    band = diagonal // half
    keys = np.concatenate([np.stack([item, band]), np.stack([item, band - 1])], axis=1)
    keys, count = np.unique(keys, axis=1, return_counts=True)
    enough = count >= index.least[keys[0]]
    out: dict[int, list[tuple[int, int, int]]] = {}
    for number, b in keys[:, enough].T.tolist():
        most, wanted = int(index.budget[number]), index.codes[number]
        first = b * (most + 1)
        low = max(0, first)
        spread = first + 2 * (most + 1) - low
        hit = align(wanted, codes[low : low + spread + len(wanted) + most], most, spread)
        if hit:
            edits, start, end = hit
            out.setdefault(number, []).append((edits, low + start, low + end))
    rows = []
    for number, hits in out.items():
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(hits):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                rows.append((index.ids[number], int(places[start]), int(places[end - 1]) + 1, edits))
    return sorted(rows)


def _blocks(benchmark: DataFrame, rate: float, min_chars: int):
    """Index after index, each of a bounded number of characters."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // BLOCK_CHARS) + 1
    spark = benchmark.sparkSession
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(map(tuple, part.collect()), key=lambda x: (x[0] is not None, x[0], x[1]))
        yield spark.sparkContext.broadcast(build_index(rows, rate, min_chars))


def find_passages(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS
) -> DataFrame:
    """``doc_id, item_id, start, end, edits`` of every benchmark passage in the documents."""

    def scan(index):
        def rows(batches):
            for piece in W.pieces(batches):
                found = [
                    (doc_id, *hit)
                    for doc_id, text in zip(
                        piece.column("doc_id").to_pylist(), piece.column("text").to_pylist(), strict=True
                    )
                    for hit in search(index.value, text)
                ]
                columns = zip(*found, strict=True) if found else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in columns],
                    names=["doc_id", "item_id", "start", "end", "edits"],
                )

        return rows

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, start long, end long, edits long"
    out = None
    for index in _blocks(benchmark, rate, min_chars):
        part = texts.mapInArrow(scan(index), schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS
) -> DataFrame:
    """The documents without any benchmark passage, with all their columns."""

    def keep(index):
        def rows(batches):
            for piece in W.pieces(batches, own):
                clean = [not search(index.value, x) for x in piece.column(own).to_pylist()]
                yield piece.drop_columns([own]).filter(pa.array(clean, pa.bool_()))

        return rows

    schema, own = docs.schema, free_name(docs, "own_text")
    for index in _blocks(benchmark, rate, min_chars):
        docs = docs.withColumn(own, F.col("text").cast("string")).mapInArrow(keep(index), schema)
    return docs
