"""Words and their spelling variants: each rare word beside a much more frequent one a single edit away.

1. *Words* are runs of Latin letters, cut from the bytes of whole texts and counted per batch, then per
   task, then over all. One run in ``MISSPELT`` loses a letter, chosen by a checksum of document and run.
2. *Blocks.* A single edit leaves the first or the last half of a word as it is. So words of length L and
   L + 1 that share a half of L's cut form a block, and every near pair lies in one of its two. Words are
   dealt to the blocks of their own length and of the length below. A block of more than ``TILE`` words is
   cut into tiles, each pair of pieces in one.
3. *Gram matrices.* In a tile, the product of the words' letter counts gives all squared distances at once.
   An exchanged letter makes 2, a letter more makes 1; those pairs are compared letter by letter.
4. A word's form is the most frequent near word, where that is ``RATIO`` times as frequent or more; forms are
   followed to the last one by doubling the steps.

A NULL text has no words; a NULL ``doc_id`` counts as an empty one in the checksum. Rows may repeat and count
each; columns other than ``doc_id`` and the text are ignored; no rows give no words. No word is left out for its
length, and no block for its size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.components import written
from tripstrata.llm.runs import by_key, whole_groups

MIN_LENGTH, MIN_COUNT, RATIO, MISSPELT = 6, 5, 5, 199
TILE = 2048
LETTERS = 26 + 64
_LONG = 64
_CODE = "word string, n long"
_PAIR = "word string, near string, near_n long"

_LEAD = 0xC3
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[_LEAD] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def runs(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and the start, end and text of each run of letters."""
    data, offsets = W.raw(texts)
    solid = np.zeros(len(data) + 2, bool)
    solid[1:-1] = _LETTER[data]
    solid[2:-1] |= data[:-1] == _LEAD
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    end = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    return _LOWER[data], start, end, np.searchsorted(offsets, start, side="right") - 1


def checksums(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The crc32 of each run, carried on from its seed, and a 64-bit hash of the run alone."""
    order = np.argsort(start - end, kind="stable")
    first, length = start[order], (end - start)[order]
    state = seed[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    mixed = np.full(len(order), 0x9E3779B97F4A7C15, np.uint64)
    short = int(np.searchsorted(-length, -_LONG))
    for k in range(int(length[short]) if short < len(length) else 0):
        stop = int(np.searchsorted(-length, -k))
        byte = data[first[short:stop] + k]
        now = state[short:stop]
        state[short:stop] = _CRC[(now ^ byte) & np.uint32(255)] ^ (now >> np.uint32(8))
        h = (mixed[short:stop] ^ byte) * np.uint64(0xFF51AFD7ED558CCD)
        mixed[short:stop] = h ^ (h >> np.uint64(29))
    state ^= np.uint32(0xFFFFFFFF)
    for k in range(short):
        whole = data[first[k] : first[k] + length[k]].tobytes()
        state[k] = zlib.crc32(whole, int(seed[order[k]]))
        mixed[k] = int.from_bytes(hashlib.blake2b(whole, digest_size=8).digest(), "little")
    crc, word = np.empty_like(state), np.empty_like(mixed)
    crc[order], word[order] = state, mixed
    return crc, word


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each piece of text and how often they occur there."""
    for piece in W.pieces(batches, budget=8 << 20):
        data, start, end, doc = runs(piece.column("text"))
        leads = np.concatenate([[0], np.cumsum(data == _LEAD)])
        points = end - start - (leads[end] - leads[start])
        use = points >= MIN_LENGTH
        start, end, doc, points = start[use], end[use], doc[use], points[use]
        ids = piece.column("doc_id").cast(pa.int64()).to_pylist()
        seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
        crc, word = checksums(data, start, end, seeds[doc])
        hit = crc % MISSPELT == 0
        changed: Counter[str] = Counter()
        for k in np.flatnonzero(hit & (points > MIN_LENGTH)):
            run = data[start[k] : end[k]].tobytes().decode()
            at = int(crc[k]) % len(run)
            changed[run[:at] + run[at + 1 :]] += 1
        start, end, word = start[~hit], end[~hit], word[~hit]
        _, first, n = np.unique(word, return_index=True, return_counts=True)
        length = (end - start)[first]
        owner, place = W.segments(length)
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        text = np.ascontiguousarray(data[start[first][owner] + place])
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.LargeStringArray.from_buffers(
                    len(first), pa.py_buffer(offsets), pa.py_buffer(text)
                ).cast(pa.string()),
                "n": pa.array(n.astype(np.int64)),
            }
        )
        if changed:
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(list(changed)), "n": pa.array(list(changed.values()), pa.int64())}
            )


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n)`` of all words that are long and frequent enough."""
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    counted = plain.mapInArrow(_word_rows, _CODE).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def _halves(length: Column, base: Column) -> list[Column]:
    """The two blocks of words of ``base`` or ``base + 1`` letters that a word of ``length`` belongs to."""
    cut = F.floor(base / 2).cast("int")
    head = F.substring("word", F.lit(1), cut)
    tail = F.substring("word", (length - (base - cut) + 1).cast("int"), (base - cut).cast("int"))
    return [
        F.struct(base.alias("base"), F.lit(True).alias("head"), head.alias("half")),
        F.struct(base.alias("base"), F.lit(False).alias("head"), tail.alias("half")),
    ]


def _tiles(words: DataFrame) -> DataFrame:
    """Every word in all tiles of its blocks; blocks without a possible pair are left out."""
    length = F.length("word")
    own = _halves(length, length)
    below = [F.when(length > MIN_LENGTH, x) for x in _halves(length, length - 1)]
    placed = words.select("word", "n", F.explode(F.array(*own, *below)).alias("x")).where("x IS NOT NULL")
    placed = placed.select(
        "word", "n", "x.base", "x.head", F.xxhash64("x.base", "x.head", "x.half").alias("block")
    )
    sizes = (
        placed.groupBy("block")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.length("word") == F.col("base")).alias("shorter"),
        )
        .where("size > 1 AND shorter > 0")
        .select("block", F.ceil(F.col("size") / TILE).cast("int").alias("pieces"))
    )
    tiled = placed.join(sizes, "block").withColumn("piece", F.pmod(F.xxhash64("word"), "pieces").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    low, high = F.least("piece", "other"), F.greatest("piece", "other")
    return tiled.select(
        F.xxhash64("block", low, high).alias("tile"),
        *("block", "base", "head", "word", "n", "piece"),
        (F.col("piece") == F.col("other")).alias("inner"),
    )


def _spelt(words: list[str], length: int) -> np.ndarray:
    """Code points, a row for each word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _counts(points: np.ndarray) -> np.ndarray:
    letter = np.where(points < 128, points - 97, points - 0xC0 + 26).astype(np.int64)
    row = np.arange(len(points))[:, None] * LETTERS
    flat = np.bincount((row + letter).ravel(), minlength=len(points) * LETTERS)
    return flat.reshape(len(points), LETTERS).astype(np.float64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, from their Gram matrix."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)


def near_pairs(
    words: list[str], base: int, head: bool, piece: np.ndarray, inner: bool
) -> list[tuple[int, int]]:
    """Places of words that differ by one edit and share the half that the block stands for.

    Pairs that share both halves belong to the block of the first one. ``inner`` tiles hold pairs within
    a piece, others pairs between pieces.
    """
    size = np.array([len(w) for w in words])
    shorter, longer = np.flatnonzero(size == base), np.flatnonzero(size == base + 1)
    if not len(shorter) or len(shorter) + len(longer) < 2:
        return []
    cut = base // 2
    a = _spelt([words[k] for k in shorter], base)
    count_a = _counts(a)
    out = []

    def add(i, j, x, y, near):
        same = (x[:, :cut] == y[:, :cut]).all(1)
        tail = base - cut
        near &= same if head else ~same & (x[:, -tail:] == y[:, -tail:]).all(1)
        near &= (piece[i] == piece[j]) == inner
        out.extend(zip(i[near].tolist(), j[near].tolist(), strict=True))

    i, j = np.nonzero(np.triu(_distances(count_a, count_a) == 2, 1))
    if len(i):
        x, y = a[i], a[j]
        add(shorter[i], shorter[j], x, y, (x != y).sum(1) == 1)
    if len(longer):
        b = _spelt([words[k] for k in longer], base + 1)
        i, j = np.nonzero(_distances(count_a, _counts(b)) == 1)
        if len(i):
            x, y = a[i], b[j]
            before = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
            after = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            add(shorter[i], longer[j], x, y, before + after >= base)
    return out


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in whole_groups(batches, "tile"):
        names = ("word", "n", "base", "head", "inner")
        word, n, base, head, inner = (table.column(k).to_pylist() for k in names)
        piece = table.column("piece").to_numpy()
        out: list[tuple[str, str, int]] = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            kinds = {(base[k], head[k], inner[k]) for k in range(lo, hi)}
            for b, h, within in kinds:
                rows = [k for k in range(lo, hi) if (base[k], head[k], inner[k]) == (b, h, within)]
                for x, y in near_pairs([word[k] for k in rows], b, h, piece[rows], within):
                    p, q = rows[x], rows[y]
                    out.append((word[p], word[q], n[q]))
                    out.append((word[q], word[p], n[p]))
        if out:
            a, b, c = zip(*out, strict=True)
            yield pa.RecordBatch.from_pydict(
                {"word": pa.array(a), "near": pa.array(b), "near_n": pa.array(c, pa.int64())}
            )


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near, near_n)`` for both directions of every near pair of ``words(word, n)``."""
    return by_key(_tiles(words), "tile").mapInArrow(_pair_rows, _PAIR)


def spelling_forms(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``; see the module."""
    words = written(count_words(docs, text), "words")
    near = (
        near_words(words)
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
        )
    )
    more = -F.col("best.less") >= RATIO * F.col("n")
    formed = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(more, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(more, -F.col("best.less")).cast("long").alias("form_n"),
        ),
        "forms",
    )
    roots = _followed(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _followed(steps: DataFrame) -> DataFrame:
    """``(word, root)`` after all steps; counts rise with every step, so they cannot go round."""
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = steps.join(onward, "root", "left")
        steps = written(joined.select("word", F.coalesce("beyond", "root").alias("root")), "roots")
        if steps.join(steps.select(F.col("word").alias("root")), "root", "left_semi").isEmpty():
            return steps
