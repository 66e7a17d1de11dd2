"""Quality rules on repetition, from a suffix array of each text's words.

Only suffixes that begin with a repeated window of three words can share three words or more with
another suffix, so the array is built of those alone, by doubling the compared length. Neighbours in it
give the longest common prefixes; a suffix's larger one is the longest repeat that begins there, and
the union of those intervals are the words that lie in maximal repeated substrings of ``min_repeat``
words or more. A text fails if they cover too large a fraction of it, or if one of them is too long.

NULL text is a text without words. Rows may repeat; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.private import free_name

U64 = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_WINDOW = 3


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return running[offsets[1:]] - running[offsets[:-1]]


def _duplicate_lines(words: W.Words) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line of the text."""
    data, offsets = words.data, words.offsets
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    newline = data == 10
    edge[1:][newline] = True
    begin = np.flatnonzero(edge[:-1])
    if not len(begin):
        return np.zeros(len(offsets) - 1, np.int64)
    length = np.diff(np.append(begin, len(data)))
    values = W._BYTE[data]
    values[newline] = 0
    length = length - newline[begin + length - 1]
    powers = np.full(int(np.diff(np.append(begin, len(data))).max()), W._BASE, U64)
    powers[0] = 1
    place = np.arange(len(data)) - np.repeat(begin, np.diff(np.append(begin, len(data))))
    h = W.mix(np.add.reduceat(values * np.cumprod(powers)[place], begin) + length.astype(U64))
    filled = np.searchsorted(words.start, begin + length) > np.searchsorted(words.start, begin)
    owner = np.searchsorted(offsets, begin, side="right") - 1
    h, owner, begin, length = h[filled], owner[filled], begin[filled], length[filled]
    order = np.lexsort((begin, h, owner))
    h, owner, begin, length = h[order], owner[order], begin[order], length[order]
    again = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    found = np.bincount(owner[1:][again], minlength=len(offsets) - 1)

    def line(k: int) -> bytes:
        return data[begin[k] : begin[k] + length[k]].tobytes()

    # Lines of one hash are compared; texts in which unequal ones share a hash are counted by their lines.
    unequal = {int(owner[k]) for k in np.flatnonzero(again) if line(k) != line(k + 1)}
    for text in unequal:
        lines = [line(k) for k in range(*np.searchsorted(owner, [text, text + 1]))]
        found[text] = len(lines) - len(set(lines))
    return found


def suffix_array(h: np.ndarray, doc: np.ndarray, at: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The suffixes that begin at ``at`` or three words later, sorted by text and words.

    Larsson and Sadakane's doubling: a suffix's rank is where its group begins in the array, and each
    round sorts the groups by the rank of what follows, which is among the suffixes sorted here.
    """
    after = at[at + _WINDOW < limit[at]] + _WINDOW
    suffixes = np.union1d(at, after)

    def word(k: int) -> np.ndarray:
        inside = suffixes + k < limit[suffixes]
        return np.where(inside, h[np.where(inside, suffixes + k, 0)], U64(0))

    keys = [doc[suffixes], *(word(k) for k in range(_WINDOW))]
    order = np.lexsort(keys[::-1])
    suffixes = suffixes[order]
    fresh = np.ones(len(suffixes), bool)
    fresh[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    group = np.cumsum(fresh) - 1
    rank = np.full(len(h), -1, np.int64)
    rank[suffixes] = np.flatnonzero(fresh)[group]
    slot = np.flatnonzero(np.bincount(group)[group] > 1)
    reach = _WINDOW
    while len(slot):
        active = suffixes[slot]
        ahead = active + reach
        inside = ahead < limit[active]
        second = np.where(inside, rank[np.where(inside, ahead, 0)], -1)
        order = np.lexsort((second, rank[active]))
        active, second = active[order], second[order]
        suffixes[slot] = active
        fresh = np.ones(len(slot), bool)
        first = rank[active]
        fresh[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        group = np.cumsum(fresh) - 1
        rank[active] = slot[np.flatnonzero(fresh)][group]
        slot = slot[np.bincount(group)[group] > 1]
        reach *= 2
    return suffixes


def common_prefixes(h: np.ndarray, suffixes: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in the array, if of the same text."""
    powers = np.full(len(h) + 1, W._BASE, U64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(h * powers[:-1])])
    a, b = np.minimum(suffixes[:-1], suffixes[1:]), np.maximum(suffixes[:-1], suffixes[1:])
    low = np.zeros(len(a), np.int64)
    high = np.where(limit[a] == limit[b], limit[b] - b, 0)
    while (low < high).any():
        middle = (low + high + 1) // 2
        left = (sums[a + middle] - sums[a]) * powers[b - a]
        same = left == sums[b + middle] - sums[b]
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return np.concatenate([[0], low])


def measures(texts: pa.LargeStringArray, min_repeat: int) -> dict[str, np.ndarray]:
    words = W.split(texts)
    h = W.hashes(words, fold=False)
    n = words.count
    whole = np.zeros(len(words.data), bool)
    mark = np.zeros(len(words.data) + 1, np.int64)
    np.add.at(mark, words.start, 1)
    np.add.at(mark, words.end, -1)
    whole = (np.cumsum(mark[:-1]) > 0) & ((words.data & 0xC0) != 0x80)
    limit = words.first[1:][words.doc] if len(h) else np.zeros(0, np.int64)

    place = np.arange(len(h))
    begins = place[place + _WINDOW <= limit]
    key = W.mix(words.doc[begins].astype(U64) + U64(1)) * W.PLACES[6]
    for k in range(_WINDOW):
        key = key + W.mix(h[begins + k] ^ W.PLACES[4]) * W.PLACES[k]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(key), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    at = begins[repeated]
    in_window = np.zeros(len(h), bool)
    for k in range(_WINDOW):
        in_window[at + k] = True

    covered = np.zeros(len(h), bool)
    longest = np.zeros(len(n), np.int64)
    if len(at):
        suffixes = suffix_array(h, words.doc, at, limit)
        shared = common_prefixes(h, suffixes, limit)
        best = np.maximum(shared, np.append(shared[1:], 0))
        keep = best >= min_repeat
        edges = np.zeros(len(h) + 1, np.int64)
        np.add.at(edges, suffixes[keep], 1)
        np.add.at(edges, suffixes[keep] + best[keep], -1)
        covered = np.cumsum(edges[:-1]) > 0
        np.maximum.at(longest, words.doc[suffixes[keep]], best[keep])
    return {
        "n_words": n,
        "word_chars": _per_text(whole, words.offsets),
        "n_symbols": _per_text(_SYMBOL[words.data], words.offsets),
        "n_dup_lines": _duplicate_lines(words),
        "n_repeat_words": _per_text(in_window, words.first),
        "covered_words": _per_text(covered, words.first),
        "longest_repeat": longest,
    }


_COLUMNS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words covered_words longest_repeat".split()
)


def repetition_rules(
    docs: DataFrame,
    text: str = "text",
    min_repeat: int = 8,
    max_covered: float = 0.4,
    max_repeat: int = 400,
) -> DataFrame:
    """All columns of ``docs`` with those of ``_COLUMNS``, ``base_failed`` and ``kept`` added.

    Columns of ``docs`` with these names are replaced.
    """

    def rows(batches):
        for piece in W.pieces(batches, own):
            found = measures(piece.column(own), min_repeat)
            rest = piece.drop_columns([own])
            for name in _COLUMNS:
                rest = rest.append_column(name, pa.array(found[name], pa.int64()))
            yield rest

    rest = docs.drop(*_COLUMNS, "base_failed", "kept")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    schema += "".join(f", {name} long" for name in _COLUMNS)
    own = free_name(rest, "own_text")
    measured = rest.withColumn(own, F.col(text).cast("string")).mapInArrow(rows, schema)
    base_failed = (F.col("n_words") < 50) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    verdict = (F.col("covered_words") <= max_covered * F.col("n_words")) & (
        F.col("longest_repeat") <= max_repeat
    )
    return measured.withColumn("base_failed", base_failed).withColumn(
        "kept", ~F.col("base_failed") & verdict
    )
