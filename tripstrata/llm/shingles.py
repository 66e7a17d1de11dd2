"""Sets of word n-grams as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tripstrata.llm import words as W

U64 = np.uint64


def shingles(texts: pa.LargeStringArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, one after another, and their number per text."""
    words = W.split(texts)
    h = W.hashes(words, fold=True)
    count = words.count
    grams = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    owner, place = W.segments(grams)
    begin = words.first[:-1][owner] + place
    length = np.minimum(count, width)[owner]
    total = length.astype(U64) * W.PLACES[7]
    for k in range(width):
        inside = length > k
        at = np.where(inside, begin + k, 0)
        total += np.where(inside, W.mix(h[at] + U64(k)) * W.PLACES[k % 7], U64(0))
    total = W.mix(total)
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    fresh = np.ones(len(total), bool)
    fresh[1:] = (total[1:] != total[:-1]) | (owner[1:] != owner[:-1])
    return total[fresh], np.bincount(owner[fresh], minlength=len(count))
