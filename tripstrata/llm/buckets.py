"""A set filter of fixed size: which hash buckets hold a key.

The size is set by ``bits`` alone (``2**25`` bits are 4 MB), whatever the number of keys, so it may be
sent to every executor. A full filter lets everything pass and costs speed, never rows: what passes
is joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLOCK = 32768


class BucketFilter:
    def __init__(self, keys: DataFrame, key: Column, bits: int = 25):
        """Built by one aggregation; ``2**bits / 32768`` rows of 4 KB reach the driver."""
        bucket = F.expr(f"{1 << bits}L")
        place = keys.select(F.pmod(key, bucket).alias("place"))
        rows = (
            place.groupBy(F.floor(F.col("place") / _BLOCK).cast("int").alias("block"))
            .agg(F.bitmap_construct_agg(F.pmod("place", F.lit(_BLOCK))).alias("bitmap"))
            .collect()
        )
        held = np.zeros((1 << bits) // 8, np.uint8)
        for row in rows:
            at = row["block"] * (_BLOCK // 8)
            held[at : at + _BLOCK // 8] = np.frombuffer(bytes(row["bitmap"]), np.uint8)
        self.empty = not rows
        self._mask = np.int64((1 << bits) - 1)
        self._held = keys.sparkSession.sparkContext.broadcast(held)

    def __contains__(self, key: int) -> bool:
        place = int(key) & int(self._mask)
        return bool(self._held.value[place >> 3] >> (place & 7) & 1)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        """Which of the int64 keys may be in the set."""
        place = keys.astype(np.int64, copy=False) & self._mask
        return (self._held.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
