"""Groups of a sorted partition, cut from its stream of batches.

For very many small groups this is far cheaper than a call for each group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys side by side in one partition, in the order of the keys."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete groups of a partition sorted by ``key``, and where each group begins and ends.

    Only the last group of a batch waits for the next one, so the memory needed is a batch and a group.
    """
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        last = table.column(key)[-1].as_py()
        if held and held[-1].column(key)[0].as_py() == last:
            held.append(table)
            continue
        cut = _last_group(table, key)
        if cut:
            done = pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
            held = []
            yield done, _bounds(done, key)
        elif held:
            done = pa.concat_tables(held).combine_chunks()
            held = []
            yield done, _bounds(done, key)
        held.append(table.slice(cut))
    if held:
        done = pa.concat_tables(held).combine_chunks()
        yield done, _bounds(done, key)


def _changes(table: pa.Table, key: str) -> np.ndarray:
    values = table.column(key).combine_chunks()
    if isinstance(values, pa.ChunkedArray):
        values = pa.concat_arrays(values.chunks)
    differs = pc.not_equal(values[1:], values[:-1])
    return np.flatnonzero(differs.to_numpy(zero_copy_only=False)) + 1


def _last_group(table: pa.Table, key: str) -> int:
    changes = _changes(table, key)
    return int(changes[-1]) if len(changes) else 0


def _bounds(table: pa.Table, key: str) -> np.ndarray:
    return np.concatenate([[0], _changes(table, key), [table.num_rows]]).astype(np.int64)
