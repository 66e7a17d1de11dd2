"""Keep one row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.functions.columns import col
from tripstrata.names import INGEST_TIME, SOURCE_FILE


def dedup_first(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (INGEST_TIME,),
    tiebreak: Sequence[str] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """The first row of each key by ``order_by``, ties settled by ``tiebreak``.

    All rows of one load share their ingest time, so the tiebreak decides most duplicates. By
    default it is the source file and then every other column, which leaves only identical rows
    tied and makes the survivor independent of partitioning.

    Spark limits every key to its first row before the shuffle as well as after it, so a key that
    holds a large share of all rows reaches its reducer as one row per map task. List the most
    selective key first: it is the prefix by which both sorts compare.

    Rows whose keys are all NULL count as one key. ``keep_null_keys`` keeps every one of them.
    """
    _require_keys(keys)
    ranking = order_columns(df, keys, order_by, tiebreak)
    window = Window.partitionBy(*[col(key) for key in keys]).orderBy(
        *[col(name).asc_nulls_first() for name in ranking]
    )
    if keep_null_keys:
        unkeyed = reduce(and_, [col(key).isNull() for key in keys])
        kept = dedup_first(df.where(~unkeyed), keys, order_by, tiebreak)
        return kept.unionByName(df.where(unkeyed))
    position = F.row_number().over(window)
    return df.withColumn("_position", position).where(F.col("_position") == 1).drop("_position")


def order_columns(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tiebreak: Sequence[str] | None,
) -> list[str]:
    """Columns that order the rows of one key: ``order_by``, then ``tiebreak`` or all the rest."""
    if tiebreak is None:
        rest = [name for name in df.columns if name not in (SOURCE_FILE, *keys)]
        tiebreak = [name for name in df.columns if name == SOURCE_FILE] + rest
        maps = [n for n in tiebreak if isinstance(df.schema[n].dataType, (T.MapType, T.VariantType))]
        if maps:
            raise ValueError(f"columns {maps} have no order; name the tiebreak columns")
    present = [name for name in order_by if name in df.columns]
    ranking = list(dict.fromkeys([*present, *tiebreak]))
    # With nothing besides the keys, the rows of a key are identical.
    return ranking or list(keys)[:1]


def _require_keys(keys: Sequence[str]) -> None:
    """Without keys all rows would be one group in one task."""
    if not keys:
        raise ValueError("deduplication needs at least one key column")


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before, rows after and duplicates removed, from the key columns alone.

    Counting per key first means a frequent key is summed up before the shuffle.
    """
    _require_keys(keys)
    per_key = df.groupBy(*[col(key) for key in keys]).agg(F.count(F.lit(1)).alias("copies"))
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )
    return totals.withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))
