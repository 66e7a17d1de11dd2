"""Catalog tables: create layers, write, read."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tripstrata.functions.columns import col
from tripstrata.names import CLEAN, LABEL, QUARANTINE, ROUTE, SOURCE_FILE
from tripstrata.session import freed_shuffles, scratch_dir, table_writes

# Property of the view that the other views of a split read: what they show.
SNAPSHOT = "tripstrata.snapshot"
# Partition column of a split's rows, and its value for those of the build itself.
BATCH, FIRST = "_batch", "0"
_MODE_LOCK = threading.RLock()
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
# How tables are stored. Those whose rows are sorted later have small row groups, as a task reads whole ones.
COMPACT = {"compression": "zstd"}
SORTED_LATER = COMPACT | {"parquet.block.size": str(16 << 20)}
# Table property of tables that a stream appends to. Spark reads those through the log of the stream
# and would not see files that another writer adds, nor show what was there before.
STREAMED = "tripstrata.streamed"


def ensure_layers(
    spark: SparkSession,
    layers: Mapping[str, str] | Iterable[str],
    location: str | None = None,
) -> None:
    """Create the layer databases that do not exist yet; ``layers`` may map names to comments."""
    comments = layers if isinstance(layers, Mapping) else dict.fromkeys(layers, "")
    for name, comment in comments.items():
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        where = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{text}'{where}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def run_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text over catalog tables; ``{name}`` in the text refers to a passed DataFrame."""
    return spark.sql(sql, **frames)


def write_table(
    df: DataFrame,
    name: str,
    partition_by: Iterable[str] = (),
    layout: str = "as_is",
    path: str | None = None,
    options: Mapping[str, str] = COMPACT,
) -> int:
    """Replace a table, schema included, and return the number of rows written.

    ``layout="as_is"`` writes each task's rows where they are, which is right when tasks already
    hold few partitions, as after a scan of monthly files. ``layout="rebalance"`` adds a shuffle by
    the partition columns in which Spark merges small and splits large partitions.

    The row count is taken in the write itself, in its last stage, where Spark counts every
    finished task once even when executors are lost and earlier stages run again.
    """
    keys = list(partition_by)
    if layout == "rebalance":
        df = df.hint("rebalance", *keys)
    elif layout != "as_is":
        raise ValueError(f"unknown layout {layout!r}")
    return _save(df, name, keys, path, options=options)


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, partition_by: Iterable[str] = ()
) -> int:
    """Replace a table by one laid out by a key: rows of one key are in one bucket, sorted by it.

    Whatever groups by the key, as ``dedup_first`` does, reads the buckets as they are and shuffles nothing,
    in this and every later rebuild; the one shuffle is that of this write. A bucket is read by one task, so
    take a number that makes them some hundred MB each over the months read together, and a key of which
    no value holds a large share of the rows.
    """
    counted, written = _counted(df.repartition(buckets, *[col(key) for key in keys]))
    writer = counted.write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    with freed_shuffles(df.sparkSession):
        writer.saveAsTable(name)
    return written.get["rows"]


def write_split(
    routed: DataFrame,
    clean: str,
    quarantine: str,
    partition_by: tuple[str, str] = ("pickup_year", "pickup_month"),
) -> int:
    """Write the two sides of a routed frame in one job and return the rows written."""
    return write_split_passes([routed], clean, quarantine, partition_by)


def write_split_passes(
    passes: Iterable[DataFrame],
    clean: str,
    quarantine: str,
    partition_by: tuple[str, str] = ("pickup_year", "pickup_month"),
) -> int:
    """Write routed frames, one after the other, as a new version of the two tables.

    Both sides come from the same expensive shuffle. Two separate writes would run it twice, and a
    cached or staged copy would store all the data once more. So each frame is written once, to a
    table partitioned by its route, month and batch. ``clean``, ``quarantine`` and ``<clean>_checked`` are
    views on the snapshot ``<clean>_current``, and filters on the month prune partitions of either.

    The snapshot alone says which version, and which batch of each month, is read. It moves in one
    step once everything is stored, so all three views change together, and a failure at any
    point leaves the old rows in full. The version before is kept until the next build, for readers
    that have begun.
    """
    stored = f"{clean}_v_{uuid.uuid4().hex[:12]}"
    rows, spark, columns = 0, None, None
    try:
        for number, routed in enumerate(passes):
            spark, columns = routed.sparkSession, [c for c in routed.columns if c != ROUTE]
            mode = "append" if number else "overwrite"
            batch = routed.withColumn(BATCH, F.lit(FIRST))
            rows += _save(batch, stored, [ROUTE, *partition_by, BATCH], mode=mode)
    except BaseException:
        if spark is not None:
            spark.sql(f"DROP TABLE IF EXISTS {stored}")
        raise
    before = _snapshot(spark, clean)
    _point(spark, clean, Snapshot(stored, before and before.stored, columns, (), partition_by))
    _create_views(spark, clean, quarantine)
    if before and before.previous:
        spark.sql(f"DROP TABLE IF EXISTS {before.previous}")
    return rows


@dataclass(frozen=True)
class Snapshot:
    """What the views of a split show: a table, and for some months another batch than the first."""

    stored: str
    previous: str | None
    columns: Sequence[str]
    batches: Sequence[tuple[int | None, int | None, str]]
    partition_by: Sequence[str]

    def shows(self) -> str:
        """SQL that is true for the partitions to be read. It names partition columns only."""
        year, month = (f"`{name}`" for name in self.partition_by)
        cases = " ".join(
            f"WHEN {year} <=> {_literal(y)} AND {month} <=> {_literal(m)} THEN '{batch}'"
            for y, m, batch in self.batches
        )
        return f"`{BATCH}` = " + (f"CASE {cases} ELSE '{FIRST}' END" if cases else f"'{FIRST}'")


def _literal(value: int | None) -> str:
    return "NULL" if value is None else str(int(value))


def _snapshot(spark: SparkSession, clean: str) -> Snapshot | None:
    if not spark.catalog.tableExists(f"{clean}_current"):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {clean}_current").collect()
    record = {row.key: row.value for row in rows}.get(SNAPSHOT)
    if record is None:
        return None
    found = json.loads(record)
    found["batches"] = [tuple(x) for x in found["batches"]]
    return Snapshot(**found)


def _point(spark: SparkSession, clean: str, to: Snapshot) -> None:
    """The one step in which readers go over to another snapshot."""
    items = ", ".join(f"`{name}`" for name in (*to.columns, ROUTE))
    record = json.dumps(asdict(to)).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE VIEW {clean}_current TBLPROPERTIES ('{SNAPSHOT}' = '{record}') AS "
        f"SELECT {items} FROM {to.stored} WHERE {to.shows()}"
    )


def _create_views(spark: SparkSession, clean: str, quarantine: str) -> None:
    """Views that follow the snapshot, its columns included; made once."""
    for view, where in (
        (clean, f"WHERE `{ROUTE}` = '{CLEAN}'"),
        (quarantine, f"WHERE `{ROUTE}` = '{QUARANTINE}'"),
        (f"{clean}_checked", ""),
    ):
        spark.sql(
            f"CREATE VIEW IF NOT EXISTS {view} WITH SCHEMA EVOLUTION AS "
            f"SELECT * EXCEPT (`{ROUTE}`) FROM {clean}_current {where}"
        )


def stored_version(spark: SparkSession, clean: str) -> str | None:
    """The table behind the views of a split, if there are any."""
    found = _snapshot(spark, clean)
    return found and found.stored


def replace_split_months(
    routed: DataFrame, clean: str, months: Iterable[tuple[int | None, int | None]]
) -> int:
    """Replace the given months on both sides of a split; all others stay as they are.

    The rows are stored as a further batch beside the old ones, and the snapshot then moves to it in one
    step. A row in any other month is an error that changes nothing. The rows replaced are kept until the next
    replacement, for readers that have begun (``release_replaced`` drops them at once).
    """
    spark, months = routed.sparkSession, list(dict.fromkeys(months))
    before = _snapshot(spark, clean)
    if before is None:
        raise ValueError(f"{clean} is not a view of a split")
    batch = uuid.uuid4().hex[:12]
    ordered = routed.withColumn(BATCH, F.lit(batch)).select(
        *[col(name) for name in spark.table(before.stored).columns]
    )
    counted, written = _counted(ordered)
    with table_writes(spark):
        counted.write.insertInto(before.stored)
    rows = written.get["rows"]
    found = {(r[0], r[1]) for r in _partitions(spark, before).where(F.col(BATCH) == batch).collect()}
    stray = sorted(found - set(months), key=str)
    if stray:
        _release(spark, before, [before])
        raise ValueError(f"rows of months that are not to be replaced: {stray}")
    moved = {(y, m): old for y, m, old in before.batches} | dict.fromkeys(months, batch)
    after = replace(before, batches=tuple((y, m, b) for (y, m), b in moved.items()))
    _point(spark, clean, after)
    _release(spark, after, [before, after])
    return rows


def release_replaced(spark: SparkSession, clean: str) -> None:
    """Drop what the snapshot of a split does not show: replaced months and the version before."""
    found = _snapshot(spark, clean)
    if found is None:
        raise ValueError(f"{clean} is not a view of a split")
    if found.previous:
        spark.sql(f"DROP TABLE IF EXISTS {found.previous}")
    _release(spark, found, [found])


def _partitions(spark: SparkSession, snapshot: Snapshot) -> DataFrame:
    """Year, month, batch and route of every partition, from the catalog alone."""
    batch = F.regexp_extract("partition", f"(?:^|/){BATCH}=([^/]*)", 1).alias(BATCH)
    route = F.regexp_extract("partition", f"(?:^|/){ROUTE}=([^/]*)", 1).alias(ROUTE)
    values = [_partition_value(column) for column in snapshot.partition_by]
    return spark.sql(f"SHOW PARTITIONS {snapshot.stored}").select(*values, batch, route)


def _release(spark: SparkSession, snapshot: Snapshot, kept: list[Snapshot]) -> None:
    """Drop the partitions that none of the ``kept`` snapshots shows."""
    shown = " OR ".join(f"({x.shows()})" for x in kept)
    keys = [*snapshot.partition_by, BATCH, ROUTE]
    for row in _partitions(spark, snapshot).where(f"NOT ({shown})").collect():
        _drop_partition(spark, snapshot.stored, keys, row)


def overwrite_months(
    df: DataFrame,
    name: str,
    months: Iterable[tuple[int | None, int | None]],
    partition_by: tuple[str, str] = ("pickup_year", "pickup_month"),
) -> int:
    """Replace the given (year, month) partitions by the rows of ``df`` and return their number.

    A row of ``df`` in any other month is an error, found before anything is written: monthly files
    hold stray rows, and a month must not be replaced by a few of them. (``in_months`` selects rows;
    ``replace_files`` loads a file again with its strays.) A month without a row in ``df`` is emptied.
    The rows are stored aside first, so ``df`` may read the table itself.
    """
    spark, months = df.sparkSession, list(dict.fromkeys(months))
    if is_streamed(spark, name):
        raise ValueError(f"{name} is appended to by a stream; rows of other writers would not show")
    keys = partition_columns(spark, name)
    ordered = df.select(*[col(column) for column in spark.table(name).columns])
    path = scratch_dir(spark, "months")
    with table_writes(spark):
        ordered.write.options(**COMPACT).partitionBy(*keys).parquet(path)
    staged = spark.read.schema(ordered.schema).parquet(path)
    found = {tuple(row) for row in staged.select(*keys).distinct().collect()}
    at = [keys.index(column) for column in partition_by]
    stray = sorted({tuple(row[i] for i in at) for row in found} - set(months), key=str)
    if stray:
        raise ValueError(f"rows of months that are not to be replaced: {stray}")
    counted, written = _counted(staged.select(*ordered.columns))
    old = spark.table(name).where(in_months(months, partition_by)).select(*keys).distinct().collect()
    with _overwriting(spark, "dynamic"), table_writes(spark):
        counted.write.insertInto(name, overwrite=True)
    for row in old:
        if tuple(row) not in found:
            _drop_partition(spark, name, keys, row)
    return written.get["rows"]


def replace_files(df: DataFrame, name: str, source_file: str = SOURCE_FILE) -> int:
    """Replace all rows of the files that ``df`` came from, in whatever months they are.

    Only the months that the files have or had rows in are rewritten, with their rows of other files.
    """
    spark = df.sparkSession
    keys = partition_columns(spark, name)
    table = spark.table(name)
    files = df.select(source_file).distinct()
    touched = table.join(files, source_file, "left_semi").select(*keys)
    months = [tuple(r) for r in touched.unionByName(df.select(*keys)).distinct().collect()]
    kept = table.where(in_months(months, keys)).join(files, source_file, "left_anti")
    return overwrite_months(kept.unionByName(df.select(*table.columns)), name, months, tuple(keys))


def in_months(
    months: Iterable[tuple[int | None, int | None]],
    columns: Sequence[str] = ("pickup_year", "pickup_month"),
) -> Column:
    """A filter on the partition columns alone, also for rows without a pickup time."""
    tests = [
        reduce(and_, [col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, month, strict=True)])
        for month in months
    ]
    return reduce(or_, tests, F.lit(False)) if tests else F.lit(False)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def stored_months(
    spark: SparkSession,
    tables: Mapping[str, str],
    partition_by: Sequence[str] = ("pickup_year", "pickup_month"),
    side: str | None = CLEAN,
) -> DataFrame:
    """The months that tables hold, as ``(trip_type, year, month)`` with the names of ``tables`` as types.

    Taken from the catalog's list of partitions alone: no file is listed or opened. A table may be a view of
    a split, of which ``side`` is looked at, or both sides if None.
    """
    frames = []
    for label, name in tables.items():
        split = _snapshot(spark, name)
        if split:
            parts = _partitions(spark, split).where(split.shows())
            parts = parts if side is None else parts.where(F.col(ROUTE) == side)
            parts = parts.select(*partition_by)
        else:
            listed = spark.sql(f"SHOW PARTITIONS {name}")
            parts = listed.select(*[_partition_value(column) for column in partition_by])
        frames.append(parts.select(F.lit(label).alias(LABEL), *partition_by))
    return reduce(DataFrame.unionByName, frames).distinct()


def _partition_value(column: str) -> Column:
    text = F.regexp_extract("partition", f"(?:^|/){column}=([^/]*)", 1)
    return F.when(text != "__HIVE_DEFAULT_PARTITION__", text).cast("int").alias(column)


def _drop_partition(spark: SparkSession, name: str, keys: list[str], row) -> None:
    items = ", ".join(f"`{k}` = null" if row[k] is None else f"`{k}` = '{row[k]}'" for k in keys)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({items})")


def is_streamed(spark: SparkSession, name: str) -> bool:
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return any(row.key == STREAMED for row in properties)


def create_streamed(df: DataFrame, name: str, partition_by: Iterable[str]) -> None:
    """Create the table a stream appends to, or make sure that an existing one is such a table."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        if not is_streamed(spark, name):
            raise ValueError(f"{name} was written otherwise; a stream would hide its rows")
        return
    columns = ", ".join(f"`{column}` {kind}" for column, kind in df.dtypes)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}) TBLPROPERTIES ('{STREAMED}' = 'true')"
    )


def _save(
    df: DataFrame,
    name: str,
    keys: list[str],
    path: str | None = None,
    mode: str = "overwrite",
    options: Mapping[str, str] = COMPACT,
) -> int:
    counted, written = _counted(df)
    writer: DataFrameWriter = counted.write.format("parquet").mode(mode).options(**options)
    if keys:
        writer = writer.partitionBy(*keys)
    with table_writes(df.sparkSession):
        if path is None:
            writer.saveAsTable(name)
        else:
            # Replacing the table does not empty a folder outside the warehouse.
            with _overwriting(df.sparkSession, "static"):
                writer.option("path", path).saveAsTable(name)
    return written.get["rows"]


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Fix whether an overwrite replaces all partitions or only those it writes.

    Spark takes this from the session. As a write option it would be stored with the table and
    decide later writes too. Threads that write so take turns.
    """
    with _MODE_LOCK:
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, mode)
        try:
            yield
        finally:
            spark.conf.set(OVERWRITE_MODE, before)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    written = Observation()
    return df.observe(written, F.count(F.lit(1)).alias("rows")), written
