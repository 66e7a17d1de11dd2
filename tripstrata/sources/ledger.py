"""Loading files as they arrive, with a table that tells which ones have been loaded.

The ledger has a row for each file and event: ``started`` before its rows are written, ``loaded`` after. A file is
known by path, size and modification time.

* New files are found by a join of the listing with the ledger; the loaded rows are not looked at.
* A file that was started and not finished, or that has changed since, has its rows replaced. So a load that broke off
  anywhere can simply be run again, and no row is there twice.
* Files are read by a filter on their modification times, which leaves all others unopened. Only where a loaded file's
  time lies among those of the new ones, rows are joined with the names as well. No list of paths passes
  through the driver.
* Types may change from file to file. A column that is new is added to the table. A whole number of a wider type, or a
  double for a float, widens the table's column, which Spark reads from the older files as they are. Numbers with
  places come into a column of whole numbers only if they are whole; NaN is NULL there.

The raw tables kept this way have a folder of their own and are not managed by the catalog, so that changing
a type touches no data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstrata.functions.columns import find_column
from tripstrata.names import INGEST_TIME, SOURCE_FILE
from tripstrata.session import scratch_dir, table_writes
from tripstrata.sources.scan import (
    _cast_to,
    footers,
    listed_files,
    to_struct,
    widest_schema,
    with_source_file,
)
from tripstrata.sources.tables import SORTED_LATER, is_streamed, partition_columns, replace_files
from tripstrata.spec import DatasetSpec

STARTED, LOADED = "started", "loaded"
# A list of file names up to this size is sent to all executors where it has to be joined.
NAMES_MB = 32
_COLUMNS = (
    f"{SOURCE_FILE} string, size bigint, modified timestamp, row_count bigint, state string, "
    "load string, logged timestamp"
)
_STAMP = [SOURCE_FILE, "size", "modified"]


def ensure_ledger(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_COLUMNS}) USING parquet")


def pending_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Files under ``path`` that are not loaded as they are now: ``_source_file, size, modified, again``.

    ``again`` marks those the ledger has met before, whose rows may be in the table.
    """
    log = spark.table(ledger)
    loaded = log.where(F.col("state") == LOADED).select(*_STAMP).distinct()
    met = log.select(SOURCE_FILE, F.lit(True).alias("met")).distinct()
    fresh = listed_files(spark, path).join(loaded, _STAMP, "left_anti")
    return fresh.join(met, SOURCE_FILE, "left").select(
        *_STAMP, F.coalesce("met", F.lit(False)).alias("again")
    )


def read_files(
    spark: SparkSession, path: str, files: DataFrame, schema: T.StructType
) -> DataFrame:
    """Rows of those files under ``path`` that ``files(_source_file, size, modified)`` lists, and no others.

    ``files`` is evaluated several times and should be stored.
    """
    low, high, count, letters = files.agg(
        F.min(F.unix_micros("modified")),
        F.max(F.unix_micros("modified")),
        F.count(F.lit(1)),
        F.sum(F.length(SOURCE_FILE)),
    ).first()
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    rows = with_source_file(reader.option("pathGlobFilter", "*.parquet").parquet(path))
    if not count:
        return rows.where(F.lit(False))
    within = _between(F.col("_metadata.file_modification_time"), low, high)
    rows = rows.where(within)
    others = listed_files(spark, path).where(_between(F.col("modified"), low, high))
    if others.join(files, _STAMP, "left_anti").isEmpty():
        return rows
    names = files.select(SOURCE_FILE)
    if letters <= NAMES_MB << 20:
        names = F.broadcast(names)
    return rows.join(names, SOURCE_FILE, "left_semi")


def _between(time: Column, low: int, high: int) -> Column:
    return time.between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high)))


def load_new_files(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    table: str,
    ledger: str,
    partition_by: tuple[str, ...] = ("pickup_year", "pickup_month"),
) -> int:
    """Bring ``table`` up to date with the files under ``path`` and return the rows loaded.

    Without a declared schema the table takes on the columns and types of the files, see the module.
    """
    return load_new_months(spark, path, spec, table, ledger, partition_by)[0]


def load_new_months(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    table: str,
    ledger: str,
    partition_by: tuple[str, ...] = ("pickup_year", "pickup_month"),
    before: Callable[[list[tuple]], None] | None = None,
) -> tuple[int, list[tuple]]:
    """``load_new_files`` that also returns the months whose rows have changed, sorted.

    ``before`` is called with them when nothing has been written yet.
    A load that broke off and is run again returns those of its first try as well: its files are met again,
    and the months of their rows in the table count as changed.
    """
    from tripstrata.plans.bronze import bronze_frame

    ensure_ledger(spark, ledger)
    pending = _stored(footers(pending_files(spark, path, ledger)), "pending")
    if pending.isEmpty():
        return 0, []
    load = uuid.uuid4().hex
    found = [
        (T.StructType.fromJson(json.loads(row["schema"])), row["schema"])
        for row in pending.select("schema").distinct().orderBy("schema").collect()
    ]
    target = to_struct(spec) or _target(spark, table, [struct for struct, _ in found])
    parts: dict[bool, list[DataFrame]] = {}
    for struct, text in found:
        for again in (False, True):
            files = pending.where((F.col("schema") == text) & (F.col("again") == again))
            if files.isEmpty():
                continue
            rows = read_files(spark, path, files.select(*_STAMP), struct)
            parts.setdefault(again, []).append(_cast_to(rows, target))
    frames = {
        again: bronze_frame(reduce(DataFrame.unionByName, rows), spec) for again, rows in parts.items()
    }
    months = {tuple(r) for f in frames.values() for r in f.select(*partition_by).distinct().collect()}
    if True in frames and spark.catalog.tableExists(table):
        met = pending.where("again").select(SOURCE_FILE)
        old = spark.table(table).join(met, SOURCE_FILE, "left_semi").select(*partition_by)
        months |= {tuple(r) for r in old.distinct().collect()}
    changed = sorted(months, key=str)
    if before is not None:
        before(changed)
    _log(pending, ledger, STARTED, load)
    _prepare(spark, table, next(iter(frames.values())), partition_by)
    if False in frames:
        columns = spark.table(table).columns
        with table_writes(spark):
            frames[False].select(*columns).write.insertInto(table)
    if True in frames:
        replace_files(_stored(frames[True], "again"), table)
    _log(pending, ledger, LOADED, load)
    return pending.agg(F.sum("row_count")).first()[0], changed


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _log(pending: DataFrame, ledger: str, state: str, load: str) -> None:
    rows = pending.select(
        *_STAMP,
        "row_count",
        F.lit(state).alias("state"),
        F.lit(load).alias("load"),
        F.current_timestamp().alias("logged"),
    )
    rows.write.insertInto(ledger)


def _target(spark: SparkSession, table: str, found: list[T.StructType]) -> T.StructType:
    """The columns of the table and the files, each of a type that holds both as far as the module says."""
    arrived = widest_schema(found) if len(found) > 1 else found[0]
    if not spark.catalog.tableExists(table):
        return arrived
    own = {*partition_columns(spark, table), INGEST_TIME, SOURCE_FILE}
    known = {f.name.lower(): f for f in spark.table(table).schema.fields if f.name not in own}
    for field in arrived.fields:
        old = known.get(field.name.lower())
        name = old.name if old else field.name
        kind = widened(old.dataType, field.dataType, name) if old else field.dataType
        known[field.name.lower()] = T.StructField(name, kind, True)
    return T.StructType(list(known.values()))


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_PLACES = (T.FloatType, T.DoubleType)


def widened(old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    """The type of a column that holds values of one type when another arrives."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, _WHOLE) and isinstance(new, _WHOLE):
        return max(old, new, key=lambda kind: _WHOLE.index(type(kind)))
    if isinstance(old, _PLACES) and isinstance(new, _PLACES):
        return T.DoubleType()
    if isinstance(old, _WHOLE + _PLACES) and isinstance(new, _WHOLE + _PLACES):
        return old
    raise ValueError(
        f"column {name} is {old.simpleString()} in the table and {new.simpleString()} in a file"
    )


def _prepare(spark: SparkSession, table: str, rows: DataFrame, keys: tuple[str, ...]) -> None:
    """Create the table, or give it the columns and types of ``rows``; no stored file is touched."""
    if not spark.catalog.tableExists(table):
        database, name = table.split(".") if "." in table else (spark.catalog.currentDatabase(), table)
        folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
        _create(spark, table, rows.schema, keys, f"{folder}/{name}_files")
        return
    if is_streamed(spark, table):
        raise ValueError(f"{table} is appended to by a stream; rows of other writers would not show")
    known = spark.table(table)
    new = [f for f in rows.schema.fields if find_column(known, equals_ci=f.name) is None]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    wanted = {f.name.lower(): f.dataType for f in rows.schema.fields}
    fields = spark.table(table).schema.fields
    wider = [T.StructField(f.name, wanted.get(f.name.lower(), f.dataType), True) for f in fields]
    if wider == [T.StructField(f.name, f.dataType, True) for f in fields]:
        return
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if details.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} is managed by the catalog; its columns cannot change their types")
    spark.sql(f"DROP TABLE {table}")
    _create(spark, table, T.StructType(wider), keys, details["Location"])
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _create(
    spark: SparkSession, table: str, schema: T.StructType, keys: tuple[str, ...], folder: str
) -> None:
    ordered = [f for f in schema.fields if f.name not in keys] + [f for f in schema.fields if f.name in keys]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    options = ", ".join(f"'{name}' = '{value}'" for name, value in SORTED_LATER.items())
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS ({options}) "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{folder}'"
    )
