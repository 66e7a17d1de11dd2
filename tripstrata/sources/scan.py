"""Reading directories of parquet files."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce
from string import printable
from urllib.parse import quote, unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from tripstrata.functions.columns import col, find_column
from tripstrata.names import INGEST_TIME, SOURCE_FILE
from tripstrata.spec import DatasetSpec

# Fixed value: where Spark keeps the schema in a parquet footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
Schema = DatasetSpec | T.StructType | str | None


def to_struct(schema: Schema) -> T.StructType | None:
    if isinstance(schema, DatasetSpec):
        schema = schema.schema
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_dataset(spark: SparkSession, path: str | list[str], schema: Schema = None) -> DataFrame:
    """Scan parquet under a declared schema, or infer and merge the columns of all files.

    A declared schema costs no inference job and reads months that lack a column as NULL. Columns
    resolve in any case.
    """
    paths = [path] if isinstance(path, str) else list(path)
    struct = to_struct(schema)
    if struct is None:
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    return spark.read.schema(struct).parquet(*paths)


def read_drifting(spark: SparkSession, units: list[str], schema: Schema = None) -> DataFrame:
    """Scan files whose column types differ from month to month.

    ``units`` are files or folders. When Spark can merge all footers, this is one plain scan.
    Otherwise the files are grouped by the schema in their footers, and each group is scanned under its
    own types, cast to the target and stacked: one scan per schema and one job for all footers, however many
    files. Without a
    declared schema the target type is the widest one seen. A fraction that the target type cannot
    hold is an error when it is read.
    """
    target = to_struct(schema)
    merged = _merged_scan(spark, units)
    if merged is not None:
        return with_source_file(merged) if target is None else _cast_to(with_source_file(merged), target)
    groups = _by_schema(spark, units)
    if target is None:
        target = widest_schema([found for found, _ in groups])
    shaped = [
        _cast_to(with_source_file(spark.read.schema(found).parquet(*paths)), target)
        for found, paths in groups
    ]
    return reduce(DataFrame.unionByName, shaped)


def _by_schema(spark: SparkSession, units: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files of all units by the schemas in their footers, which tasks read."""
    files = reduce(DataFrame.unionByName, [listed_files(spark, unit) for unit in units])
    grouped = (
        footers(files.distinct())
        .groupBy("schema")
        .agg(F.sort_array(F.collect_list(SOURCE_FILE)).alias("files"))
        .collect()
    )
    return [
        (T.StructType.fromJson(json.loads(row["schema"])), [literal_path(x) for x in row["files"]])
        for row in sorted(grouped, key=lambda row: row["files"][0])
    ]


def listed_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``_source_file, size, modified`` of every file. Only the listing is used: the content column is never
    selected, so no file is opened."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return listing.select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def footers(files: DataFrame, files_per_task: int = 64) -> DataFrame:
    """``files`` with the ``schema`` (JSON) and ``row_count`` that each file's footer states.

    Footers are read in tasks, ``files_per_task`` or so in each, in one job however many files there
    are. Executors open the files by pyarrow, which knows local, HDFS, S3 and GCS paths.
    """
    tasks = max(1, -(-files.count() // files_per_task))
    spread = files.repartition(tasks, SOURCE_FILE)
    stated = [T.StructField("schema", T.StringType()), T.StructField("row_count", T.LongType())]
    schema = T.StructType(files.schema.fields + stated)
    return spread.mapInArrow(_footer_rows, schema)


def _footer_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs
    import pyarrow.parquet

    for batch in batches:
        schemas, counts = [], []
        for name in batch.column(SOURCE_FILE).to_pylist():
            files, path = pyarrow.fs.FileSystem.from_uri(quote(name, safe=printable))
            found = pyarrow.parquet.read_metadata(path, filesystem=files)
            stated = (found.metadata or {}).get(SPARK_SCHEMA)
            # Files that Spark did not write state their types in parquet's own terms alone.
            own = stated.decode() if stated else from_arrow_schema(
                found.schema.to_arrow_schema(), prefer_timestamp_ntz=True
            ).json()
            schemas.append(own)
            counts.append(found.num_rows)
        columns = dict(zip(batch.schema.names, batch.columns, strict=True))
        columns |= {"schema": pa.array(schemas, pa.string()), "row_count": pa.array(counts, pa.int64())}
        yield pa.RecordBatch.from_pydict(columns)


def literal_path(reported: str) -> str:
    """The path of a file as Spark reports it, to be read again: decoded, and no character a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(reported))


def _merged_scan(spark: SparkSession, units: list[str]) -> DataFrame | None:
    """One scan over all units, or None when their types conflict. Spark reads the footers in
    parallel tasks and reports a conflict as an error."""
    try:
        return read_dataset(spark, units)
    except (Py4JJavaError, PySparkException) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def widest_schema(schemas: list[T.StructType]) -> T.StructType:
    """One field per column name in any case, numbers widened to the largest type seen."""
    order = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()]
    merged: dict[str, T.StructField] = {}
    for field in (field for schema in schemas for field in schema.fields):
        known = merged.get(field.name.lower())
        if known is None or isinstance(known.dataType, T.NullType):
            name = known.name if known else field.name
            merged[field.name.lower()] = T.StructField(name, field.dataType, True)
        elif known.dataType != field.dataType and not isinstance(field.dataType, T.NullType):
            if known.dataType not in order or field.dataType not in order:
                raise ValueError(
                    f"column {known.name} is {known.dataType.simpleString()} in one file and "
                    f"{field.dataType.simpleString()} in another; declare a schema"
                )
            wider = max(known.dataType, field.dataType, key=order.index)
            # A float holds fewer digits than an int, so a mix of both needs a double.
            if isinstance(wider, T.FloatType):
                wider = T.DoubleType()
            merged[field.name.lower()] = T.StructField(known.name, wider, True)
    return T.StructType(list(merged.values()))


def _cast_to(df: DataFrame, target: T.StructType) -> DataFrame:
    columns = []
    for field in target.fields:
        present = find_column(df, equals_ci=field.name)
        if present is None:
            value = F.lit(None).cast(field.dataType)
        else:
            value = _cast(col(present), df.schema[present].dataType, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, SOURCE_FILE)


def _cast(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    if found == wanted:
        return value
    if isinstance(found, (T.FloatType, T.DoubleType)) and isinstance(wanted, T.IntegralType):
        # Files written from pandas hold NaN where an integer is missing.
        fraction = F.concat(F.lit("not an integer: "), value.cast("string"))
        return F.when(
            ~F.isnan(value),
            F.when(value == F.floor(value), value.cast(wanted)).otherwise(
                F.raise_error(fraction).cast(wanted)
            ),
        )
    return value.cast(wanted)


def with_source_file(df: DataFrame) -> DataFrame:
    if SOURCE_FILE in df.columns:
        return df
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def with_ingest_metadata(df: DataFrame) -> DataFrame:
    """Add the load time, one value for the whole load, and the file each row came from."""
    return with_source_file(df.withColumn(INGEST_TIME, F.current_timestamp()))


def with_partition_columns(df: DataFrame, timestamp: str) -> DataFrame:
    return df.withColumns(
        {"pickup_year": F.year(col(timestamp)), "pickup_month": F.month(col(timestamp))}
    )
