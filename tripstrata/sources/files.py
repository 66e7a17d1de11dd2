"""Which source files a table has not loaded yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.names import SOURCE_FILE
from tripstrata.sources.scan import (
    Schema,
    listed_files,
    literal_path,
    read_dataset,
    to_struct,
    with_source_file,
)


def source_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per file, from the listing alone."""
    return listed_files(spark, path, pattern).select(SOURCE_FILE)


def new_files(spark: SparkSession, path: str, loaded: DataFrame) -> DataFrame:
    """Files under ``path`` that no row of ``loaded`` came from.

    The comparison is between file names, one row per file on either side. Joining the data rows
    by file name would shuffle every row and send all rows of a large file to one task.
    """
    seen = loaded.select(SOURCE_FILE).distinct()
    return source_files(spark, path).join(seen, SOURCE_FILE, "left_anti")


def read_new_files(
    spark: SparkSession, path: str, loaded: DataFrame, schema: Schema = None
) -> DataFrame:
    """Scan only the files not loaded yet. The driver sees file names, as it does in any scan.

    ``load_new_files`` finds them in a ledger instead, without a look at loaded rows or a list of names.
    """
    names = [literal_path(row[0]) for row in new_files(spark, path, loaded).collect()]
    if names:
        return with_source_file(read_dataset(spark, names, schema))
    struct = to_struct(schema)
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    known = (reader if struct is None else reader.schema(struct)).parquet(path)
    return with_source_file(known).where(F.lit(False))
