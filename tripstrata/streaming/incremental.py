"""Load the files that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripstrata.plans.bronze import MONTH_COLUMNS, bronze_frame
from tripstrata.sources.scan import read_dataset, to_struct
from tripstrata.sources.tables import create_streamed
from tripstrata.spec import DatasetSpec


def load_arrivals(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    table: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Append every file of ``path`` not seen under ``checkpoint``.

    The stream stops when no file is left. Its checkpoint remembers the files, and the file sink
    commits each batch once, so a run that was interrupted can simply be started again.
    ``files_per_batch`` limits how much a first load takes on at a time. The table is the stream's
    own: one that was written otherwise is refused.
    """
    schema = to_struct(spec) or read_dataset(spark, path).schema
    # Files are told apart by name; their age must not exclude any.
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrivals = bronze_frame(reader.parquet(path), spec)
    create_streamed(arrivals, table, MONTH_COLUMNS)
    query = (
        arrivals.writeStream.format("parquet")
        .partitionBy(*MONTH_COLUMNS)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .toTable(table)
    )
    query.awaitTermination()
