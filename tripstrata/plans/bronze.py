"""Raw files to a table partitioned by pickup month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripstrata.functions.columns import require_column
from tripstrata.sources.scan import (
    read_dataset,
    read_drifting,
    with_ingest_metadata,
    with_partition_columns,
)
from tripstrata.sources.tables import SORTED_LATER, write_table
from tripstrata.spec import DatasetSpec

MONTH_COLUMNS = ("pickup_year", "pickup_month")


def bronze_frame(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Raw rows plus month columns, load time and source file."""
    pickup = require_column(raw, spec.pickup, "pickup datetime")
    return with_ingest_metadata(with_partition_columns(raw, pickup))


def load_bronze(
    spark: SparkSession,
    source: str | list[str],
    spec: DatasetSpec,
    table: str,
    drifting: bool = False,
    layout: str = "as_is",
) -> int:
    """Load one dataset and return the rows written. No shuffle: each task writes the months of
    the files it read.

    With ``drifting``, ``source`` lists files or folders whose column types may differ.
    ``layout="rebalance"`` shuffles by month, where files hold many stray months.
    """
    if drifting:
        raw = read_drifting(spark, [source] if isinstance(source, str) else source, spec)
    else:
        raw = read_dataset(spark, source, spec)
    rows = bronze_frame(raw, spec)
    return write_table(rows, table, partition_by=MONTH_COLUMNS, layout=layout, options=SORTED_LATER)
