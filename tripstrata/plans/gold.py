"""Summary tables from the clean tables.

Each summary is stored twice: as parts, a partition for each month, whose counts and exact sums add up, and
as the table that readers use, put together from the parts alone. When a month changes, only its parts are made
anew from its trips; the rest of a refresh reads parts, whose size does not depend on the number of trips.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tripstrata.operators.marts import (
    demand_parts,
    duration_parts,
    duration_stats,
    merge_demand,
    merge_durations,
    merge_revenue,
    revenue_parts,
)
from tripstrata.operators.unify import unify_trips
from tripstrata.plans.bronze import MONTH_COLUMNS
from tripstrata.sources.tables import in_months, overwrite_months, read_table, write_table
from tripstrata.spec import DatasetSpec

UNIFIED = "trips_unified"
DEMAND = "demand_patterns"
REVENUE = "revenue_by_zone_hour"
DURATION = "trip_duration_stats"


def build_unified(
    spark: SparkSession,
    silver: Mapping[str, str],
    specs: Mapping[str, DatasetSpec],
    gold_db: str,
    layout: str = "as_is",
) -> int:
    """Stack the clean tables. No shuffle: the clean files are already grouped by month."""
    sources = {label: read_table(spark, name) for label, name in silver.items()}
    trips = unify_trips(sources, specs)
    return write_table(trips, f"{gold_db}.{UNIFIED}", partition_by=MONTH_COLUMNS, layout=layout)


def replace_unified_months(
    spark: SparkSession,
    silver: Mapping[str, str],
    specs: Mapping[str, DatasetSpec],
    gold_db: str,
    months: Iterable[tuple[int | None, int | None]],
) -> int:
    """Stack only the given months of the clean tables and replace them; others are not read."""
    months = list(months)
    sources = {
        label: read_table(spark, name).where(in_months(months)) for label, name in silver.items()
    }
    return overwrite_months(unify_trips(sources, specs), f"{gold_db}.{UNIFIED}", months)


def parts_of(summary: str) -> str:
    return f"{summary}_parts"


def build_demand(spark: SparkSession, gold_db: str) -> int:
    trips = read_table(spark, f"{gold_db}.{UNIFIED}")
    _write_parts(demand_parts(trips), f"{gold_db}.{DEMAND}")
    return merge_summary(spark, gold_db, DEMAND)


def build_revenue(
    spark: SparkSession,
    silver: Mapping[str, str],
    specs: Mapping[str, DatasetSpec],
    gold_db: str,
) -> int:
    """Needs only the clean tables that have fares, not the stacked trips."""
    _write_parts(revenue_parts(_paid(spark, silver, specs), specs), f"{gold_db}.{REVENUE}")
    return merge_summary(spark, gold_db, REVENUE)


def build_durations(spark: SparkSession, gold_db: str, accuracy: int | None = None) -> int:
    """With ``accuracy``, percentiles are a sketch of all trips, which has no monthly parts."""
    trips = read_table(spark, f"{gold_db}.{UNIFIED}")
    if accuracy is not None:
        return write_table(duration_stats(trips, accuracy), f"{gold_db}.{DURATION}")
    _write_parts(duration_parts(trips), f"{gold_db}.{DURATION}")
    return merge_summary(spark, gold_db, DURATION)


def replace_summary_months(
    spark: SparkSession,
    silver: Mapping[str, str],
    specs: Mapping[str, DatasetSpec],
    gold_db: str,
    months: Iterable[tuple[int | None, int | None]],
) -> None:
    """Make the parts of the given months anew and put all summaries together again.

    Only those months of the stacked and the clean trips are read. A summary that was never stored in
    parts is an error.
    """
    months = list(months)
    trips = read_table(spark, f"{gold_db}.{UNIFIED}").where(in_months(months))
    changed = {DEMAND: demand_parts(trips), DURATION: duration_parts(trips)}
    if any(specs[label].money for label in silver):
        paid = _paid(spark, silver, specs)
        fresh = {label: df.where(in_months(months)) for label, df in paid.items()}
        changed[REVENUE] = revenue_parts(fresh, specs)
    for summary in changed:
        if not spark.catalog.tableExists(f"{gold_db}.{parts_of(summary)}"):
            raise ValueError(f"{gold_db}.{summary} has no monthly parts; refresh it in full")
    for summary, parts in changed.items():
        overwrite_months(parts, f"{gold_db}.{parts_of(summary)}", months)
        merge_summary(spark, gold_db, summary)


def merge_summary(spark: SparkSession, gold_db: str, summary: str) -> int:
    """Put a summary together from its stored parts."""
    merged = {DEMAND: merge_demand, REVENUE: merge_revenue, DURATION: merge_durations}[summary]
    parts = read_table(spark, f"{gold_db}.{parts_of(summary)}")
    return write_table(merged(parts), f"{gold_db}.{summary}")


def _paid(
    spark: SparkSession, silver: Mapping[str, str], specs: Mapping[str, DatasetSpec]
) -> dict[str, DataFrame]:
    return {label: read_table(spark, name) for label, name in silver.items() if specs[label].money}


def _write_parts(parts: DataFrame, summary: str) -> None:
    """One file for each month: the rows of a month are few, and summed up before the exchange."""
    write_table(parts.repartition(*MONTH_COLUMNS), parts_of(summary), partition_by=MONTH_COLUMNS)
