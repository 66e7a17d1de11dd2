"""Reports over the summary tables. They read aggregates, not trips, wherever one exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.columns import col
from tripstrata.names import LABEL


def monthly_counts(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("pickup_year", "pickup_month")
        .agg(F.count(F.lit(1)).alias("trip_count"))
        .orderBy("pickup_year", "pickup_month")
    )


def trips_by_type(trips: DataFrame) -> DataFrame:
    """Trips per type, largest first, from trips or from a summary that has a ``trip_count``."""
    summed = "trip_count" in trips.columns
    count = F.sum("trip_count") if summed else F.count(F.lit(1))
    return (
        trips.groupBy(LABEL).agg(count.alias("trip_count")).orderBy(F.desc("trip_count"), LABEL)
    )


def total_trips(counts: DataFrame) -> DataFrame:
    """Grand total of a table that has a ``trip_count``."""
    return counts.agg(F.coalesce(F.sum("trip_count"), F.lit(0)).alias("total_trips"))


def demand_by_hour(demand: DataFrame) -> DataFrame:
    return (
        demand.groupBy("pickup_hour")
        .agg(F.sum("trip_count").alias("total_trips"))
        .orderBy("pickup_hour")
    )


def demand_by_hour_type(demand: DataFrame) -> DataFrame:
    return by_hour_type(demand, "trip_count", "trip_count").orderBy("pickup_hour", LABEL)


def by_hour_type(summary: DataFrame, value: str, name: str) -> DataFrame:
    """Sums per hour and type in no order, to be pivoted or sorted."""
    return summary.groupBy("pickup_hour", LABEL).agg(F.sum(col(value)).alias(name))


def demand_by_zone(demand: DataFrame) -> DataFrame:
    return demand.groupBy("PULocationID").agg(F.sum("trip_count").alias("trip_count"))


def top_zones(demand: DataFrame, k: int = 10) -> DataFrame:
    """The busiest pickup zones, equal counts ordered by zone. Each task keeps its own first k."""
    return demand_by_zone(demand).orderBy(F.desc("trip_count"), "PULocationID").limit(k)


def revenue_by_type(revenue: DataFrame) -> DataFrame:
    totals = revenue.groupBy(LABEL).agg(
        F.sum("total_revenue").alias("revenue"), F.sum("trip_count").alias("trip_count")
    )
    # Half-even rounding, as in the ratio this column reproduces.
    per_trip = F.bround(F.col("revenue") / F.col("trip_count"), 2)
    return totals.withColumn("revenue_per_trip", per_trip).orderBy(F.desc("revenue"), LABEL)


def revenue_by_hour_type(revenue: DataFrame) -> DataFrame:
    return by_hour_type(revenue, "total_revenue", "revenue").orderBy("pickup_hour", LABEL)


def duration_summary(stats: DataFrame) -> DataFrame:
    return stats.select(
        LABEL,
        "trip_count",
        "avg_duration_min",
        "median_duration_min",
        "p90_duration_min",
        "min_duration_min",
        "max_duration_min",
    ).orderBy(F.desc("trip_count"), LABEL)


def pivot_hourly(df: DataFrame, value: str, types: Sequence[str] | None = None) -> DataFrame:
    """One row per hour, one column per trip type. Naming the types saves the job that finds them."""
    grouped = df.groupBy("pickup_hour").pivot(LABEL, list(types) if types is not None else None)
    return grouped.agg(F.sum(col(value))).orderBy("pickup_hour")


def filter_types(df: DataFrame, types: Sequence[str]) -> DataFrame:
    return df.where(F.col(LABEL).isin(list(types)))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).distinct().orderBy(col(column))


def label_zones(
    df: DataFrame, zones: DataFrame, zone: str = "PULocationID", zone_id: str = "LocationID"
) -> DataFrame:
    """Attach zone attributes; zones without an entry keep their row.

    No side is forced to be broadcast: Spark does so when the measured size of the lookup is below
    its threshold, and otherwise joins by shuffle with its skew handling. Label summary tables
    rather than trips where both would do.
    """
    lookup = zones.withColumnRenamed(zone_id, zone)
    return df.join(lookup, zone, "left")


def profile(df: DataFrame) -> DataFrame:
    """Row count, column count and schema text in one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumns(
        {
            "column_count": F.lit(len(df.columns)),
            "schema": F.lit(df.schema.simpleString()),
        }
    )
