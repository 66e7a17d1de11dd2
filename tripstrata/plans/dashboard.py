"""The datasets behind the overview, demand, revenue and duration pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripstrata.operators import reports
from tripstrata.plans.gold import DEMAND, DURATION, REVENUE
from tripstrata.sources.tables import read_table


def dashboard(
    spark: SparkSession, gold_db: str, types: Sequence[str], k: int = 10
) -> dict[str, DataFrame]:
    """Every dataset, lazy. ``types`` are those chosen for the demand chart, and limit no other.

    Counts per type come from the demand summary, which holds every trip once. Hourly sums are sorted
    only after the pivot. The revenue chart has a column for each type in its table, found by one
    job on that small table.
    """
    demand = read_table(spark, f"{gold_db}.{DEMAND}")
    revenue = read_table(spark, f"{gold_db}.{REVENUE}")
    durations = read_table(spark, f"{gold_db}.{DURATION}")
    counts = reports.trips_by_type(demand)
    hourly = reports.by_hour_type(demand, "trip_count", "trip_count")
    return {
        "trips_by_type": counts,
        "total_trips": reports.total_trips(demand),
        "type_options": reports.distinct_values(demand, "trip_type"),
        "demand_by_hour": reports.pivot_hourly(
            reports.filter_types(hourly, types), "trip_count", types
        ),
        "top_zones": reports.top_zones(demand, k),
        "revenue_by_type": reports.revenue_by_type(revenue),
        "revenue_by_hour": reports.pivot_hourly(
            reports.by_hour_type(revenue, "total_revenue", "revenue"), "revenue"
        ),
        "duration_summary": reports.duration_summary(durations),
    }
