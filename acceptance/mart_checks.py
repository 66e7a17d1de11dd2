"""Stacked trips, summary tables and the reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance import fixtures as fx
from acceptance.registry import check
from tripstrata.functions.times import minutes_between
from tripstrata.operators import (
    demand_by_hour,
    demand_by_hour_type,
    demand_by_zone,
    demand_patterns,
    distinct_values,
    duration_sketches,
    duration_stats,
    duration_summary,
    filter_types,
    label_zones,
    merge_duration_sketches,
    narrow,
    pivot_hourly,
    revenue,
    revenue_by_hour_type,
    revenue_by_type,
    top_zones,
    total_trips,
    trips_by_type,
)

SHOWN = ("yellow", "fhvhv")
MONEY = ("total_fare", "total_tips", "total_revenue")


def _demand(spark, sf_dir):
    return demand_patterns(fx.trips(spark, sf_dir))


def _revenue(spark, sf_dir):
    sources = {label: fx.bronze(spark, sf_dir, label) for label in fx.LABELS}
    return revenue(sources, fx.SPECS)


def rounded(frame, *columns):
    """Sums of doubles differ in their last digits between engines and runs. All amounts are whole
    cents, so rounding to cents removes that and nothing else."""
    return frame.withColumns({name: F.round(name, 2) for name in columns})


@check("SELECT * FROM raw_trips", uses=("raw_trips",))
def unify_sources(spark, sf_dir):
    return fx.trips(spark, sf_dir)


@check("SELECT trip_type, count(*) AS trip_count FROM raw_trips GROUP BY trip_type",
       uses=("raw_trips",))
def count_by_source(spark, sf_dir):
    return trips_by_type(fx.trips(spark, sf_dir))


@check("SELECT * FROM raw_demand", uses=("raw_demand",))
def demand_by_type_zone_day_hour(spark, sf_dir):
    return _demand(spark, sf_dir)


@check("""
    SELECT 'events' AS trip_type, CAST(user_id AS INTEGER) AS "PULocationID",
      CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_dow, CAST(hour(ts) AS INTEGER) AS pickup_hour,
      count(*) AS trip_count
    FROM events GROUP BY ALL
""")
def demand_of_events(spark, sf_dir):
    mapping = {"pickup_datetime": "ts", "PULocationID": "user_id"}
    events = fx.table(spark, sf_dir, "events")
    return demand_patterns(narrow(events, "events", mapping, {"PULocationID": "int"}))


@check(
    "SELECT pickup_hour, CAST(sum(trip_count) AS BIGINT) AS total_trips FROM raw_demand "
    "GROUP BY pickup_hour",
    uses=("raw_demand",),
)
def demand_per_hour(spark, sf_dir):
    return demand_by_hour(_demand(spark, sf_dir))


@check(
    "SELECT pickup_hour, trip_type, CAST(sum(trip_count) AS BIGINT) AS trip_count "
    "FROM raw_demand GROUP BY ALL",
    uses=("raw_demand",),
)
def demand_per_hour_type(spark, sf_dir):
    return demand_by_hour_type(_demand(spark, sf_dir))


@check(
    "SELECT PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM raw_demand "
    "GROUP BY PULocationID",
    uses=("raw_demand",),
)
def demand_per_zone(spark, sf_dir):
    return demand_by_zone(_demand(spark, sf_dir))


@check(
    "SELECT PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM raw_demand "
    "GROUP BY PULocationID ORDER BY trip_count DESC, PULocationID NULLS FIRST LIMIT 10",
    uses=("raw_demand",),
)
def top_ten_zones(spark, sf_dir):
    return top_zones(_demand(spark, sf_dir))


@check(
    """
    SELECT PULocationID, trip_count, n_name FROM (
      SELECT PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM raw_demand
      GROUP BY PULocationID)
    LEFT JOIN nation ON PULocationID = n_nationkey
    """,
    uses=("raw_demand",),
)
def zone_names(spark, sf_dir):
    zones = fx.table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return label_zones(demand_by_zone(_demand(spark, sf_dir)), zones, zone_id="n_nationkey")


@check(
    "SELECT trip_type, PULocationID, pickup_hour, round(total_fare, 2) AS total_fare, "
    "round(total_tips, 2) AS total_tips, round(total_revenue, 2) AS total_revenue, trip_count "
    "FROM raw_revenue",
    uses=("raw_revenue",),
)
def revenue_zone_hour(spark, sf_dir):
    return rounded(_revenue(spark, sf_dir), *MONEY)


@check(
    "SELECT trip_type, round(sum(total_revenue), 2) AS revenue, "
    "CAST(sum(trip_count) AS BIGINT) AS trip_count, "
    "round_even(sum(total_revenue) / sum(trip_count), 2) AS revenue_per_trip "
    "FROM raw_revenue GROUP BY trip_type",
    uses=("raw_revenue",),
)
def revenue_per_type(spark, sf_dir):
    return rounded(revenue_by_type(_revenue(spark, sf_dir)), "revenue")


@check(
    "SELECT pickup_hour, trip_type, round(sum(total_revenue), 2) AS revenue "
    "FROM raw_revenue GROUP BY ALL",
    uses=("raw_revenue",),
)
def revenue_per_hour_type(spark, sf_dir):
    return rounded(revenue_by_hour_type(_revenue(spark, sf_dir)), "revenue")


@check("SELECT * FROM raw_exact_revenue", uses=("raw_exact_revenue",))
def revenue_exact(spark, sf_dir):
    """Not rounded: sums are exact, whatever the order of rows."""
    return _revenue(spark, sf_dir)


@check("SELECT * FROM raw_durations", uses=("raw_durations",))
def duration_statistics(spark, sf_dir):
    return duration_stats(fx.trips(spark, sf_dir))


@check("SELECT * FROM raw_durations", uses=("raw_durations",))
def duration_statistics_approx(spark, sf_dir):
    """The sketch, precise enough to give exact percentiles at this size."""
    return duration_stats(fx.trips(spark, sf_dir), accuracy=1_000_000)


@check("SELECT * FROM raw_durations", uses=("raw_durations",))
def duration_overview(spark, sf_dir):
    return duration_summary(duration_stats(fx.trips(spark, sf_dir)))


@check(
    "SELECT pickup_hour, "
    "CAST(sum(trip_count) FILTER (trip_type = 'yellow') AS BIGINT) AS yellow, "
    "CAST(sum(trip_count) FILTER (trip_type = 'fhvhv') AS BIGINT) AS fhvhv "
    "FROM raw_demand WHERE trip_type IN ('yellow', 'fhvhv') GROUP BY pickup_hour",
    uses=("raw_demand",),
)
def pivot_demand(spark, sf_dir):
    hourly = demand_by_hour_type(_demand(spark, sf_dir))
    return pivot_hourly(filter_types(hourly, SHOWN), "trip_count", SHOWN)


@check(
    "SELECT pickup_hour, round(sum(total_revenue) FILTER (trip_type = 'fhvhv'), 2) AS fhvhv, "
    "round(sum(total_revenue) FILTER (trip_type = 'green'), 2) AS green, "
    "round(sum(total_revenue) FILTER (trip_type = 'yellow'), 2) AS yellow "
    "FROM raw_revenue GROUP BY pickup_hour",
    uses=("raw_revenue",),
)
def pivot_revenue(spark, sf_dir):
    """Without named types Spark finds them first."""
    hourly = revenue_by_hour_type(_revenue(spark, sf_dir))
    return rounded(pivot_hourly(hourly, "revenue"), "fhvhv", "green", "yellow")


@check(
    "SELECT trip_type, PULocationID, pickup_dow, pickup_hour, trip_count FROM raw_demand "
    "WHERE trip_type IN ('yellow', 'fhvhv')",
    uses=("raw_demand",),
)
def chosen_types(spark, sf_dir):
    return filter_types(_demand(spark, sf_dir), SHOWN)


@check("SELECT DISTINCT trip_type FROM raw_trips", uses=("raw_trips",))
def type_options(spark, sf_dir):
    return distinct_values(fx.trips(spark, sf_dir), "trip_type")


@check("SELECT count(*) AS total_trips FROM raw_trips", uses=("raw_trips",))
def trips_in_total(spark, sf_dir):
    return total_trips(trips_by_type(fx.trips(spark, sf_dir)))


@check(
    "SELECT trip_type, trip_count, min_duration_min, max_duration_min, avg_duration_min, true AS sketch_median, "
    "true AS sketch_p90, true AS sampled_median, true AS sampled_p90 FROM raw_durations",
    uses=("raw_durations",),
)
def duration_rank_errors(spark, sf_dir):
    """Percentiles of the merged monthly sketches, and of Spark's samples at their default accuracy: is each
    one's rank among all trips within half a percent?"""
    trips = fx.trips(spark, sf_dir)
    sketched = merge_duration_sketches(duration_sketches(trips)).drop("sketch")
    sampled = duration_stats(trips, accuracy=10_000)
    names = {"median_duration_min": 0.5, "p90_duration_min": 0.9}
    found = sketched.join(
        sampled.select("trip_type", *[F.col(name).alias(f"sampled_{name}") for name in names]), "trip_type"
    )
    minutes = minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    lengths = trips.select("trip_type", F.round(minutes, 2).alias("minutes")).where("minutes IS NOT NULL")
    # Counted before the join, which would bring all trips of a type into one task.
    counted = lengths.groupBy("trip_type", "minutes").agg(F.count(F.lit(1)).alias("trips"))
    tests = []
    for kind, prefix in (("sketch", ""), ("sampled", "sampled_")):
        for name, share in names.items():
            value, n = F.col(prefix + name), F.sum("trips")
            low, high = (
                F.sum(F.when(below, F.col("trips")).otherwise(0)) / n
                for below in (F.col("minutes") < value, F.col("minutes") <= value)
            )
            near = (low - 0.005 <= share) & (high + 0.005 >= share)
            tests.append(near.alias(f"{kind}_{name.split('_')[0]}"))
    kept = ("trip_type", "trip_count", "min_duration_min", "max_duration_min", "avg_duration_min")
    return counted.join(found, "trip_type").groupBy(*kept).agg(*tests)
