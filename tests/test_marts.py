from datetime import date, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance.mart_checks import duration_rank_errors
from tests.rows import START, frame
from tripstrata import ALL, FHV
from tripstrata.operators import (
    demand_by_hour,
    demand_patterns,
    distinct_values,
    duration_histogram,
    duration_stats,
    expected_months,
    label_zones,
    latest_month,
    missing_partitions,
    narrow,
    pivot_hourly,
    profile,
    revenue,
    revenue_by_type,
    top_zones,
    total_trips,
    trips_by_type,
    incomplete_sources,
    unify_trips,
)
from tripstrata.operators.marts import _evenly, _exact_stats
from tripstrata.sources import with_partition_columns

SPECS = {spec.label: spec for spec in ALL}
PICKUP = {
    "yellow": "tpep_pickup_datetime",
    "green": "lpep_pickup_datetime",
    "fhvhv": "pickup_datetime",
    "fhv": "pickup_datetime",
}


def source(spark, label, changes=({},)):
    return with_partition_columns(frame(spark, label, changes), PICKUP[label])


def all_sources(spark):
    return {label: source(spark, label) for label in SPECS}


def test_unify_shape_and_labels(spark):
    sources = all_sources(spark)
    sources["green"] = source(spark, "green", [{"trip_type": 1}, {"trip_type": 2}])
    sources["fhv"] = sources["fhv"].withColumn("PUlocationID", F.col("PUlocationID").cast("double"))
    trips = unify_trips(sources, SPECS)
    assert trips.dtypes == [
        ("trip_type", "string"),
        ("pickup_datetime", "timestamp_ntz"),
        ("dropoff_datetime", "timestamp_ntz"),
        ("PULocationID", "int"),
        ("DOLocationID", "int"),
        ("pickup_year", "int"),
        ("pickup_month", "int"),
    ]
    counts = {r.trip_type: r.trip_count for r in trips_by_type(trips).collect()}
    assert counts == {"yellow": 1, "green": 2, "fhvhv": 1, "fhv": 1}
    assert trips_by_type(trips).first().trip_type == "green"


def test_incomplete_source_is_skipped_or_an_error(spark):
    sources = all_sources(spark)
    sources["fhv"] = sources["fhv"].drop("dropOff_datetime")
    labels = {r.trip_type for r in unify_trips(sources, SPECS).collect()}
    assert labels == {"yellow", "green", "fhvhv"}
    sources["green"] = sources["green"].drop("lpep_pickup_datetime")
    with pytest.raises(ValueError, match="green has no column"):
        unify_trips(sources, SPECS)
    assert set(incomplete_sources(sources, SPECS)) == {"fhv", "green"}
    assert unify_trips(sources, SPECS, on_missing="skip").count() == 2
    sources["green"] = all_sources(spark)["green"]
    with pytest.raises(ValueError, match="fhv has no column"):
        unify_trips(sources, SPECS, on_missing="raise")
    with pytest.raises(ValueError, match="on_missing"):
        unify_trips(sources, SPECS, on_missing="ignore")
    with pytest.raises(ValueError, match="no source"):
        unify_trips({"fhv": sources["fhv"]}, SPECS)


def test_unify_does_not_shuffle(spark):
    plan = unify_trips(all_sources(spark), SPECS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_narrow_keeps_only_mapped_columns(spark):
    row = narrow(source(spark, "green"), "green", {"zone": "PULocationID"}, {"zone": "string"})
    assert row.columns == ["trip_type", "zone"] and row.first() == ("green", "10")


def test_demand_day_and_hour(spark):
    saturday = START  # 3 May 2025
    changes = [{"pickup_datetime": saturday + timedelta(days=d)} for d in (0, 1, 1)]
    trips = unify_trips({"fhvhv": source(spark, "fhvhv", changes)}, SPECS)
    demand = demand_patterns(trips)
    cells = {(r.pickup_dow, r.pickup_hour, r.trip_count) for r in demand.collect()}
    assert cells == {(7, 13, 1), (1, 13, 2)}
    assert demand_by_hour(demand).collect() == [(13, 3)]
    assert total_trips(demand).first()[0] == 3
    assert total_trips(demand.where("false")).first()[0] == 0


def test_revenue_definitions(spark):
    sources = {
        "yellow": source(spark, "yellow", [{"total_amount": 30.0}, {"total_amount": 40.0}]),
        "fhvhv": source(spark, "fhvhv", [{}, {"tips": None}, {"tips": None, "PULocationID": 11}]),
        "fhv": source(spark, "fhv"),
        "green": source(spark, "green", [{"trip_type": 2}]),
    }
    result = {(r.trip_type, r.PULocationID): r for r in revenue(sources, SPECS).collect()}
    assert set(result) == {("yellow", 10), ("fhvhv", 10), ("fhvhv", 11), ("green", 10)}
    assert result["yellow", 10].total_revenue == 70.0
    assert result["fhvhv", 10].total_revenue == 42.0
    # No tip in the whole group leaves the revenue unknown.
    assert result["fhvhv", 11].total_revenue is None
    assert result["fhvhv", 11].total_fare == 20.0
    assert result["green", 10].trip_count == 1
    with pytest.raises(ValueError, match="fares"):
        revenue({"fhv": sources["fhv"]}, SPECS)


def test_revenue_per_trip_rounds_half_to_even(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, 1.0, 8), ("b", 1, 1, 3.0, 8)],
        "trip_type string, PULocationID int, pickup_hour int, total_revenue double, trip_count bigint",
    )
    result = {r.trip_type: r.revenue_per_trip for r in revenue_by_type(rows).collect()}
    assert result == {"a": 0.12, "b": 0.38}


def timed(spark, label, seconds):
    changes = [
        {"dropoff_datetime": None if s is None else START + timedelta(seconds=s)} for s in seconds
    ]
    return unify_trips({label: source(spark, label, changes)}, SPECS)


@pytest.mark.parametrize("accuracy", [None, 10000])
def test_duration_stats(spark, accuracy):
    trips = timed(spark, "fhvhv", [60, 60, 61, 90, 120, 300, 600, 600, 6000, 10800, None])
    row = duration_stats(trips, accuracy).first()
    assert row.trip_count == 11
    assert (row.min_duration_min, row.max_duration_min) == (1.0, 180.0)
    assert row.median_duration_min == 2.0
    assert row.p90_duration_min == 100.0
    assert row.avg_duration_min == 31.15


@pytest.mark.parametrize("accuracy", [None, 10000])
def test_duration_stats_without_any_duration(spark, accuracy):
    row = duration_stats(timed(spark, "fhvhv", [None, None]), accuracy).first()
    assert row.trip_count == 2
    assert row.avg_duration_min is None and row.median_duration_min is None
    assert row.max_duration_min is None


def test_exact_and_approximate_percentiles_agree(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    seconds = F.col("l_orderkey") * 31 % 11400 - 300
    trips = lines.select(
        F.col("l_returnflag").alias("trip_type"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.timestamp_add("SECOND", seconds, "l_shipdate").alias("dropoff_datetime"),
    )
    exact = {tuple(r) for r in duration_stats(trips).collect()}
    assert exact == {tuple(r) for r in duration_stats(trips, accuracy=1_000_000).collect()}
    assert duration_histogram(trips).count() < trips.count()


def test_samples_are_taken_from_a_bounded_number_of_trips(spark):
    """And the ranks of approximate percentiles stay within 1 / accuracy."""
    start = F.lit("2025-05-03 13:30:00").cast("timestamp_ntz")
    trips = spark.range(50_000).select(
        F.lit("a").alias("trip_type"),
        start.alias("pickup_datetime"),
        F.timestamp_add("SECOND", F.col("id") * 7919 % 50_000 - 300, start).alias("dropoff_datetime"),
    )
    spread = _evenly(duration_histogram(trips), 200)
    assert spread.where("copy IS NOT NULL").count() == 200
    assert spread.where("coalesce(copy, 1) = 1").agg(F.sum("trips")).first()[0] == 50_000
    row = duration_stats(trips, accuracy=100).first()
    assert row.trip_count == 50_000
    assert abs(row.median_duration_min * 60 + 300 - 25_000) <= 500
    assert abs(row.p90_duration_min * 60 + 300 - 45_000) <= 500


def test_rank_errors_join_counts_and_no_trips(spark):
    """Joined trips of a type would all be in one task."""
    plan = duration_rank_errors(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    side = plan.toString().split("Join Inner", 1)[1].splitlines()[1]
    assert "Aggregate [trip_type" in side and "count(1)" in side


def test_pivot_with_and_without_types(spark):
    demand = spark.createDataFrame(
        [(5, "a", 1), (5, "b", 2), (6, "a", 3)], "pickup_hour int, trip_type string, trip_count bigint"
    )
    assert pivot_hourly(demand, "trip_count").collect() == [(5, 1, 2), (6, 3, None)]
    named = pivot_hourly(demand, "trip_count", ["b", "c"])
    assert named.columns == ["pickup_hour", "b", "c"]
    assert named.collect() == [(5, 2, None), (6, None, None)]
    assert [r[0] for r in distinct_values(demand, "trip_type").collect()] == ["a", "b"]


def test_top_zones_ties_and_names(spark):
    demand = spark.createDataFrame(
        [(3, 5), (1, 5), (2, 9), (4, 1)], "PULocationID int, trip_count bigint"
    )
    top = top_zones(demand, 3)
    assert top.collect() == [(2, 9), (1, 5), (3, 5)]
    zones = spark.createDataFrame([(1, "One"), (2, "Two")], "LocationID int, name string")
    names = {r.PULocationID: r.name for r in label_zones(top, zones).collect()}
    assert names == {1: "One", 2: "Two", 3: None}


def test_missing_and_latest_months(spark):
    months = [(2025, 11), (2025, 12), (2026, 2)]
    rows = spark.createDataFrame(
        [("a", y, m) for y, m in months], "trip_type string, pickup_year int, pickup_month int"
    )
    missing = missing_partitions(rows, ["a", "b"], date(2025, 11, 9), 4)
    assert sorted(missing.collect()) == [
        ("a", 2026, 1), ("b", 2025, 11), ("b", 2025, 12), ("b", 2026, 1), ("b", 2026, 2),
    ]
    assert expected_months(rows, ["a"], date(2025, 5, 1), 12).count() == 12
    assert latest_month(rows).first()[0] == date(2026, 2, 1)
    assert latest_month(rows, as_of=date(2026, 4, 30)).first()[0] == date(2026, 2, 1)
    assert latest_month(rows, as_of=date(2026, 3, 31)).first()[0] == date(2025, 12, 1)
    assert latest_month(rows, as_of=date(2026, 9, 1), max_lookback=6).first()[0] == date(2026, 2, 1)
    assert latest_month(rows, as_of=date(2026, 10, 1), max_lookback=6).first()[0] is None


def test_grid_has_no_cross_join(spark):
    rows = spark.createDataFrame(
        [("a", 2025, 1)], "trip_type string, pickup_year int, pickup_month int"
    )
    plan = missing_partitions(rows, ["a", "b"], date(2025, 1, 1), 6)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_profile(spark):
    row = profile(spark.range(3)).first()
    assert (row.row_count, row.column_count, row.schema) == (3, 1, "struct<id:bigint>")


def test_stacking_keeps_duplicates(spark):
    sources = {label: source(spark, label, [{}, {}]) for label in SPECS}
    trips = unify_trips(sources, SPECS)
    assert trips.count() == 8
    parts = [unify_trips({label: df}, SPECS) for label, df in sources.items()]
    assert reduce(DataFrame.unionByName, parts).exceptAll(trips).isEmpty()
    assert FHV.money is None


def test_durations_over_ten_years(spark):
    """Percentiles are exact without a window over all durations of a type."""
    seconds = [k * 7919 % 315_360_000 for k in range(0, 40_000, 7)] + [-5, -4000]
    histogram = spark.createDataFrame([("yellow", s, 1 + s % 3) for s in seconds] + [("green", None, 2)],
                                      "trip_type string, seconds long, trips long")
    stats = _exact_stats(histogram)
    assert "Window" not in stats._jdf.queryExecution().executedPlan().toString()
    found = {r.trip_type: r for r in stats.collect()}
    every = sorted(s for s in seconds for _ in range(1 + s % 3))
    for name, share in (("median_duration_min", 0.5), ("p90_duration_min", 0.9)):
        expected = every[-(-int(share * 10) * len(every) // 10) - 1]
        assert found["yellow"][name] == pytest.approx(round(expected / 60, 2))
    assert found["green"].trip_count == 2 and found["green"].median_duration_min is None
