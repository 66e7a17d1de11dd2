"""Every bound of every rule, NULLs, and the split."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.rows import START, VALID, frame
from tripstrata import ALL, FHV, FHVHV, GREEN, YELLOW, Rule
from tripstrata.operators import apply_rules, route, rule_alerts, rule_report, split
from tripstrata.plans import with_duration

PICKUP = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}
DROPOFF = {
    "yellow": "tpep_dropoff_datetime",
    "green": "lpep_dropoff_datetime",
    "fhvhv": "dropoff_datetime",
    "fhv": "dropOff_datetime",
}
SPECS = {spec.label: spec for spec in ALL}


def checked(spark, label, changes):
    spec = SPECS[label]
    return apply_rules(with_duration(frame(spark, label, changes), spec), spec.rules)


def flags(spark, label, flag, changes):
    rows = checked(spark, label, changes).select(flag, "is_valid_trip").collect()
    assert all(row[0] == row[1] for row in rows), "only the changed column may fail"
    return [row[0] for row in rows]


@pytest.mark.parametrize("label", sorted(SPECS))
@pytest.mark.parametrize("side", ["pu", "do"])
def test_location_bounds(spark, label, side):
    column = next(c for c in VALID[label] if c.lower() == f"{side}locationid")
    changes = [{column: zone} for zone in (0, 1, 263, 264, None)]
    assert flags(spark, label, "is_valid_location", changes) == [False, True, True, False, None]


@pytest.mark.parametrize("label", ["yellow", "green"])
def test_metered_bounds(spark, label):
    people = [{"passenger_count": n} for n in (0, 1, 6, 7, None)]
    assert flags(spark, label, "is_valid_passenger_count", people) == [
        False, True, True, False, None,
    ]
    fares = [{"fare_amount": fare} for fare in (2.49, 2.5, 250.0, 250.01)]
    assert flags(spark, label, "is_valid_fare", fares) == [False, True, True, False]
    miles = [{"trip_distance": d} for d in (-1.0, 0.0, 0.01)]
    assert flags(spark, label, "is_valid_distance", miles) == [False, False, True]


def test_unmetered_bounds(spark):
    fares = [{"base_passenger_fare": fare} for fare in (0.0, 0.01, 900.0)]
    assert flags(spark, "fhvhv", "is_valid_fare", fares) == [False, True, True]
    miles = [{"trip_miles": d} for d in (-1.0, 0.0, 0.01)]
    assert flags(spark, "fhvhv", "is_valid_distance", miles) == [False, False, True]
    times = [{"trip_time": t} for t in (59, 60, 10800, 10801)]
    assert flags(spark, "fhvhv", "is_valid_trip_time", times) == [False, True, True, False]


@pytest.mark.parametrize(
    ("label", "flag"),
    [
        ("yellow", "is_valid_duration"),
        ("green", "is_valid_duration"),
        ("fhvhv", "is_valid_actual_duration"),
        ("fhv", "is_valid_duration"),
    ],
)
def test_duration_bounds(spark, label, flag):
    seconds = (-3480, 59, 60, 10800, 10801, 1578280 * 60)
    changes = [{DROPOFF[label]: START + timedelta(seconds=s)} for s in seconds]
    assert flags(spark, label, flag, changes) == [False, False, True, True, False, False]


def test_reported_and_measured_length_are_independent(spark):
    change = {"dropoff_datetime": START - timedelta(minutes=58), "trip_time": 600}
    row = checked(spark, "fhvhv", [change]).first()
    assert row.is_valid_trip_time and not row.is_valid_actual_duration
    assert row.actual_duration_sec == -3480


def test_null_policies(spark):
    changes = [{}, {"passenger_count": None}, {"passenger_count": None, "trip_distance": 0.0}]
    frame_ = checked(spark, "yellow", changes)
    assert [row.is_valid_trip for row in frame_.collect()] == [True, None, False]

    clean, rejected = split(frame_)
    assert (clean.count(), rejected.count()) == (1, 2)
    clean, rejected = split(frame_, null_policy="drop")
    assert (clean.count(), rejected.count()) == (1, 1)
    for policy, expected in (("quarantine", ["clean", "quarantine", "quarantine"]),
                             ("drop", ["clean", "quarantine"])):
        assert sorted(r._route for r in route(frame_, policy).collect()) == expected
    with pytest.raises(ValueError, match="null_policy"):
        split(frame_, "keep")
    with pytest.raises(ValueError, match="null_policy"):
        route(frame_, "keep")


def test_report_and_alerts(spark):
    changes = [{}, {"passenger_count": None}, {"passenger_count": 9}, {"fare_amount": 1.0}]
    report = rule_report(checked(spark, "green", changes), GREEN.rules)
    row = report.first()
    assert row.total == 4
    assert (row.bad_passenger_count, row.unknown_passenger_count) == (1, 1)
    assert (row.bad_fare, row.bad_location, row.unknown_fare) == (1, 0, 0)
    alerts = {r.rule: r for r in rule_alerts(report, GREEN.rules, 20).collect()}
    assert alerts["fare"].alert and alerts["fare"].failed_pct == 25.0
    assert not alerts["distance"].alert


def test_report_of_nothing(spark):
    empty = checked(spark, "yellow", [{}]).where("false")
    report = rule_report(empty, YELLOW.rules)
    assert report.first().total == 0 and report.first().bad_fare == 0
    assert all(r.failed_pct == 0.0 for r in rule_alerts(report, YELLOW.rules, 0).collect())


def test_optional_rules_pass_without_their_columns(spark):
    bare = frame(spark, "fhv", [{}]).drop("dropOff_datetime", "PUlocationID")
    row = apply_rules(with_duration(bare, FHV), FHV.rules).first()
    assert row.is_valid_location and row.is_valid_duration and row.is_valid_trip


def test_required_rule_names_the_columns(spark):
    with pytest.raises(ValueError, match="trip_miles"):
        apply_rules(frame(spark, "fhvhv", [{}]).drop("trip_miles"), FHVHV.rules)
    with pytest.raises(ValueError, match="no bound"):
        apply_rules(frame(spark, "fhv", [{}]), [Rule("empty", ("PUlocationID",))])


def test_one_sided_bounds(spark):
    numbers = spark.range(5)
    rules = [Rule("low", ("id",), low=3), Rule("high", ("id",), high=3, above=1)]
    kept = apply_rules(numbers, rules).where("is_valid_trip")
    assert [row.id for row in kept.collect()] == [3]


def test_time_window_rule(spark):
    window = Rule.window("window", "pickup_datetime", datetime(2025, 5, 1), datetime(2025, 6, 1))
    days = (datetime(2025, 4, 30, 23, 59, 59), datetime(2025, 5, 1), datetime(2025, 5, 31, 23, 59),
            datetime(2025, 6, 1))
    rows = frame(spark, "fhv", [{"pickup_datetime": day} for day in days])
    seen = {r.pickup_datetime: r.is_valid_window for r in apply_rules(rows, [window]).collect()}
    assert [seen[day] for day in days] == [False, True, True, False]


def test_wall_clock_times_do_not_move_with_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        night = datetime(2025, 3, 9, 1, 50)  # the hour after it is skipped in this zone
        change = {"tpep_pickup_datetime": night,
                  "tpep_dropoff_datetime": night + timedelta(minutes=30)}
        row = checked(spark, "yellow", [change]).select(
            "trip_duration_min", F.hour("tpep_pickup_datetime").alias("h")
        ).first()
        assert (row.h, row.trip_duration_min) == (1, 30.0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_nan_is_large_or_unknown(spark):
    rows = frame(spark, "fhvhv", [{"base_passenger_fare": float("nan")}])
    checked = with_duration(rows, FHVHV)
    assert apply_rules(checked, FHVHV.rules).first().is_valid_fare is True
    assert apply_rules(checked, FHVHV.rules, nan_is_unknown=True).first().is_valid_fare is None
