"""The four trip sources."""

from __future__ import annotations

from tripstrata.spec import ColumnMatch, DatasetSpec, Duration, MoneySpec, Rule, named

# Column names and types of the published files, in file order. The timestamps carry
# no offset, so they are read as timestamp_ntz and do not move with the session time zone.
YELLOW_SCHEMA = """
    VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
    passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type bigint, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double, Airport_fee double, cbd_congestion_fee double
"""
GREEN_SCHEMA = """
    VendorID int, lpep_pickup_datetime timestamp_ntz, lpep_dropoff_datetime timestamp_ntz,
    store_and_fwd_flag string, RatecodeID bigint, PULocationID int, DOLocationID int,
    passenger_count bigint, trip_distance double, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double,
    total_amount double, payment_type bigint, trip_type bigint, congestion_surcharge double,
    cbd_congestion_fee double
"""
FHVHV_SCHEMA = """
    hvfhs_license_num string, dispatching_base_num string, originating_base_num string,
    request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz, pickup_datetime timestamp_ntz,
    dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, trip_miles double,
    trip_time bigint, base_passenger_fare double, tolls double, bcf double, sales_tax double,
    congestion_surcharge double, airport_fee double, tips double, driver_pay double,
    shared_request_flag string, shared_match_flag string, access_a_ride_flag string,
    wav_request_flag string, wav_match_flag string, cbd_congestion_fee double
"""

# Inclusive bounds of the validity rules.
ZONE_BOUNDS = (1, 263)
PASSENGER_BOUNDS = (1, 6)
METERED_FARE_BOUNDS = (2.5, 250)
DURATION_BOUNDS_MIN = (1, 180)
DURATION_BOUNDS_SEC = (60, 10800)

_ZONES = ("PULocationID", "DOLocationID")


def _metered(label: str, schema: str, prefix: str) -> DatasetSpec:
    """Yellow and green differ only in their schema and the prefix of the timestamp names."""
    return DatasetSpec(
        label=label,
        schema=schema,
        pickup=named(f"{prefix}_pickup_datetime"),
        dropoff=named(f"{prefix}_dropoff_datetime"),
        pickup_zone=named("PULocationID"),
        dropoff_zone=named("DOLocationID"),
        keys=("PULocationID", "DOLocationID", "VendorID"),
        duration=Duration("trip_duration_min", "min"),
        rules=(
            Rule.between("location", _ZONES, *ZONE_BOUNDS),
            Rule.between("passenger_count", "passenger_count", *PASSENGER_BOUNDS),
            Rule.gt("distance", "trip_distance", 0),
            Rule.between("fare", "fare_amount", *METERED_FARE_BOUNDS),
            Rule.between("duration", "trip_duration_min", *DURATION_BOUNDS_MIN),
        ),
        money=MoneySpec(fare="fare_amount", tips="tip_amount", total="total_amount"),
    )


YELLOW = _metered("yellow", YELLOW_SCHEMA, "tpep")
GREEN = _metered("green", GREEN_SCHEMA, "lpep")

FHVHV = DatasetSpec(
    label="fhvhv",
    schema=FHVHV_SCHEMA,
    pickup=named("pickup_datetime"),
    dropoff=named("dropoff_datetime"),
    pickup_zone=named("PULocationID"),
    dropoff_zone=named("DOLocationID"),
    keys=("PULocationID", "DOLocationID", "dispatching_base_num"),
    duration=Duration("actual_duration_sec", "sec"),
    rules=(
        Rule.between("location", _ZONES, *ZONE_BOUNDS),
        Rule.gt("distance", "trip_miles", 0),
        Rule.gt("fare", "base_passenger_fare", 0),
        # The reported and the measured length are checked separately: a trip can report a
        # plausible length and still end before it starts.
        Rule.between("trip_time", "trip_time", *DURATION_BOUNDS_SEC),
        Rule.between("actual_duration", "actual_duration_sec", *DURATION_BOUNDS_SEC),
    ),
    money=MoneySpec(fare="base_passenger_fare", tips="tips"),
)

# The columns of this source change spelling between months, so they are found, not declared.
FHV = DatasetSpec(
    label="fhv",
    schema=None,
    pickup=ColumnMatch(all_of=("pickup", "datetime")),
    dropoff=ColumnMatch(all_of=("dropoff", "datetime")),
    pickup_zone=named("pulocationid"),
    dropoff_zone=named("dolocationid"),
    keys=("PULocationID", "DOLocationID", "dispatching_base_num"),
    may_lack_columns=True,
    duration=Duration("duration_sec", "sec"),
    rules=(
        Rule.between("location", _ZONES, *ZONE_BOUNDS, optional=True),
        Rule.between("duration", "duration_sec", *DURATION_BOUNDS_SEC, optional=True),
    ),
)

ALL = (YELLOW, GREEN, FHVHV, FHV)
