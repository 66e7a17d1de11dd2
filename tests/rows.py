"""Rows with every column of a dataset, valid unless changed."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

from tripstrata import FHVHV, GREEN, YELLOW

START = datetime(2025, 5, 3, 13, 30)
METERED = {
    "VendorID": 1,
    "PULocationID": 10,
    "DOLocationID": 20,
    "passenger_count": 2,
    "trip_distance": 3.5,
    "fare_amount": 20.0,
    "tip_amount": 2.0,
    "total_amount": 25.0,
}
VALID = {
    "yellow": {
        **METERED,
        "tpep_pickup_datetime": START,
        "tpep_dropoff_datetime": START + timedelta(minutes=10),
    },
    "green": {
        **METERED,
        "lpep_pickup_datetime": START,
        "lpep_dropoff_datetime": START + timedelta(minutes=10),
        "trip_type": 1,
    },
    "fhvhv": {
        "dispatching_base_num": "B1",
        "pickup_datetime": START,
        "dropoff_datetime": START + timedelta(minutes=10),
        "PULocationID": 10,
        "DOLocationID": 20,
        "trip_miles": 3.5,
        "trip_time": 600,
        "base_passenger_fare": 20.0,
        "tips": 2.0,
    },
    "fhv": {
        "dispatching_base_num": "B1",
        "pickup_datetime": START,
        "dropOff_datetime": START + timedelta(minutes=10),
        "PUlocationID": 10,
        "DOlocationID": 20,
    },
}
SCHEMAS = {
    **{spec.label: spec.schema for spec in (YELLOW, GREEN, FHVHV)},
    "fhv": "dispatching_base_num string, pickup_datetime timestamp_ntz, "
    "dropOff_datetime timestamp_ntz, PUlocationID int, DOlocationID int",
}


def frame(spark, label, changes, extra=""):
    """One row per entry of ``changes``, each a dict of values that differ from a valid row."""
    schema = T.StructType.fromDDL(", ".join(part for part in (SCHEMAS[label], extra) if part))
    rows = []
    for change in changes:
        unknown = set(change) - set(schema.names)
        assert not unknown, unknown
        values = {**VALID[label], **change}
        rows.append(tuple(values.get(name) for name in schema.names))
    return spark.createDataFrame(rows, schema)
