"""Each check is a query on Spark and the SQL that gives the same rows independently of it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acceptance import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str, uses: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under its name. ``uses`` are the shared subqueries its SQL refers to."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLES[query.__name__] = with_subqueries(sql, uses)
        return query

    return register


PICKUP = {
    "yellow": "tpep_pickup_datetime",
    "green": "lpep_pickup_datetime",
    "fhvhv": "pickup_datetime",
    "fhv": "pickup_datetime",
}
DROPOFF = {
    "yellow": "tpep_dropoff_datetime",
    "green": "lpep_dropoff_datetime",
    "fhvhv": "dropoff_datetime",
    "fhv": '"dropOff_datetime"',
}
OPERATOR = {
    "yellow": "VendorID",
    "green": "VendorID",
    "fhvhv": "dispatching_base_num",
    "fhv": "dispatching_base_num",
}
FARES = {
    "yellow": ("fare_amount", "tip_amount", "sum(total_amount)"),
    "green": ("fare_amount", "tip_amount", "sum(total_amount)"),
    "fhvhv": ("base_passenger_fare", "tips", "sum(base_passenger_fare) + sum(tips)"),
}
_ZONES = "PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263"
_METERED_FLAGS = {
    "is_valid_location": _ZONES,
    "is_valid_passenger_count": "passenger_count BETWEEN 1 AND 6",
    "is_valid_distance": "trip_distance > 0",
    "is_valid_fare": "fare_amount BETWEEN 2.5 AND 250",
    "is_valid_duration": "trip_duration_min BETWEEN 1 AND 180",
}
_SECONDS = "BETWEEN 60 AND 10800"
FLAGS = {
    "yellow": _METERED_FLAGS,
    "green": _METERED_FLAGS,
    "fhvhv": {
        "is_valid_location": _ZONES,
        "is_valid_distance": "trip_miles > 0",
        "is_valid_fare": "base_passenger_fare > 0",
        "is_valid_trip_time": f"trip_time {_SECONDS}",
        "is_valid_actual_duration": f"actual_duration_sec {_SECONDS}",
    },
    "fhv": {"is_valid_location": _ZONES, "is_valid_duration": f"duration_sec {_SECONDS}"},
}


def _subqueries() -> dict[str, str]:
    parts: dict[str, str] = {}
    for label in fx.LABELS:
        pickup, dropoff = PICKUP[label], DROPOFF[label]
        seconds = f"date_diff('second', {pickup}, {dropoff})"
        length = {
            "yellow": f"{seconds} / CAST(60 AS DOUBLE) AS trip_duration_min",
            "green": f"{seconds} / CAST(60 AS DOUBLE) AS trip_duration_min",
            "fhvhv": f"{seconds} AS actual_duration_sec",
            "fhv": f"{seconds} AS duration_sec",
        }[label]
        order = ", ".join(f"{name} ASC NULLS FIRST" for name in fx.TIEBREAKS[label])
        flags = FLAGS[label]
        parts[f"{label}_bronze"] = (
            f"SELECT *, CAST(year({pickup}) AS INTEGER) AS pickup_year, "
            f"CAST(month({pickup}) AS INTEGER) AS pickup_month "
            f"FROM ({fx.SOURCES[label](fx.DUCKDB)})"
        )
        parts[f"{label}_deduped"] = (
            f"SELECT * FROM {label}_bronze QUALIFY row_number() OVER (PARTITION BY {pickup}, "
            f"{dropoff}, PULocationID, DOLocationID, {OPERATOR[label]}"
            f"{' ORDER BY ' + order if order else ''}) = 1"
        )
        parts[f"{label}_flagged"] = (
            f"SELECT *, {', '.join(f'{test} AS {name}' for name, test in flags.items())} "
            f"FROM (SELECT *, {length} FROM {label}_deduped)"
        )
        parts[f"{label}_checked"] = (
            f"SELECT *, {' AND '.join(flags)} AS is_valid_trip FROM {label}_flagged"
        )
        parts[f"{label}_clean"] = f"SELECT * FROM {label}_checked WHERE is_valid_trip"
    for name, stage in (("raw_trips", "bronze"), ("trips", "clean")):
        parts[name] = " UNION ALL ".join(
            f"SELECT '{label}' AS trip_type, {PICKUP[label]} AS pickup_datetime, "
            f"{DROPOFF[label]} AS dropoff_datetime, PULocationID, DOLocationID, pickup_year, "
            f"pickup_month FROM {label}_{stage}"
            for label in fx.LABELS
        )
    for name, source in (("raw_demand", "raw_trips"), ("demand", "trips")):
        parts[name] = (
            "SELECT trip_type, PULocationID, "
            "CAST(dayofweek(pickup_datetime) + 1 AS INTEGER) AS pickup_dow, "
            "CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, count(*) AS trip_count "
            f"FROM {source} GROUP BY ALL"
        )
    for name, stage in (("raw_revenue", "bronze"), ("revenue", "clean")):
        parts[name] = " UNION ALL ".join(
            f"SELECT '{label}' AS trip_type, PULocationID, "
            f"CAST(hour({PICKUP[label]}) AS INTEGER) AS pickup_hour, sum({fare}) AS total_fare, "
            f"sum({tips}) AS total_tips, {total} AS total_revenue, count(*) AS trip_count "
            f"FROM {label}_{stage} GROUP BY ALL"
            for label, (fare, tips, total) in FARES.items()
        )
    for name, stage in (("raw_exact_revenue", "bronze"), ("exact_revenue", "clean")):
        exact = "sum(CAST({} AS DECIMAL(18, 4)))".format
        parts[name] = " UNION ALL ".join(
            f"SELECT '{label}' AS trip_type, PULocationID, "
            f"CAST(hour({PICKUP[label]}) AS INTEGER) AS pickup_hour, CAST({exact(fare)} AS DOUBLE) AS total_fare, "
            f"CAST({exact(tips)} AS DOUBLE) AS total_tips, "
            f"CAST({exact('total_amount') if label in ('yellow', 'green') else exact(fare) + ' + ' + exact(tips)} "
            "AS DOUBLE) AS total_revenue, count(*) AS trip_count "
            f"FROM {label}_{stage} GROUP BY ALL"
            for label, (fare, tips, _) in FARES.items()
        )
    for name, source in (("raw_durations", "raw_trips"), ("durations", "trips")):
        minutes = "ROUND({} / CAST(60 AS DOUBLE), 2)".format
        parts[name] = (
            "SELECT trip_type, count(*) AS trip_count, "
            f"{minutes('avg(seconds)')} AS avg_duration_min, "
            f"{minutes('quantile_disc(seconds, 0.5)')} AS median_duration_min, "
            f"{minutes('quantile_disc(seconds, 0.9)')} AS p90_duration_min, "
            f"{minutes('min(seconds)')} AS min_duration_min, "
            f"{minutes('max(seconds)')} AS max_duration_min "
            "FROM (SELECT trip_type, "
            f"date_diff('second', pickup_datetime, dropoff_datetime) AS seconds FROM {source}) "
            "GROUP BY trip_type"
        )
    return parts


SUBQUERIES = _subqueries()


def with_subqueries(sql: str, uses: tuple[str, ...]) -> str:
    """Prefix the subqueries a query uses and those they use themselves."""
    needed: set[str] = set()

    def add(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for other in SUBQUERIES:
                if other != name and _mentions(SUBQUERIES[name], other):
                    add(other)

    for name in uses:
        add(name)
    if not needed:
        return sql
    listed = ", ".join(f"{name} AS ({SUBQUERIES[name]})" for name in SUBQUERIES if name in needed)
    return f"WITH {listed} {sql}"


def _mentions(sql: str, name: str) -> bool:
    return f"FROM {name} " in f"{sql} ".replace(")", " ")
