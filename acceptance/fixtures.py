"""Trip-shaped inputs derived from the given tables, whole tables each.

Each source is one SELECT that both Spark and DuckDB run; ``Dialect`` holds the few spellings that
differ. The SELECTs only make inputs. What is checked are the operators that run on them.

Every source has duplicates, values on both sides of every rule, and NULLs in checked columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripstrata import datasets
from tripstrata.functions.columns import match_column
from tripstrata.operators.unify import unify_trips
from tripstrata.sources.scan import with_partition_columns
from tripstrata.sources.tables import COMPACT
from tripstrata.spec import DatasetSpec

LABELS = ("yellow", "green", "fhvhv", "fhv")


@dataclass(frozen=True)
class Dialect:
    table: Callable[[str], str]
    plus_seconds: Callable[[str, str], str]
    start: str


SPARK = Dialect(
    table=lambda name: "{" + name + "}",
    plus_seconds=lambda ts, seconds: f"timestampadd(SECOND, {seconds}, {ts})",
    start="TIMESTAMP_NTZ '2023-05-01 00:00:00'",
)
DUCKDB = Dialect(
    table=lambda name: name,
    plus_seconds=lambda ts, seconds: f"{ts} + to_seconds({seconds})",
    start="TIMESTAMP '2023-05-01 00:00:00'",
)

YEAR_SECONDS = 365 * 86400


def _length(key: str) -> str:
    """Trip seconds from -300 to 11099, so that both duration bounds and the sign are crossed."""
    return f"({key}) % 11400 - 300"


def _zone(key: str) -> str:
    """Zones from 0 to 264; the two ends are invalid."""
    return f"CAST(({key}) % 265 AS INT)"


def _cents(value: str, wrap: int) -> str:
    return f"CAST(CAST(floor({value}) AS BIGINT) % {wrap} AS DOUBLE) / CAST(100 AS DOUBLE)"


def yellow(d: Dialect) -> str:
    """Lines that share order and line number become duplicates with different fares."""
    key = "(l_orderkey * 8 + l_linenumber)"
    pickup = d.plus_seconds(d.start, f"({key} * 7919) % {YEAR_SECONDS}")
    fare = _cents("l_extendedprice", 27000)
    tip = "round(l_tax * 100) / CAST(4 AS DOUBLE)"
    return f"""
        SELECT CAST(1 + l_orderkey % 2 AS INT) AS VendorID,
          {pickup} AS tpep_pickup_datetime,
          {d.plus_seconds(pickup, _length(f"{key} * 31"))} AS tpep_dropoff_datetime,
          nullif(CAST(l_quantity AS BIGINT) % 8, 7) AS passenger_count,
          round(l_discount * 100) AS trip_distance,
          CAST(1 + l_suppkey % 6 AS BIGINT) AS RatecodeID,
          CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
          {_zone(key)} AS PULocationID, {_zone(f"{key} * 5 + 1")} AS DOLocationID,
          CAST(1 + l_partkey % 4 AS BIGINT) AS payment_type,
          {fare} AS fare_amount,
          CAST(1 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
          {tip} AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
          CAST(1 AS DOUBLE) AS improvement_surcharge,
          {fare} + {tip} + CAST(2.5 AS DOUBLE) AS total_amount,
          CAST(2.5 AS DOUBLE) AS congestion_surcharge, CAST(0 AS DOUBLE) AS Airport_fee,
          CAST(0.75 AS DOUBLE) AS cbd_congestion_fee
        FROM {d.table("lineitem")}"""


def green(d: Dialect) -> str:
    """Every fifth order repeats the trip of the order before it."""
    key = "(o_orderkey - CASE WHEN o_orderkey % 5 = 4 THEN 1 ELSE 0 END)"
    pickup = d.plus_seconds(d.start, f"({key} * 6151) % {YEAR_SECONDS}")
    fare = _cents("o_totalprice", 27000)
    tip = "CAST(o_custkey % 9 AS DOUBLE) / CAST(2 AS DOUBLE)"
    return f"""
        SELECT CAST(1 + {key} % 2 AS INT) AS VendorID,
          {pickup} AS lpep_pickup_datetime,
          {d.plus_seconds(pickup, _length(f"{key} * 37"))} AS lpep_dropoff_datetime,
          CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
          CAST(1 + o_custkey % 6 AS BIGINT) AS RatecodeID,
          {_zone(key)} AS PULocationID, {_zone(f"{key} * 7 + 1")} AS DOLocationID,
          nullif(o_custkey % 9, 8) AS passenger_count,
          CAST(o_custkey % 40 AS DOUBLE) / CAST(2 AS DOUBLE) AS trip_distance,
          {fare} AS fare_amount,
          CAST(1 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
          {tip} AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
          CAST(NULL AS DOUBLE) AS ehail_fee, CAST(1 AS DOUBLE) AS improvement_surcharge,
          {fare} + {tip} + CAST(2.5 AS DOUBLE) AS total_amount,
          CAST(1 + o_custkey % 4 AS BIGINT) AS payment_type,
          CAST(1 + o_custkey % 2 AS BIGINT) AS trip_type,
          CAST(2.75 AS DOUBLE) AS congestion_surcharge, CAST(0.75 AS DOUBLE) AS cbd_congestion_fee
        FROM {d.table("orders")}"""


def fhvhv(d: Dialect) -> str:
    """Purchases are reported twice, the second time with a higher tip. Zones whose number ends in
    the remainder of every tenth user have no tips at all."""

    def rows(extra_tip: str, where: str) -> str:
        return f"""
        SELECT 'HV' || CAST(user_id % 4 AS VARCHAR(9)) AS hvfhs_license_num,
          'B' || CAST(user_id % 90 AS VARCHAR(9)) AS dispatching_base_num,
          CAST(NULL AS VARCHAR(9)) AS originating_base_num,
          ts AS request_datetime, ts AS on_scene_datetime, ts AS pickup_datetime,
          {d.plus_seconds("ts", _length("event_id * 41"))} AS dropoff_datetime,
          {_zone("user_id * 10")} AS PULocationID, {_zone("event_id * 3 + 1")} AS DOLocationID,
          CAST(floor(value) AS DOUBLE) AS trip_miles,
          event_id * 53 % 11000 AS trip_time,
          value AS base_passenger_fare,
          CAST(0 AS DOUBLE) AS tolls, CAST(1 AS DOUBLE) AS bcf, CAST(1 AS DOUBLE) AS sales_tax,
          CAST(2.75 AS DOUBLE) AS congestion_surcharge, CAST(0 AS DOUBLE) AS airport_fee,
          CASE WHEN user_id % 10 = 3 THEN NULL
               ELSE CAST(event_id % 9 AS DOUBLE) / CAST(2 AS DOUBLE) + {extra_tip} END AS tips,
          value AS driver_pay,
          'N' AS shared_request_flag, 'N' AS shared_match_flag, 'N' AS access_a_ride_flag,
          'N' AS wav_request_flag, 'N' AS wav_match_flag,
          CAST(1.5 AS DOUBLE) AS cbd_congestion_fee
        FROM {d.table("events")} {where}"""

    return rows("0", "") + " UNION ALL " + rows("1", "WHERE event_type = 'purchase'")


def fhv(d: Dialect) -> str:
    """Returned lines are reported twice. Some zones are unknown."""
    # Eleven months: the last one has not been published.
    key = "(l_orderkey * 5309 + l_partkey * 613)"
    pickup = d.plus_seconds(d.start, f"{key} % {335 * 86400}")
    one = f"""
        SELECT 'F' || CAST(l_suppkey AS VARCHAR(9)) AS dispatching_base_num,
          {pickup} AS pickup_datetime,
          {d.plus_seconds(pickup, _length("l_orderkey * 43 + l_partkey"))} AS "dropOff_datetime",
          nullif({_zone("l_partkey")}, 77) AS "PUlocationID",
          {_zone("l_orderkey")} AS "DOlocationID",
          l_linestatus AS batch
        FROM {d.table("lineitem")}"""
    text = one + " UNION ALL " + one + " WHERE l_returnflag = 'R'"
    return text if d is DUCKDB else text.replace('"', "`")


SOURCES = {"yellow": yellow, "green": green, "fhvhv": fhvhv, "fhv": fhv}
READS = {"yellow": "lineitem", "green": "orders", "fhvhv": "events", "fhv": "lineitem"}

# Rows of one load share their ingest time, so these columns settle which duplicate stays. They are
# named because the default starts with the source file, which the oracle does not have.
TIEBREAKS = {
    "yellow": ("total_amount", "fare_amount", "tip_amount", "trip_distance", "passenger_count"),
    "green": ("total_amount", "fare_amount", "tip_amount", "trip_distance", "passenger_count"),
    "fhvhv": ("tips", "base_passenger_fare", "trip_miles", "trip_time"),
    "fhv": (),
}
SPECS: dict[str, DatasetSpec] = {
    spec.label: spec.with_(tiebreak=TIEBREAKS[spec.label]) for spec in datasets.ALL
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    name = READS[label]
    frame = spark.sql(SOURCES[label](SPARK), **{name: table(spark, sf_dir, name)})
    return frame.drop("batch")


def bronze(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Raw rows with their month columns, without the load metadata of files."""
    frame = raw(spark, sf_dir, label)
    return with_partition_columns(frame, match_column(frame, SPECS[label].pickup))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources stacked, before deduplication and checks."""
    return unify_trips({label: bronze(spark, sf_dir, label) for label in LABELS}, SPECS)


def write_raw(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str | list[str]]:
    """Raw parquet folders as the pipeline finds them. Files are written as the tables are read, without a
    shuffle, so each holds rows of any month. The last source comes as two folders that spell and type the
    zone columns differently."""
    sources: dict[str, str | list[str]] = {}
    for label in ("yellow", "green", "fhvhv"):
        sources[label] = f"{folder}/{label}"
        raw(spark, sf_dir, label).write.options(**COMPACT).parquet(sources[label])
    frame = spark.sql(fhv(SPARK), lineitem=table(spark, sf_dir, "lineitem"))
    first, second = f"{folder}/fhv/1", f"{folder}/fhv/2"
    frame.where("batch = 'O'").drop("batch").write.options(**COMPACT).parquet(first)
    (
        frame.where("batch <> 'O'")
        .drop("batch")
        .selectExpr(
            "dispatching_base_num",
            "pickup_datetime",
            "dropOff_datetime",
            "CAST(PUlocationID AS DOUBLE) AS PULocationID",
            "CAST(DOlocationID AS DOUBLE) AS DOLocationID",
        )
        .write.options(**COMPACT)
        .parquet(second)
    )
    sources["fhv"] = [first, second]
    return sources
