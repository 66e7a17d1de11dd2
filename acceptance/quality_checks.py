"""Deduplication, rules, the split and the failure report."""

from __future__ import annotations

from pyspark.sql import functions as F

from acceptance import fixtures as fx
from acceptance.ingest_checks import _database
from acceptance.registry import FLAGS, check
from tripstrata.operators import (
    apply_rules,
    dedup_first,
    dedup_report,
    route,
    rule_alerts,
    rule_report,
    split,
)
from tripstrata.plans.silver import checked_frame, dedup_keys, with_duration
from tripstrata.sources import read_table, write_bucketed, write_split

LINE_KEYS = ["l_orderkey", "l_linenumber"]
SHOWN = {
    "yellow": "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, "
    "passenger_count, trip_distance, fare_amount, tip_amount, total_amount, trip_duration_min",
    "green": "VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, PULocationID, DOLocationID, "
    "passenger_count, trip_distance, fare_amount, tip_amount, total_amount, trip_duration_min",
    "fhvhv": "dispatching_base_num, pickup_datetime, dropoff_datetime, PULocationID, "
    "DOLocationID, trip_miles, trip_time, base_passenger_fare, tips, actual_duration_sec",
    "fhv": 'dispatching_base_num, pickup_datetime, "dropOff_datetime", "PUlocationID", '
    '"DOlocationID", duration_sec',
}


def _shown(label: str) -> str:
    return f"{SHOWN[label]}, {', '.join(FLAGS[label])}, is_valid_trip, pickup_year, pickup_month"


def _columns(label: str) -> list[str]:
    return _shown(label).replace('"', "").split(", ")


def _checked(spark, sf_dir, label):
    return checked_frame(fx.bronze(spark, sf_dir, label), fx.SPECS[label])


@check("""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
      l_extendedprice
    FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1
""")
def dedup_keep_first(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    kept = dedup_first(lines, LINE_KEYS, ["l_shipdate"], ["l_partkey", "l_suppkey"])
    return kept.select(
        *LINE_KEYS, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@check("""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
      l_extendedprice
    FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1
""")
def dedup_bucketed(spark, sf_dir):
    """From a table laid out by the key: the deduplication itself shuffles nothing."""
    table = f"{_database(spark)}.lines"
    write_bucketed(fx.table(spark, sf_dir, "lineitem"), table, LINE_KEYS, 16)
    lines = read_table(spark, table)
    kept = dedup_first(lines, LINE_KEYS, ["l_shipdate"], ["l_partkey", "l_suppkey"])
    return kept.select(
        *LINE_KEYS, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@check("""
    SELECT * FROM (
      SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM lineitem
      WHERE l_quantity <> 7 QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) = 1)
    UNION ALL
    SELECT NULL, NULL, l_shipdate, l_partkey, l_suppkey FROM lineitem WHERE l_quantity = 7
""")
def dedup_keep_unkeyed(spark, sf_dir):
    """Rows without any key are all kept on request."""
    known = F.col("l_quantity") != 7
    lines = fx.table(spark, sf_dir, "lineitem").select(
        *[F.when(known, F.col(key)).alias(key) for key in LINE_KEYS],
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
    )
    return dedup_first(
        lines, LINE_KEYS, ["l_shipdate"], ["l_partkey", "l_suppkey"], keep_null_keys=True
    )


@check("""
    SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after,
      count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates_removed
    FROM lineitem
""")
def dedup_counts(spark, sf_dir):
    return dedup_report(fx.table(spark, sf_dir, "lineitem"), LINE_KEYS)


@check(f"SELECT {_shown('yellow')} FROM yellow_clean", uses=("yellow_clean",))
def rules_clean(spark, sf_dir):
    clean, _ = split(_checked(spark, sf_dir, "yellow"))
    return clean.select(*_columns("yellow"))


@check(
    f"SELECT {_shown('yellow')} FROM yellow_checked WHERE NOT coalesce(is_valid_trip, false)",
    uses=("yellow_checked",),
)
def rules_quarantine(spark, sf_dir):
    _, rejected = split(_checked(spark, sf_dir, "yellow"))
    return rejected.select(*_columns("yellow"))


@check(
    f"SELECT {_shown('green')} FROM green_checked WHERE is_valid_trip = false",
    uses=("green_checked",),
)
def rules_null_policy(spark, sf_dir):
    """Rows without a verdict are on neither side under the other policy."""
    _, rejected = split(_checked(spark, sf_dir, "green"), null_policy="drop")
    return rejected.select(*_columns("green"))


@check(
    f"SELECT {_shown('fhvhv')} FROM fhvhv_checked", uses=("fhvhv_checked",)
)
def two_duration_rules(spark, sf_dir):
    return _checked(spark, sf_dir, "fhvhv").select(*_columns("fhvhv"))


@check(f"SELECT {_shown('fhv')} FROM fhv_checked", uses=("fhv_checked",))
def found_columns_checked(spark, sf_dir):
    return _checked(spark, sf_dir, "fhv").select(*_columns("fhv"))


@check(
    """
    SELECT dispatching_base_num, pickup_datetime, "PUlocationID", "DOlocationID",
      PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263 AS is_valid_location,
      true AS is_valid_duration,
      PULocationID BETWEEN 1 AND 263 AND DOLocationID BETWEEN 1 AND 263 AS is_valid_trip
    FROM fhv_bronze
    """,
    uses=("fhv_bronze",),
)
def optional_rule(spark, sf_dir):
    """Without a dropoff time no trip fails the duration rule."""
    spec = fx.SPECS["fhv"]
    undated = fx.bronze(spark, sf_dir, "fhv").drop("dropOff_datetime", "pickup_year", "pickup_month")
    return apply_rules(with_duration(undated, spec), spec.rules)


def _report_sql(label: str) -> str:
    counts = []
    for flag in FLAGS[label]:
        name = flag.removeprefix("is_valid_")
        counts.append(f"count(*) FILTER (NOT {flag}) AS bad_{name}")
        counts.append(f"count(*) FILTER ({flag} IS NULL) AS unknown_{name}")
    return f"SELECT count(*) AS total, {', '.join(counts)} FROM {label}_checked"


@check(_report_sql("yellow"), uses=("yellow_checked",))
def rules_report(spark, sf_dir):
    return rule_report(_checked(spark, sf_dir, "yellow"), fx.SPECS["yellow"].rules)


@check(
    " UNION ALL ".join(
        f"""SELECT count(*) AS total, '{flag.removeprefix("is_valid_")}' AS rule,
          count(*) FILTER (NOT {flag}) AS failed, count(*) FILTER ({flag} IS NULL) AS unknown,
          count(*) FILTER (NOT {flag}) * CAST(100 AS DOUBLE) / count(*) AS failed_pct,
          count(*) FILTER (NOT {flag}) * CAST(100 AS DOUBLE) / count(*) > 8 AS alert
        FROM green_checked"""
        for flag in FLAGS["green"]
    ),
    uses=("green_checked",),
)
def rules_alerts(spark, sf_dir):
    rules = fx.SPECS["green"].rules
    return rule_alerts(rule_report(_checked(spark, sf_dir, "green"), rules), rules, 8)


@check(
    """
    SELECT dispatching_base_num, pickup_datetime, trip_time, tips, is_valid_trip, pickup_year,
      pickup_month, CASE WHEN is_valid_trip THEN 'clean' ELSE 'quarantine' END AS side
    FROM fhvhv_checked
    """,
    uses=("fhvhv_checked",),
)
def split_roundtrip(spark, sf_dir):
    """Both halves as stored by one write and read back."""
    database = _database(spark)
    routed = route(_checked(spark, sf_dir, "fhvhv"))
    clean, rejected = f"{database}.trips", f"{database}.trips_quarantine"
    write_split(routed, clean, rejected)
    halves = [
        read_table(spark, name).select(
            "dispatching_base_num",
            "pickup_datetime",
            "trip_time",
            "tips",
            "is_valid_trip",
            "pickup_year",
            "pickup_month",
            F.lit(side).alias("side"),
        )
        for name, side in ((clean, "clean"), (rejected, "quarantine"))
    ]
    return halves[0].unionByName(halves[1])


@check(
    "SELECT (SELECT count(*) FROM green_bronze) AS rows_before, "
    "(SELECT count(*) FROM green_deduped) AS rows_after, "
    "(SELECT count(*) FROM green_bronze) - (SELECT count(*) FROM green_deduped) "
    "AS duplicates_removed",
    uses=("green_bronze", "green_deduped"),
)
def dedup_trip_counts(spark, sf_dir):
    bronze = fx.bronze(spark, sf_dir, "green")
    return dedup_report(bronze, dedup_keys(bronze, fx.SPECS["green"]))
