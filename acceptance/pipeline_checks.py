"""The whole way from raw parquet folders to the summary tables."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance import fixtures as fx
from acceptance.mart_checks import MONEY, rounded
from acceptance.registry import FLAGS, check
from tripstrata.operators import missing_partitions, monthly_counts
from tripstrata.plans import (
    Layers,
    dashboard,
    refresh_months,
    refresh_new_files,
    run_pipeline,
    silver_report,
)
from tripstrata.plans.gold import DEMAND, DURATION, REVENUE, UNIFIED
from tripstrata.session import scratch_dir
from tripstrata.sources import in_months, overwrite_months, read_table, stored_months
from tripstrata.sources.tables import COMPACT


DURATIONS = tuple(f"{name}_duration_min" for name in ("avg", "median", "p90", "min", "max"))
_REFRESHED: dict[tuple[str, str], Layers] = {}


def full_refresh(spark, sf_dir) -> Layers:
    """Every step from the given tables, done once for a session and its data."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _REFRESHED:
        _REFRESHED[key] = new_refresh(spark, sf_dir)
    return _REFRESHED[key]


def new_refresh(spark, sf_dir) -> Layers:
    """Raw folders from the given tables, then every step. Databases are new on each run."""
    run = uuid.uuid4().hex
    names = [f"{layer}_{run}" for layer in ("bronze", "silver", "gold")]
    layers = Layers(*names, location=scratch_dir(spark, "layers"))
    sources = fx.write_raw(spark, sf_dir, scratch_dir(spark, "raw"))
    run_pipeline(spark, sources, layers, fx.SPECS.values(), drifting=("fhv",))
    return layers


@check(
    " UNION ALL ".join(
        f"SELECT '{label}' AS trip_type, (SELECT count(*) FROM {label}_bronze) AS bronze, "
        f"(SELECT count(*) FROM {label}_clean) AS clean, "
        f"(SELECT count(*) FROM {label}_checked ) - (SELECT count(*) FROM {label}_clean) "
        f"AS quarantine, (SELECT count(*) FROM trips WHERE trip_type = '{label}') AS unified"
        for label in fx.LABELS
    ),
    uses=("trips",),
)
def refresh_row_counts(spark, sf_dir):
    layers = full_refresh(spark, sf_dir)
    rows = []
    for label in fx.LABELS:
        tables = {
            "bronze": read_table(spark, f"{layers.bronze}.{label}"),
            "clean": read_table(spark, layers.clean(label)),
            "quarantine": read_table(spark, layers.quarantine(label)),
            "unified": read_table(spark, f"{layers.gold}.{UNIFIED}").where(
                F.col("trip_type") == label
            ),
        }
        rows += [
            df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(label).alias("trip_type"), F.lit(layer).alias("layer"), "n"
            )
            for layer, df in tables.items()
        ]
    stacked = reduce(DataFrame.unionByName, rows)
    return stacked.groupBy("trip_type").pivot("layer", list(tables)).agg(F.sum("n"))


@check("SELECT * FROM trips", uses=("trips",))
def refresh_trips(spark, sf_dir):
    return read_table(spark, f"{full_refresh(spark, sf_dir).gold}.{UNIFIED}")


@check("SELECT * FROM trips", uses=("trips",))
def refresh_then_add_month(spark, sf_dir):
    """A month is taken out of a raw table and put back; each time only it is worked on again."""
    layers = new_refresh(spark, sf_dir)
    table, months = f"{layers.bronze}.yellow", [(1995, 3), (1995, 4)]
    path = scratch_dir(spark, "month")
    raw = read_table(spark, table)
    raw.where(in_months(months)).write.parquet(path)
    for rows in (raw.limit(0), spark.read.schema(raw.schema).parquet(path)):
        overwrite_months(rows, table, months)
        refresh_months(spark, layers, months, fx.SPECS.values())
    return read_table(spark, f"{layers.gold}.{UNIFIED}")


_SUMMARY = "{} AS summary, trip_type, {} AS zone, {} AS dow, {} AS hour, trip_count, {} AS amounts"


@check(
    f"""
    SELECT {_SUMMARY.format("'demand'", "PULocationID", "pickup_dow", "pickup_hour", "CAST([] AS DOUBLE[])")}
    FROM demand
    UNION ALL SELECT {_SUMMARY.format("'revenue'", "PULocationID", "CAST(NULL AS INTEGER)", "pickup_hour",
      "[total_fare, total_tips, total_revenue]")} FROM exact_revenue
    UNION ALL SELECT {_SUMMARY.format("'durations'", "CAST(NULL AS INTEGER)", "CAST(NULL AS INTEGER)",
      "CAST(NULL AS INTEGER)", "[avg_duration_min, median_duration_min, p90_duration_min, min_duration_min, "
      "max_duration_min]")} FROM durations
    """,
    uses=("demand", "exact_revenue", "durations"),
)
def refresh_month_summaries(spark, sf_dir):
    """All summaries after a month was taken out of a raw table and put back; unrounded sums included."""
    layers = new_refresh(spark, sf_dir)
    table, months = f"{layers.bronze}.yellow", [(1995, 3), (2024, 1), (2024, 2)]
    path = scratch_dir(spark, "month")
    raw = read_table(spark, table)
    raw.where(in_months(months)).write.parquet(path)
    for rows in (raw.limit(0), spark.read.schema(raw.schema).parquet(path)):
        overwrite_months(rows, table, months)
        refresh_months(spark, layers, months, fx.SPECS.values())
    shown = {
        DEMAND: ("demand", "PULocationID", "pickup_dow", "pickup_hour", ()),
        REVENUE: ("revenue", "PULocationID", None, "pickup_hour", MONEY),
        DURATION: ("durations", None, None, None, DURATIONS),
    }
    frames = [
        read_table(spark, f"{layers.gold}.{name}").select(
            F.lit(summary).alias("summary"),
            "trip_type",
            *[
                (F.col(c) if c else F.lit(None).cast("int")).alias(alias)
                for c, alias in ((zone, "zone"), (dow, "dow"), (hour, "hour"))
            ],
            "trip_count",
            F.array(*amounts).cast("array<double>").alias("amounts"),
        )
        for name, (summary, zone, dow, hour, amounts) in shown.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@check(
    "SELECT trip_type, PULocationID, pickup_dow, pickup_hour, trip_count FROM demand WHERE trip_type <> 'fhv'",
    uses=("demand",),
)
def refresh_by_arrivals(spark, sf_dir):
    """Files of some months each in three arrivals, each brought into all layers; the last run finds nothing."""
    run = uuid.uuid4().hex
    layers = Layers(*(f"{x}_{run}" for x in ("bronze", "silver", "gold")), scratch_dir(spark, "layers"))
    folder, specs = scratch_dir(spark, "arrivals"), [fx.SPECS[x] for x in fx.LABELS if x != "fhv"]
    sources = {spec.label: f"{folder}/{spec.label}" for spec in specs}
    for arrival in range(3):
        for spec in specs:
            rows = fx.raw(spark, sf_dir, spec.label)
            month = F.month(spec.pickup.equals_ci)
            now = rows.where(F.pmod(month, F.lit(3)) == arrival)
            now.write.options(**COMPACT).mode("append").parquet(sources[spec.label])
        refresh_new_files(spark, sources, layers, specs)
    if any(refresh_new_files(spark, sources, layers, specs).values()):
        raise ValueError("months were refreshed again")
    return read_table(spark, f"{layers.gold}.{DEMAND}")


@check("SELECT * FROM trips", uses=("trips",))
def refresh_in_passes(spark, sf_dir):
    """Clean tables built in several passes over months, under the settings of a cluster."""
    run = uuid.uuid4().hex
    layers = Layers(*(f"{x}_{run}" for x in ("bronze", "silver", "gold")), scratch_dir(spark, "layers"))
    sources = fx.write_raw(spark, sf_dir, scratch_dir(spark, "raw"))
    run_pipeline(
        spark, sources, layers, fx.SPECS.values(), drifting=("fhv",), rows_per_pass=20_000, layout="rebalance"
    )
    return read_table(spark, f"{layers.gold}.{UNIFIED}")


@check("SELECT * FROM demand", uses=("demand",))
def refresh_demand(spark, sf_dir):
    return read_table(spark, f"{full_refresh(spark, sf_dir).gold}.{DEMAND}")


@check(
    "SELECT trip_type, PULocationID, pickup_hour, round(total_fare, 2) AS total_fare, "
    "round(total_tips, 2) AS total_tips, round(total_revenue, 2) AS total_revenue, trip_count "
    "FROM revenue",
    uses=("revenue",),
)
def refresh_revenue(spark, sf_dir):
    return rounded(read_table(spark, f"{full_refresh(spark, sf_dir).gold}.{REVENUE}"), *MONEY)


@check("SELECT * FROM durations", uses=("durations",))
def refresh_durations(spark, sf_dir):
    return read_table(spark, f"{full_refresh(spark, sf_dir).gold}.{DURATION}")


@check(
    "SELECT pickup_year, pickup_month, count(*) AS trip_count FROM yellow_clean GROUP BY ALL",
    uses=("yellow_clean",),
)
def refresh_monthly_counts(spark, sf_dir):
    return monthly_counts(read_table(spark, full_refresh(spark, sf_dir).clean("yellow")))


def _report_sql(label: str) -> str:
    counts = []
    for flag in FLAGS[label]:
        name = flag.removeprefix("is_valid_")
        counts.append(f"count(*) FILTER (NOT {flag}) AS bad_{name}")
        counts.append(f"count(*) FILTER ({flag} IS NULL) AS unknown_{name}")
    return f"SELECT count(*) AS total, {', '.join(counts)} FROM {label}_checked"


@check(_report_sql("fhv"), uses=("fhv_checked",))
def refresh_rule_report(spark, sf_dir):
    layers = full_refresh(spark, sf_dir)
    return silver_report(spark, layers.clean("fhv"), fx.SPECS["fhv"])


@check(_report_sql("yellow"), uses=("yellow_checked",))
def refresh_month_rule_report(spark, sf_dir):
    """The report from counters, after one month was checked again and another lost its counters."""
    layers = new_refresh(spark, sf_dir)
    clean, months = layers.clean("yellow"), [(2024, 1)]
    refresh_months(spark, layers, months, fx.SPECS.values())
    counters = f"{clean}_rule_counts"
    overwrite_months(read_table(spark, counters).limit(0), counters, [(2024, 5)])
    return silver_report(spark, clean, fx.SPECS["yellow"])


_MONTHS = "SELECT DISTINCT trip_type, pickup_year, pickup_month FROM"


@check(
    f"""
    SELECT 'raw' AS layer, * FROM ({_MONTHS} raw_trips)
    UNION ALL SELECT 'clean', * FROM ({_MONTHS} trips)
    """,
    uses=("raw_trips", "trips"),
)
def stored_months_by_layer(spark, sf_dir):
    """Months of the raw and the clean tables, from the catalog alone."""
    layers = full_refresh(spark, sf_dir)
    raw = stored_months(spark, {label: f"{layers.bronze}.{label}" for label in fx.LABELS})
    clean = stored_months(spark, {label: layers.clean(label) for label in fx.LABELS})
    named = [df.select(F.lit(x).alias("layer"), "*") for x, df in (("raw", raw), ("clean", clean))]
    return reduce(DataFrame.unionByName, named)


@check(
    """
    SELECT label AS trip_type, CAST(year(month) AS INTEGER) AS pickup_year,
      CAST(month(month) AS INTEGER) AS pickup_month
    FROM (SELECT unnest(['yellow', 'green', 'fhvhv', 'fhv']) AS label)
    CROSS JOIN generate_series(DATE '2023-03-01', DATE '2024-06-01', INTERVAL 1 MONTH) g(month)
    WHERE NOT EXISTS (
      SELECT 1 FROM trips
      WHERE trip_type = label AND pickup_year = year(month) AND pickup_month = month(month))
    """,
    uses=("trips",),
)
def missing_stored_months(spark, sf_dir):
    layers = full_refresh(spark, sf_dir)
    found = stored_months(spark, {label: layers.clean(label) for label in fx.LABELS})
    return missing_partitions(found, fx.LABELS, date(2023, 3, 1), 16)


@check(
    "SELECT PULocationID, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM demand "
    "GROUP BY PULocationID ORDER BY trip_count DESC, PULocationID LIMIT 10",
    uses=("demand",),
)
def dashboard_top_zones(spark, sf_dir):
    layers = full_refresh(spark, sf_dir)
    return dashboard(spark, layers.gold, fx.LABELS)["top_zones"]


@check(
    "SELECT pickup_hour, round(sum(total_revenue) FILTER (trip_type = 'yellow'), 2) AS yellow, "
    "round(sum(total_revenue) FILTER (trip_type = 'green'), 2) AS green, "
    "round(sum(total_revenue) FILTER (trip_type = 'fhvhv'), 2) AS fhvhv "
    "FROM revenue GROUP BY pickup_hour",
    uses=("revenue",),
)
def dashboard_revenue_by_hour(spark, sf_dir):
    layers = full_refresh(spark, sf_dir)
    pages = dashboard(spark, layers.gold, ("yellow", "green"))
    return rounded(pages["revenue_by_hour"], "yellow", "green", "fhvhv")


def _page(name):
    def query(spark, sf_dir):
        return dashboard(spark, full_refresh(spark, sf_dir).gold, ("yellow", "fhv"))[name]

    query.__name__ = f"dashboard_{name}"
    return query


_COUNT = "CAST(sum(trip_count) AS BIGINT)"
for _name, _sql in {
    "trips_by_type": f"SELECT trip_type, {_COUNT} AS trip_count FROM demand GROUP BY trip_type",
    "total_trips": f"SELECT {_COUNT} AS total_trips FROM demand",
    "type_options": "SELECT DISTINCT trip_type FROM demand",
    "demand_by_hour": "SELECT pickup_hour, "
    "CAST(sum(trip_count) FILTER (trip_type = 'yellow') AS BIGINT) AS yellow, "
    "CAST(sum(trip_count) FILTER (trip_type = 'fhv') AS BIGINT) AS fhv "
    "FROM demand WHERE trip_type IN ('yellow', 'fhv') GROUP BY pickup_hour",
}.items():
    check(_sql, uses=("demand",))(_page(_name))


@check("SELECT * FROM durations", uses=("durations",))
def dashboard_duration_summary(spark, sf_dir):
    return dashboard(spark, full_refresh(spark, sf_dir).gold, fx.LABELS)["duration_summary"]


@check(
    "SELECT trip_type, round(sum(total_revenue), 2) AS revenue, "
    f"{_COUNT} AS trip_count, round(sum(total_revenue) / sum(trip_count), 1) AS per_trip "
    "FROM revenue GROUP BY trip_type",
    uses=("revenue",),
)
def dashboard_revenue_by_type(spark, sf_dir):
    page = dashboard(spark, full_refresh(spark, sf_dir).gold, fx.LABELS)["revenue_by_type"]
    per_trip = F.round(F.col("revenue") / F.col("trip_count"), 1).alias("per_trip")
    return rounded(page.select("trip_type", "revenue", "trip_count", per_trip), "revenue")
