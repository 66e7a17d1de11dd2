"""Monthly parts of summaries: they add up, read only what changed, and do not depend on the order of rows."""

import random
import uuid
from datetime import datetime, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acceptance import fixtures as fx
from tripstrata.operators import (
    dedup_first,
    demand_parts,
    demand_patterns,
    duration_parts,
    duration_sketches,
    duration_stats,
    latest_month,
    loaded_months,
    merge_demand,
    merge_duration_sketches,
    merge_durations,
    merge_revenue,
    revenue,
    revenue_by_zone_hour,
    revenue_parts,
    rule_report,
)
from tripstrata.plans import Layers, rebuild_months, refresh_months, run_pipeline, silver, silver_report
from tripstrata.plans.gold import DEMAND, DURATION, REVENUE, UNIFIED, parts_of
from tripstrata.session import scratch_dir
from tripstrata.sources import in_months, overwrite_months, read_table, stored_months, write_bucketed

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def trips(spark):
    return fx.trips(spark, SF_DIR)


def test_parts_add_up(spark, trips):
    assert rows(merge_demand(demand_parts(trips))) == rows(demand_patterns(trips))
    assert rows(merge_durations(duration_parts(trips))) == rows(duration_stats(trips))
    sources = {label: fx.bronze(spark, SF_DIR, label) for label in fx.LABELS}
    assert rows(merge_revenue(revenue_parts(sources, fx.SPECS))) == rows(revenue(sources, fx.SPECS))


def test_parts_of_any_split_of_months_add_up(trips):
    halves = [trips.where("pickup_month <= 6"), trips.where("pickup_month > 6 OR pickup_month IS NULL")]
    parts = reduce(DataFrame.unionByName, [duration_parts(half) for half in halves])
    assert rows(merge_durations(parts)) == rows(duration_stats(trips))


def test_sums_do_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(1)
    start = datetime(2025, 5, 1)
    data = [
        (1 + k % 3, start + timedelta(hours=k % 5), rng.choice([0.1, 0.2, 0.3, 1e9 + 0.7, -1e9 - 0.7]), 0.1 * (k % 7))
        for k in range(4000)
    ]
    found = []
    for seed, parts in ((1, 1), (2, 7), (3, 30)):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "zone int, ts timestamp_ntz, fare double, tips double").repartition(parts)
        found.append(rows(revenue_by_zone_hour(df, "x", "ts", "zone", "fare", "tips")))
    assert found[0] == found[1] == found[2]


def test_amounts_that_are_no_numbers(spark):
    at = datetime(2025, 5, 1)
    schema = "zone int, ts timestamp_ntz, fare double, tips double"
    odd = spark.createDataFrame([(1, at, float("nan"), 1.0), (1, at, None, 0.25), (2, at, None, None)], schema)
    found = rows(revenue_by_zone_hour(odd, "x", "ts", "zone", "fare", "tips"))
    assert [r[2:5] for r in found] == [(None, None, 1.25), (None, None, None)]
    for wrong in (1e14, float("inf")):
        df = spark.createDataFrame([(1, at, wrong, 1.0)], schema)
        with pytest.raises(Exception, match="out of range"):
            revenue_by_zone_hour(df, "x", "ts", "zone", "fare", "tips").collect()


def test_types_without_any_duration(spark):
    at = datetime(2025, 5, 1)
    data = [("a", at, None), ("a", None, at), ("b", at, at + timedelta(seconds=90)), ("b", at, None)]
    df = spark.createDataFrame(data, "trip_type string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz")
    assert [tuple(r) for r in duration_stats(df).orderBy("trip_type").collect()] == [
        ("a", 2, None, None, None, None, None), ("b", 2, 1.5, 1.5, 1.5, 1.5, 1.5),
    ]


def test_durations_scan_the_trips_once(spark, trips, tmp_path):
    trips.write.parquet(f"{tmp_path}/trips")
    stats = duration_stats(spark.read.parquet(f"{tmp_path}/trips"))
    stats.collect()
    plan = stats._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") + plan.count("Scan parquet") - plan.count("ReusedExchange") <= 1
    assert "ReusedExchange" in plan


@pytest.fixture
def refreshed(spark, tmp_path):
    run = uuid.uuid4().hex
    layers = Layers(*(f"{x}_{run}" for x in ("bronze", "silver", "gold")), location=str(tmp_path))
    sources = fx.write_raw(spark, SF_DIR, scratch_dir(spark, "raw"))
    run_pipeline(spark, sources, layers, fx.SPECS.values(), drifting=("fhv",))
    return layers


def summaries(spark, layers):
    return {name: rows(read_table(spark, f"{layers.gold}.{name}")) for name in (DEMAND, REVENUE, DURATION)}


def test_a_changed_month_equals_a_full_refresh(spark, refreshed, monkeypatch):
    before = summaries(spark, refreshed)
    months = [(2024, 1), (2024, 3), (None, None)]
    table = f"{refreshed.bronze}.yellow"
    raw = read_table(spark, table)
    path = scratch_dir(spark, "month")
    raw.where(in_months(months)).write.parquet(path)
    assert spark.read.parquet(path).count() > 0
    overwrite_months(raw.limit(0), table, months)
    refresh_months(spark, refreshed, months, fx.SPECS.values())
    without = summaries(spark, refreshed)
    assert all(without[name] != before[name] for name in before)
    trips = read_table(spark, f"{refreshed.gold}.{UNIFIED}")
    assert without[DEMAND] == rows(demand_patterns(trips)) and without[DURATION] == rows(duration_stats(trips))
    overwrite_months(spark.read.schema(raw.schema).parquet(path), table, months)
    refresh_months(spark, refreshed, months, fx.SPECS.values())
    assert summaries(spark, refreshed) == before


def test_a_refresh_reads_only_the_changed_month(spark, refreshed):
    """Months that did not change could not even be read."""
    months = [(2024, 2)]
    before = summaries(spark, refreshed)
    others = f"{refreshed.gold}.{UNIFIED}"
    folder = spark.sql(f"DESCRIBE EXTENDED {others}").where("col_name = 'Location'").first().data_type
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for year in files.listStatus(root):
        for month in files.listStatus(year.getPath()) if year.isDirectory() else ():
            name = month.getPath().toString()
            if "pickup_year=2024/pickup_month=2" in name or not month.isDirectory():
                continue
            for part in files.listStatus(month.getPath()):
                files.create(part.getPath(), True).close()
    spark.catalog.refreshTable(others)
    refresh_months(spark, refreshed, months, fx.SPECS.values())
    assert summaries(spark, refreshed) == before


def test_summaries_without_parts_are_an_error(spark, refreshed):
    spark.sql(f"DROP TABLE {refreshed.gold}.{parts_of(DEMAND)}")
    with pytest.raises(ValueError, match="no monthly parts"):
        refresh_months(spark, refreshed, [(2024, 2)], fx.SPECS.values())


def test_parts_are_small(spark, refreshed):
    parts = read_table(spark, f"{refreshed.gold}.{parts_of(DEMAND)}")
    assert parts.where(F.col("trip_count") < 1).isEmpty()
    assert {"pickup_year", "pickup_month"} <= set(parts.columns)


def report(spark, layers, label="yellow"):
    return silver_report(spark, layers.clean(label), fx.SPECS[label]).first().asDict()


def test_rule_counters_follow_the_months(spark, refreshed, monkeypatch):
    clean, months = refreshed.clean("yellow"), [(2024, 3)]
    spec = fx.SPECS["yellow"]

    def counted():
        return rule_report(read_table(spark, f"{clean}_checked"), spec.rules).first().asDict()

    assert report(spark, refreshed) == counted()
    table = f"{refreshed.bronze}.yellow"
    raw = read_table(spark, table)
    thinned = raw.where(in_months(months)).where("PULocationID % 2 = 0")
    overwrite_months(thinned, table, months)
    rebuild_months(spark, table, spec, clean, months)
    assert report(spark, refreshed) == counted()
    plan = silver_report(spark, clean, spec)._jdf.queryExecution().executedPlan().toString()
    assert "is_valid_location" not in plan
    # A refresh that breaks off before its counters are written leaves none behind for that month.
    monkeypatch.setattr(silver, "_write_counters", lambda *args: 1 / 0)
    overwrite_months(raw.where(in_months(months)).limit(5), table, months)
    with pytest.raises(ZeroDivisionError):
        rebuild_months(spark, table, spec, clean, months)
    assert report(spark, refreshed) == counted()


def test_months_from_the_catalog(spark, refreshed):
    tables = {label: refreshed.clean(label) for label in fx.LABELS}
    found = stored_months(spark, tables)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Scan parquet" not in plan
    trips = read_table(spark, f"{refreshed.gold}.{UNIFIED}")
    assert rows(found) == rows(loaded_months(trips))
    newest = latest_month(found).first().latest_month
    assert newest == latest_month(trips).first().latest_month
    both = stored_months(spark, {"yellow": refreshed.clean("yellow")}, side=None)
    assert both.count() >= found.where("trip_type = 'yellow'").count()


def test_sketches_of_months_merge(spark):
    rng = random.Random(2)
    start = datetime(2025, 1, 1)
    data = []
    for k in range(40_000):
        at = start + timedelta(hours=k % 4000)
        length = rng.choice((60, 61, 3600)) if k % 10 == 0 else int(rng.lognormvariate(6, 1))
        data.append(("ab"[k % 2], at, at + timedelta(seconds=length) if k % 50 else None, at.year, at.month))
    schema = "trip_type string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pickup_year int, pickup_month int"
    trips = spark.createDataFrame([*data, ("c", start, None, 2025, 1)], schema).repartition(6)
    merged = {r.trip_type: r for r in merge_duration_sketches(duration_sketches(trips)).collect()}
    exact = {r.trip_type: r for r in duration_stats(trips).collect()}
    for kind in "abc":
        for name in ("trip_count", "avg_duration_min", "min_duration_min", "max_duration_min"):
            assert merged[kind][name] == exact[kind][name]
    assert merged["c"].median_duration_min is None
    for kind in "ab":
        seconds = sorted((d - p).total_seconds() for t, p, d, *_ in data if t == kind and d)
        for share, name in ((0.5, "median_duration_min"), (0.9, "p90_duration_min")):
            value = merged[kind][name] * 60
            low = sum(s < value - 0.5 for s in seconds) / len(seconds)
            high = sum(s <= value + 0.5 for s in seconds) / len(seconds)
            assert low - 0.005 <= share <= high + 0.005
        assert len(merged[kind].sketch) < 100_000


def test_a_bucketed_table_is_deduplicated_without_a_shuffle(spark, database):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    assert write_bucketed(lines, f"{database}.lines", keys, 8) == lines.count()
    stored = read_table(spark, f"{database}.lines")
    kept = dedup_first(stored, keys, ["l_shipdate"], ["l_partkey", "l_suppkey"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows(kept) == rows(dedup_first(lines, keys, ["l_shipdate"], ["l_partkey", "l_suppkey"]))
