"""All layers on trip-shaped files, and what must hold between them."""

import uuid

import pytest
from pyspark.sql import functions as F

from acceptance import fixtures as fx
from tests.rows import START, frame
from tripstrata import YELLOW
from tripstrata.operators import demand_patterns, total_trips
from tripstrata.plans import (
    Layers,
    bronze_frame,
    build_silver,
    dashboard,
    load_bronze,
    refresh_months,
    run_pipeline,
    silver_report,
)
from tripstrata.plans.silver import month_passes
from tripstrata.session import scratch_dir
from tripstrata.sources import in_months, overwrite_months, read_table

SF_DIR = "/root/testdata/sf0.001"


def new_layers(folder):
    run = uuid.uuid4().hex
    return Layers(*(f"{name}_{run}" for name in ("bronze", "silver", "gold")), location=str(folder))


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    layers = new_layers(tmp_path_factory.mktemp("layers"))
    sources = fx.write_raw(spark, SF_DIR, scratch_dir(spark, "raw"))
    counts = run_pipeline(spark, sources, layers, fx.SPECS.values(), drifting=("fhv",))
    return layers, counts


def test_every_distinct_row_is_clean_or_quarantined(spark, refreshed):
    layers, counts = refreshed
    for label in fx.LABELS:
        silver = counts.silver[label]
        assert silver.bronze_rows == counts.bronze[label]
        assert silver.not_kept > 0
        assert silver.bronze_rows - silver.not_kept == silver.clean_rows + silver.quarantined_rows
        assert read_table(spark, layers.quarantine(label)).count() == silver.quarantined_rows
        report = silver_report(spark, layers.clean(label), fx.SPECS[label]).first()
        assert report.total == silver.clean_rows + silver.quarantined_rows


def test_raw_tables_can_be_read_in_small_parts(spark, refreshed):
    """Their rows are sorted by the task that reads them, and a task reads whole row groups."""
    layers, _ = refreshed
    for label in fx.LABELS:
        stored = spark.sql(f"SHOW CREATE TABLE {layers.bronze}.{label}").first()[0]
        assert "'parquet.block.size' = '16777216'" in stored


def test_raw_files_are_written_without_a_shuffle(spark, tmp_path):
    fx.write_raw(spark, SF_DIR, str(tmp_path))
    assert len(list((tmp_path / "yellow").glob("*.parquet"))) == 1


def test_summaries_add_up(spark, refreshed):
    layers, counts = refreshed
    trips = read_table(spark, f"{layers.gold}.trips_unified")
    clean = {label: counts.silver[label].clean_rows for label in fx.LABELS}
    assert counts.gold["trips_unified"] == trips.count() == sum(clean.values())
    assert total_trips(demand_patterns(trips)).first()[0] == trips.count()
    paid = read_table(spark, f"{layers.gold}.revenue_by_zone_hour")
    assert total_trips(paid).first()[0] == sum(clean[x] for x in ("yellow", "green", "fhvhv"))
    stats = read_table(spark, f"{layers.gold}.trip_duration_stats")
    assert {r.trip_type: r.trip_count for r in stats.collect()} == clean
    bounds = stats.agg(F.min("min_duration_min"), F.max("max_duration_min")).first()
    assert bounds[0] >= 1 and bounds[1] <= 180


def test_dashboard(spark, refreshed):
    layers, counts = refreshed
    pages = dashboard(spark, layers.gold, ("yellow", "fhv"), k=3)
    assert pages["total_trips"].first()[0] == counts.gold["trips_unified"]
    assert [r[0] for r in pages["type_options"].collect()] == sorted(fx.LABELS)
    assert pages["demand_by_hour"].columns == ["pickup_hour", "yellow", "fhv"]
    assert pages["top_zones"].count() == 3
    assert pages["duration_summary"].count() == 4
    assert pages["trips_by_type"].count() == 4
    assert {r.trip_type for r in pages["revenue_by_type"].collect()} == {"yellow", "green", "fhvhv"}
    # Every source with fares has its column, whatever types are chosen.
    assert pages["revenue_by_hour"].columns == ["pickup_hour", "fhvhv", "green", "yellow"]
    for name in ("demand_by_hour", "revenue_by_hour"):
        plan = pages[name]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("rangepartitioning") == 1, "only the result is sorted"
    for name in ("trips_by_type", "total_trips", "type_options"):
        plan = pages[name]._jdf.queryExecution().executedPlan().toString()
        assert "trips_unified" not in plan


def test_one_source_and_dropped_nulls(spark, tmp_path):
    rows = [{}, {"VendorID": 2, "passenger_count": None}, {"VendorID": 3, "fare_amount": 1.0}]
    frame(spark, "yellow", rows).write.parquet(f"{tmp_path}/raw")
    layers = new_layers(tmp_path / "layers")
    counts = run_pipeline(
        spark, {"yellow": f"{tmp_path}/raw"}, layers, [YELLOW], null_policy="drop"
    )
    silver = counts.silver["yellow"]
    assert (silver.clean_rows, silver.quarantined_rows, silver.not_kept) == (1, 1, 1)


def test_sources_without_fares_have_no_revenue_table(spark, tmp_path):
    frame(spark, "fhv", [{}]).write.parquet(f"{tmp_path}/raw")
    counts = run_pipeline(spark, {"fhv": f"{tmp_path}/raw"}, new_layers(tmp_path / "layers"))
    assert "revenue_by_zone_hour" not in counts.gold
    assert counts.gold["trips_unified"] == 1


def test_refresh_again_replaces_everything(spark, tmp_path):
    layers = new_layers(tmp_path / "layers")
    for day in (1, 2):
        change = {"tpep_pickup_datetime": START.replace(day=day, month=day)}
        change["tpep_dropoff_datetime"] = change["tpep_pickup_datetime"].replace(hour=14)
        frame(spark, "yellow", [change]).write.parquet(f"{tmp_path}/raw{day}")
        run_pipeline(spark, {"yellow": f"{tmp_path}/raw{day}"}, layers)
        stored = read_table(spark, f"{layers.gold}.trips_unified").collect()
        assert [row.pickup_month for row in stored] == [day]


def test_passes_over_months_give_the_same_tables(spark, refreshed):
    layers, counts = refreshed
    for label, rows in (("yellow", 1), ("fhvhv", 10**9), ("fhv", 2000)):
        spec = fx.SPECS[label]
        names = [f"{layers.silver}.{label}_by_pass", f"{layers.silver}.{label}_by_pass_q"]
        for _ in range(2):
            again = build_silver(spark, f"{layers.bronze}.{label}", spec, *names, rows_per_pass=rows)
            assert again == counts.silver[label]
        for name, whole in zip(names, (layers.clean(label), layers.quarantine(label)), strict=True):
            assert read_table(spark, name).exceptAll(read_table(spark, whole)).isEmpty()


def test_rows_without_pickup_time_are_in_a_pass(spark, tmp_path):
    rows = [{}, {"tpep_pickup_datetime": None}, {"tpep_pickup_datetime": None},
            {"tpep_pickup_datetime": START.replace(month=7)}]
    frame(spark, "yellow", rows).write.parquet(f"{tmp_path}/raw")
    layers = new_layers(tmp_path / "layers")
    layers.create(spark)
    bronze = f"{layers.bronze}.yellow"
    load_bronze(spark, f"{tmp_path}/raw", YELLOW, bronze)
    names = layers.clean("yellow"), layers.quarantine("yellow")
    counts = build_silver(spark, bronze, YELLOW, *names, rows_per_pass=1)
    assert (counts.clean_rows, counts.quarantined_rows, counts.not_kept) == (1, 2, 1)


def test_month_passes():
    months = [(None, None, 5), (2025, 1, 50), (2025, 2, 40), (2025, 3, 200), (2025, 4, 1)]
    assert month_passes(months, 100) == [
        [(None, None), (2025, 1), (2025, 2)], [(2025, 3)], [(2025, 4)],
    ]
    assert month_passes([], 100) == [[]]


def test_a_pass_reads_only_its_partitions(spark, refreshed):
    layers, _ = refreshed
    bronze = read_table(spark, f"{layers.bronze}.yellow")
    plan = bronze.where(in_months([(2023, 6)]))._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("Filters", "") and "PartitionFilters: [(pickup" in plan


def test_months_are_refreshed_alone(spark, tmp_path):
    may, june = START.replace(month=5), START.replace(month=6)

    def raw(times):
        changes = [
            {"tpep_pickup_datetime": t, "tpep_dropoff_datetime": t.replace(hour=14), "VendorID": k}
            for k, t in enumerate(times)
        ]
        return frame(spark, "yellow", changes)

    raw([may, may, june]).write.parquet(f"{tmp_path}/raw")
    layers = new_layers(tmp_path / "layers")
    counts = run_pipeline(spark, {"yellow": f"{tmp_path}/raw"}, layers, [YELLOW])
    assert counts.skipped == {} and "VendorID" in counts.keys["yellow"]
    table = f"{layers.bronze}.yellow"
    raw([june, june, june, june]).write.parquet(f"{tmp_path}/again")
    again = bronze_frame(spark.read.parquet(f"{tmp_path}/again"), YELLOW)
    overwrite_months(again, table, [(june.year, 6)])
    refresh_months(spark, layers, [(june.year, 6)], [YELLOW])
    gold = read_table(spark, f"{layers.gold}.trips_unified")
    assert sorted(r.pickup_month for r in gold.collect()) == [5, 5, 6, 6, 6, 6]
    assert read_table(spark, f"{layers.gold}.trip_duration_stats").first().trip_count == 6


def test_a_source_left_out_is_reported(spark, tmp_path):
    frame(spark, "yellow", [{}]).write.parquet(f"{tmp_path}/yellow")
    frame(spark, "fhv", [{}]).drop("dropOff_datetime").write.parquet(f"{tmp_path}/fhv")
    layers = new_layers(tmp_path / "layers")
    sources = {"yellow": f"{tmp_path}/yellow", "fhv": f"{tmp_path}/fhv"}
    counts = run_pipeline(spark, sources, layers)
    assert counts.skipped == {"fhv": ["dropoff_datetime"]}
    assert counts.gold["trips_unified"] == 1


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="no spec"):
        run_pipeline(spark, {"boats": "/none"})


def test_a_month_without_rows_is_refreshed_in_a_session_of_defaults(spark, refreshed):
    layers, counts = refreshed
    tasks = "spark.sql.shuffle.partitions"
    before = spark.conf.get(tasks)
    spark.conf.unset(tasks)
    try:
        refresh_months(spark, layers, [(1995, 3)], fx.SPECS.values())
    finally:
        spark.conf.set(tasks, before)
    assert read_table(spark, f"{layers.gold}.trips_unified").count() == counts.gold["trips_unified"]
