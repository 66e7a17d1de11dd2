from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.rows import frame
from tripstrata import FHV, YELLOW
from tripstrata.operators import dedup_first, dedup_report
from tripstrata.plans import dedup_keys

LOADED = "_ingest_timestamp timestamp_ntz, _source_file string"
EARLY, LATE = datetime(2025, 6, 1), datetime(2025, 7, 1)


def test_earliest_load_wins(spark):
    rows = frame(
        spark,
        "yellow",
        [
            {"_ingest_timestamp": LATE, "total_amount": 1.0, "_source_file": "a"},
            {"_ingest_timestamp": EARLY, "total_amount": 9.0, "_source_file": "b"},
            {"_ingest_timestamp": LATE, "VendorID": 2, "_source_file": "a"},
        ],
        LOADED,
    )
    kept = dedup_first(rows, dedup_keys(rows, YELLOW))
    assert sorted((r.VendorID, r.total_amount) for r in kept.collect()) == [(1, 9.0), (2, 25.0)]
    assert kept.columns == rows.columns


def test_file_then_columns_settle_equal_load_times(spark):
    rows = frame(
        spark,
        "yellow",
        [
            {"_ingest_timestamp": EARLY, "_source_file": "b", "total_amount": 1.0},
            {"_ingest_timestamp": EARLY, "_source_file": "a", "total_amount": 8.0},
            {"_ingest_timestamp": EARLY, "_source_file": "a", "total_amount": 7.0},
        ],
        LOADED,
    )
    assert dedup_first(rows, dedup_keys(rows, YELLOW)).first().total_amount == 7.0


def test_survivor_does_not_depend_on_layout(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").withColumn(
        "_ingest_timestamp", F.lit(EARLY)
    )
    results = []
    for layout in (lines, lines.repartition(5), lines.repartition(13, "l_tax"), lines.coalesce(1)):
        kept = dedup_first(layout, ["l_orderkey", "l_linenumber"])
        assert kept.count() == 4599
        results.append(kept.agg(F.sum(F.xxhash64(*lines.columns) % 1000003)).first()[0])
    assert len(set(results)) == 1


def test_idempotent(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    once = dedup_first(lines, keys)
    assert dedup_first(once, keys).exceptAll(once).isEmpty()


def test_null_keys(spark):
    nothing = dict.fromkeys(
        ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID",
         "DOLocationID"]
    )
    half = {**nothing, "VendorID": 3}
    rows = frame(spark, "yellow", [nothing, nothing, half, half, {}])
    keys = dedup_keys(rows, YELLOW)
    assert dedup_first(rows, keys).count() == 3
    assert dedup_first(rows, keys, keep_null_keys=True).count() == 4
    report = dedup_report(rows, keys).first()
    assert (report.rows_before, report.rows_after, report.duplicates_removed) == (5, 3, 2)


def test_report_of_nothing(spark):
    assert tuple(dedup_report(spark.range(0), ["id"]).first()) == (0, 0, 0)


def test_keys_follow_the_columns_that_exist(spark):
    rows = frame(spark, "fhv", [{}])
    assert dedup_keys(rows, FHV) == [
        "pickup_datetime", "dropOff_datetime", "PUlocationID", "DOlocationID",
        "dispatching_base_num",
    ]
    bare = rows.drop("dropOff_datetime", "dispatching_base_num")
    assert dedup_keys(bare, FHV) == ["pickup_datetime", "PUlocationID", "DOlocationID"]


def test_identical_rows_without_other_columns(spark):
    rows = frame(spark, "fhv", [{}, {}])
    assert dedup_first(rows, rows.columns).count() == 1


def test_unorderable_columns_need_a_named_tiebreak(spark):
    rows = spark.range(3).withColumn("m", F.create_map(F.lit("a"), F.col("id")))
    with pytest.raises(ValueError, match="no order"):
        dedup_first(rows, ["id"])
    assert dedup_first(rows, ["id"], tiebreak=["id"]).count() == 3


def test_keys_are_required(spark):
    for operator in (dedup_first, dedup_report):
        with pytest.raises(ValueError, match="key"):
            operator(spark.range(3), [])


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """One key holds almost all rows; each map task sends one row of it."""
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 100 == 0, F.col("id")).otherwise(-1).alias("k"), "id"
    )
    kept = dedup_first(rows, ["k"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1
    before_shuffle = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert kept.count() == 2001


def test_a_missing_key_is_an_error_unless_the_source_may_lack_it(spark):
    rows = frame(spark, "yellow", [{}]).drop("VendorID")
    with pytest.raises(ValueError, match="VendorID"):
        dedup_keys(rows, YELLOW)
    assert "VendorID" not in dedup_keys(rows, YELLOW.with_(may_lack_columns=True))
