from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.rows import SCHEMAS, START, frame
from tripstrata import ALL, FHV, GREEN, YELLOW, ColumnMatch
from tripstrata.functions.columns import available_keys, find_column, require_column
from tripstrata.plans import bronze_frame, load_bronze
from tripstrata.session import recommended_conf, scratch_dir
from tripstrata.sources import (
    new_files,
    overwrite_months,
    read_dataset,
    read_drifting,
    read_new_files,
    read_table,
    source_files,
    with_source_file,
)
from tripstrata.streaming import load_arrivals


@pytest.fixture
def folder(tmp_path):
    return f"{tmp_path}/with space"


def test_declared_schemas(spark):
    sizes = {"yellow": 20, "green": 21, "fhvhv": 25}
    for spec in ALL:
        if spec.schema is None:
            assert spec.label == "fhv"
            continue
        fields = T.StructType.fromDDL(spec.schema).fields
        assert len(fields) == sizes[spec.label]
        assert {f.dataType.typeName() for f in fields if f.name.endswith("datetime")} == {
            "timestamp_ntz"
        }


def test_find_column():
    names = ["Trip_Pickup_DateTime", "pickup_datetime", "dropOff_datetime", "PUlocationID"]
    assert find_column(names, all_of=("pickup", "datetime")) == "Trip_Pickup_DateTime"
    assert find_column(names, all_of=("dropoff", "datetime")) == "dropOff_datetime"
    assert find_column(names, equals_ci="pulocationid") == "PUlocationID"
    assert find_column(names, equals_ci="location") is None
    assert available_keys(names, ["PULocationID", "pulocationid", "none"]) == ["PUlocationID"]
    with pytest.raises(ValueError):
        find_column(names)
    with pytest.raises(ValueError):
        ColumnMatch()


def test_missing_required_column_lists_columns(spark):
    bare = frame(spark, "fhv", [{}]).drop("pickup_datetime")
    with pytest.raises(ValueError, match="dropOff_datetime"):
        bronze_frame(bare, FHV)
    with pytest.raises(ValueError, match="no zone"):
        require_column(bare, ColumnMatch(equals_ci="zone"), "zone")


def test_declared_schema_fills_missing_columns_and_ignores_case(spark, folder):
    rows = frame(spark, "yellow", [{"Airport_fee": 1.25}]).drop("cbd_congestion_fee")
    rows.withColumnRenamed("Airport_fee", "airport_fee").write.parquet(folder)
    row = read_dataset(spark, folder, YELLOW).first()
    assert (row.Airport_fee, row.cbd_congestion_fee) == (1.25, None)
    assert read_dataset(spark, folder, YELLOW).columns == T.StructType.fromDDL(
        SCHEMAS["yellow"]
    ).names


def test_merged_spellings_are_one_column(spark, folder):
    rows = frame(spark, "fhv", [{"PUlocationID": 7}])
    rows.write.parquet(f"{folder}/1")
    rows.withColumnRenamed("PUlocationID", "PULocationID").write.parquet(f"{folder}/2")
    merged = read_dataset(spark, [f"{folder}/1", f"{folder}/2"])
    name = find_column(merged, equals_ci="pulocationid")
    assert [row[0] for row in merged.select(name).collect()] == [7, 7]


@pytest.mark.parametrize("types", [("bigint", "double"), ("int", "bigint"), ("int", "bigint", "double")])
@pytest.mark.parametrize("declared", ["bigint", "double", None])
def test_drifting_types(spark, folder, types, declared):
    units = [f"{folder}/{kind}" for kind in types]
    for kind, unit in zip(types, units, strict=True):
        spark.range(1, 3).select(F.col("id").cast(kind).alias("passenger_count")).write.parquet(unit)
    schema = f"passenger_count {declared}, extra string" if declared else None
    stacked = read_drifting(spark, units, schema)
    wanted = declared or types[-1]
    assert dict(stacked.dtypes)["passenger_count"] == wanted
    assert stacked.groupBy().sum("passenger_count").first()[0] == 3 * len(types)
    assert stacked.select("_source_file").distinct().count() >= len(types)
    if declared:
        assert stacked.where("extra is not null").isEmpty()


def test_drifting_nan_becomes_null(spark, folder):
    spark.sql("SELECT CAST('NaN' AS DOUBLE) AS n").write.parquet(f"{folder}/1")
    spark.sql("SELECT 4L AS n").write.parquet(f"{folder}/2")
    stacked = read_drifting(spark, [f"{folder}/1", f"{folder}/2"], "n bigint")
    assert sorted((row.n for row in stacked.collect()), key=str) == [4, None]


def test_a_folder_of_mixed_files(spark, folder):
    for kind in ("int", "double", "bigint", "int"):
        spark.range(3).select(F.col("id").cast(kind).alias("n")).write.mode("append").parquet(f"{folder}/m")
    for schema in (None, "n bigint"):
        assert sorted(int(r.n) for r in read_drifting(spark, [f"{folder}/m"], schema).collect()) == sorted(
            [0, 1, 2] * 4
        )


def test_a_fraction_is_not_cut_off(spark, folder):
    spark.sql("SELECT 1.5D AS n").write.parquet(f"{folder}/1")
    spark.sql("SELECT 2L AS n").write.parquet(f"{folder}/2")
    with pytest.raises(Exception, match="not an integer: 1.5"):
        read_drifting(spark, [f"{folder}/1", f"{folder}/2"], "n bigint").collect()


def test_drifting_text_and_number_need_a_schema(spark, folder):
    spark.sql("SELECT 'a' AS n").write.parquet(f"{folder}/1")
    spark.sql("SELECT 4L AS n").write.parquet(f"{folder}/2")
    units = [f"{folder}/1", f"{folder}/2"]
    with pytest.raises(ValueError, match="declare a schema"):
        read_drifting(spark, units)
    assert sorted(row.n for row in read_drifting(spark, units, "n string").collect()) == ["4", "a"]


def test_plain_read_of_conflicting_types_fails(spark, folder):
    spark.sql("SELECT 1L AS n").write.parquet(f"{folder}/1")
    spark.sql("SELECT 1.0D AS n").write.parquet(f"{folder}/2")
    with pytest.raises(Exception):  # noqa: B017
        read_dataset(spark, [f"{folder}/1", f"{folder}/2"], "n bigint").collect()


def test_missing_path_is_not_taken_for_drift(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_drifting(spark, [f"{folder}/none"], "n bigint")


def test_bronze_columns(spark, folder, database):
    frame(spark, "green", [{}, {"lpep_pickup_datetime": datetime(2026, 1, 31, 23, 59)}]).write.parquet(
        folder
    )
    table = f"{database}.green"
    assert load_bronze(spark, folder, GREEN, table) == 2
    stored = read_table(spark, table)
    assert sorted((r.pickup_year, r.pickup_month) for r in stored.collect()) == [(2025, 5), (2026, 1)]
    assert stored.select("_ingest_timestamp").distinct().count() == 1
    assert stored.where(F.col("_source_file").contains("part-")).count() == 2
    partitions = [row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    assert sorted(partitions) == [
        "pickup_year=2025/pickup_month=5", "pickup_year=2026/pickup_month=1",
    ]


def test_new_files(spark, folder):
    for part in ("a", "b"):
        spark.range(2).select(F.lit(part).alias("p")).coalesce(1).write.parquet(f"{folder}/{part}")
    loaded = with_source_file(read_dataset(spark, f"{folder}/a", "p string"))
    assert source_files(spark, folder).count() == 2
    assert [row[0].count("/b/") for row in new_files(spark, folder, loaded).collect()] == [1]
    fresh = read_new_files(spark, folder, loaded, "p string")
    assert {row.p for row in fresh.collect()} == {"b"}
    nothing = read_new_files(spark, folder, loaded.unionByName(fresh), "p string")
    assert nothing.isEmpty() and nothing.columns == fresh.columns
    assert read_new_files(spark, folder, loaded.unionByName(fresh)).columns == fresh.columns


def test_arrivals_are_loaded_once(spark, folder, database):
    table, state = f"{database}.yellow", f"{folder}/state"
    for day in (1, 2):
        change = {"tpep_pickup_datetime": START.replace(day=day)}
        frame(spark, "yellow", [change] * 3).write.mode("append").parquet(f"{folder}/in")
        load_arrivals(spark, f"{folder}/in", YELLOW, table, state, files_per_batch=2)
        assert read_table(spark, table).count() == 3 * day
    load_arrivals(spark, f"{folder}/in", YELLOW, table, state)
    assert read_table(spark, table).count() == 6


def test_streamed_and_other_tables_are_kept_apart(spark, folder, database):
    table, state = f"{database}.yellow", f"{folder}/state"
    frame(spark, "yellow", [{}]).write.parquet(f"{folder}/in")
    load_bronze(spark, f"{folder}/in", YELLOW, table)
    with pytest.raises(ValueError, match="written otherwise"):
        load_arrivals(spark, f"{folder}/in", YELLOW, table, state)
    own = f"{database}.own"
    load_arrivals(spark, f"{folder}/in", YELLOW, own, state)
    partitions = spark.sql(f"SHOW CREATE TABLE {own}").first()[0]
    assert "PARTITIONED BY (pickup_year, pickup_month)" in partitions
    with pytest.raises(ValueError, match="stream"):
        overwrite_months(read_table(spark, table), own, [(2025, 5)])
    assert read_table(spark, own).count() == read_table(spark, table).count() == 1


def test_scratch_dir(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert first.startswith(base)


def test_recommended_conf_sizes_partitions_by_months(spark):
    conf = recommended_conf(pass_gb=8000, months_per_pass=12, target_file_mb=128)
    assert conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "1536m"
    assert conf["spark.sql.shuffle.partitions"] == "16000"
    assert recommended_conf(1)["spark.sql.shuffle.partitions"] == "200"
    assert all(spark.conf.isModifiable(key) for key in conf)
