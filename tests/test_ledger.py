"""Files loaded once, whatever their names, types and interruptions; footers read in tasks."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.rows import START, frame
from tripstrata import FHV, GREEN, YELLOW
from tripstrata.plans import Layers, pipeline, refresh_new_files
from tripstrata.sources import (
    ensure_ledger,
    footers,
    ledger,
    listed_files,
    load_new_files,
    pending_files,
    read_drifting,
    read_files,
    read_new_files,
    read_table,
)
from tripstrata.sources.ledger import widened
from tripstrata.sources.scan import literal_path, with_source_file

NAMES = ["plain", "with blank", "with [ab]", "with %20", "with {x,y} * ?", "ümlaut"]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "raw")


def one_file(spark, folder, name, df):
    """One parquet file of the given name."""
    import glob
    import os

    stage = f"/{folder.strip('/')}_stage_{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(stage)
    os.makedirs(folder, exist_ok=True)
    (part,) = glob.glob(f"{glob.escape(stage)}/part-*.parquet")
    os.replace(part, f"{folder}/{name}.parquet")
    return f"{folder}/{name}.parquet"


def numbered(spark, k, kind="bigint"):
    return spark.range(k, k + 3).select(F.col("id").cast(kind).alias("n"))


def ids(df):
    return sorted(int(r.n) for r in df.collect())


def test_footers_in_one_job(spark, folder):
    for k, name in enumerate(NAMES):
        one_file(spark, folder, name, numbered(spark, 10 * k, ("int", "double", "bigint")[k % 3]))
    found = footers(listed_files(spark, folder), files_per_task=2).collect()
    assert len(found) == len(NAMES) and all(r.row_count == 3 and r.size > 0 for r in found)
    assert len({r.schema for r in found}) == 3
    wanted = sorted(10 * k + j for k in range(len(NAMES)) for j in range(3))
    assert ids(read_drifting(spark, [folder], "n bigint")) == wanted
    assert ids(read_drifting(spark, [folder])) == wanted


def test_footers_of_files_that_spark_did_not_write(spark, folder):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(folder)
    at = pa.array([START], pa.timestamp("us"))
    pq.write_table(pa.table({"n": pa.array([1], pa.int32()), "at": at, "s": ["x"]}), f"{folder}/a.parquet")
    row = footers(listed_files(spark, folder)).first()
    from pyspark.sql.types import StructType
    import json

    assert StructType.fromJson(json.loads(row.schema)).simpleString() == "struct<n:int,at:timestamp_ntz,s:string>"


def test_many_drifting_files_take_a_bounded_number_of_jobs(spark, folder):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(folder)
    for k in range(400):
        kind = (pa.int32(), pa.float64(), pa.int64())[k % 3]
        pq.write_table(pa.table({"n": pa.array([k], kind)}), f"{folder}/{k}.parquet")
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "drift")
    try:
        stacked = read_drifting(spark, [folder], "n bigint")
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert ids(stacked) == list(range(400))
    assert jobs < 40


def test_names_are_taken_literally(spark, folder):
    for k, name in enumerate(NAMES):
        one_file(spark, folder, name, numbered(spark, 10 * k))
    loaded = with_source_file(spark.read.parquet(literal_path(f"{folder}/{NAMES[0]}.parquet")))
    fresh = read_new_files(spark, folder, loaded, "n bigint")
    assert ids(fresh) == sorted(10 * k + j for k in range(1, len(NAMES)) for j in range(3))


def spec_of_numbers():
    return FHV.with_(label="numbers", schema=None)


def test_only_listed_files_are_opened(spark, folder):
    import os

    for k, name in enumerate(NAMES):
        path = one_file(spark, folder, name, numbered(spark, 10 * k))
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    listed = listed_files(spark, folder)
    after = listed.where(F.unix_seconds("modified") >= 1_700_000_003)
    for name in NAMES[:3]:
        with open(f"{folder}/{name}.parquet", "wb"):
            pass
        os.utime(f"{folder}/{name}.parquet", (1_700_000_000, 1_700_000_000))
    found = read_files(spark, folder, after, spark.range(0).withColumnRenamed("id", "n").schema)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert ids(found) == sorted(10 * k + j for k in range(3, 6) for j in range(3))
    # Every second file: the others lie between them in time, so names decide.
    for k, name in enumerate(NAMES):
        path = one_file(spark, folder, name, numbered(spark, 10 * k))
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    second = listed_files(spark, folder).where(F.unix_seconds("modified") % 2 == 0)
    found = read_files(spark, folder, second, spark.range(0).withColumnRenamed("id", "n").schema)
    assert ids(found) == sorted(10 * k + j for k in (0, 2, 4) for j in range(3))
    none = read_files(spark, folder, second.limit(0), spark.range(0).withColumnRenamed("id", "n").schema)
    assert ids(none) == []


@pytest.fixture
def loading(spark, folder, database):
    table, log = f"{database}.trips", f"{database}.loads"

    def load(spec=YELLOW):
        return load_new_files(spark, folder, spec, table, log)

    return load, table, log


def day(spark, k, n=3):
    return frame(spark, "yellow", [{"tpep_pickup_datetime": START.replace(day=k), "VendorID": j} for j in range(n)])


def test_files_are_loaded_once(spark, folder, loading):
    load, table, log = loading
    for k, name in enumerate(NAMES, start=1):
        one_file(spark, folder, name, day(spark, k))
        assert load() == 3
        assert load() == 0
    assert read_table(spark, table).count() == 3 * len(NAMES)
    assert pending_files(spark, folder, log).isEmpty()
    states = {(r.state, r.row_count) for r in read_table(spark, log).collect()}
    assert states == {("started", 3), ("loaded", 3)}
    assert pending_files(spark, folder, log).columns == ["_source_file", "size", "modified", "again"]
    plan = pending_files(spark, folder, log)._jdf.queryExecution().executedPlan().toString()
    assert "trips" not in plan


def test_a_changed_file_replaces_its_rows(spark, folder, loading):
    load, table, _ = loading
    one_file(spark, folder, "a", day(spark, 1))
    one_file(spark, folder, "b", day(spark, 2))
    assert load() == 6
    one_file(spark, folder, "a", day(spark, 9, 5))
    one_file(spark, folder, "c", day(spark, 3, 1))
    assert load() == 6
    found = read_table(spark, table).groupBy(F.dayofmonth("tpep_pickup_datetime").alias("d")).count()
    assert sorted(map(tuple, found.collect())) == [(2, 3), (3, 1), (9, 5)]


@pytest.mark.parametrize("broken", ["_prepare", "_log"])
def test_a_load_that_broke_off_adds_no_row_twice(spark, folder, loading, monkeypatch, broken):
    load, table, _ = loading
    one_file(spark, folder, "a", day(spark, 1))
    load()
    one_file(spark, folder, "b", day(spark, 2))
    whole = getattr(ledger, broken)

    def fails(*args):
        if broken == "_log" and args[2] == ledger.STARTED:
            return whole(*args)
        raise RuntimeError("stopped here")

    monkeypatch.setattr(ledger, broken, fails)
    with pytest.raises(RuntimeError):
        load()
    assert read_table(spark, table).count() == (6 if broken == "_log" else 3)
    monkeypatch.setattr(ledger, broken, whole)
    assert load() == 3 and load() == 0
    assert read_table(spark, table).count() == 6


def test_columns_and_types_of_later_files(spark, folder, loading):
    load, table, _ = loading
    spec = FHV.with_(schema=None)

    def arrival(name, columns):
        head = "'B1' AS dispatching_base_num, timestamp_ntz'2025-05-03 10:00:00' AS pickup_datetime, "
        one_file(spark, folder, name, spark.sql(f"SELECT {head}{columns}"))
        return load(spec)

    assert arrival("a", "CAST(7 AS INT) AS PUlocationID, CAST(1 AS FLOAT) AS miles") == 1
    assert arrival("b", "CAST(3000000000 AS BIGINT) AS PULocationID, 2.5D AS miles, 'new' AS note") == 1
    assert arrival("c", "CAST(9 AS DOUBLE) AS PUlocationID, CAST('NaN' AS DOUBLE) AS miles") == 1
    assert arrival("d", "CAST('NaN' AS DOUBLE) AS PUlocationID, CAST(4 AS INT) AS miles") == 1
    df = read_table(spark, table)
    kinds = dict(df.dtypes)
    assert (kinds["PUlocationID"], kinds["miles"], kinds["note"]) == ("bigint", "double", "string")
    found = df.select("PUlocationID", F.nanvl("miles", F.lit(-1.0)).alias("miles"), "note").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(7, 1.0, None), (3000000000, 2.5, "new"), (9, -1.0, None), (None, 4.0, None)], key=str
    )
    with pytest.raises(Exception, match="not an integer"):
        arrival("e", "CAST(1.5 AS DOUBLE) AS PUlocationID")
    assert read_table(spark, table).count() == 4


def test_types_that_do_not_fit():
    from pyspark.sql import types as T

    assert widened(T.IntegerType(), T.LongType(), "x") == T.LongType()
    assert widened(T.LongType(), T.DoubleType(), "x") == T.LongType()
    assert widened(T.FloatType(), T.DoubleType(), "x") == T.DoubleType()
    assert widened(T.DoubleType(), T.IntegerType(), "x") == T.DoubleType()
    assert widened(T.NullType(), T.StringType(), "x") == T.StringType()
    with pytest.raises(ValueError, match="column x is"):
        widened(T.StringType(), T.LongType(), "x")


def test_an_empty_ledger(spark, folder, database):
    one_file(spark, folder, "a", numbered(spark, 1))
    ensure_ledger(spark, f"{database}.loads")
    ensure_ledger(spark, f"{database}.loads")
    assert [r.again for r in pending_files(spark, folder, f"{database}.loads").collect()] == [False]


def test_a_refresh_that_broke_off_is_caught_up(spark, folder, tmp_path, monkeypatch):
    run = uuid.uuid4().hex
    layers = Layers(*(f"{x}_{run}" for x in ("bronze", "silver", "gold")), location=str(tmp_path / "layers"))
    sources = {"yellow": folder}

    def trips():
        df = read_table(spark, f"{layers.gold}.demand_patterns")
        return sum(r.trip_count for r in df.collect())

    def month(name, m, n):
        changes = [
            {"tpep_pickup_datetime": START.replace(month=m), "tpep_dropoff_datetime": START.replace(month=m, hour=14), "VendorID": j}
            for j in range(n)
        ]
        one_file(spark, folder, name, frame(spark, "yellow", changes))

    month("a", 5, 3)
    assert refresh_new_files(spark, sources, layers, [YELLOW]) == {"yellow": [(START.year, 5)]}
    assert trips() == 3
    month("b", 6, 2)
    monkeypatch.setattr(pipeline, "refresh_months", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh_new_files(spark, sources, layers, [YELLOW])
    assert trips() == 3
    monkeypatch.undo()
    assert refresh_new_files(spark, sources, layers, [YELLOW]) == {"yellow": []}
    assert trips() == 5
    month("a", 7, 4)
    assert refresh_new_files(spark, sources, layers, [YELLOW]) == {"yellow": [(START.year, 5), (START.year, 7)]}
    assert trips() == 6


def test_a_source_without_rows_arrives_in_a_session_of_defaults(spark, tmp_path):
    run = uuid.uuid4().hex
    layers = Layers(*(f"{x}_{run}" for x in ("bronze", "silver", "gold")), location=str(tmp_path / "layers"))
    sources = {"yellow": f"{tmp_path}/yellow", "green": f"{tmp_path}/green"}
    frame(spark, "yellow", [{}]).write.parquet(sources["yellow"])
    frame(spark, "green", [{}]).limit(0).write.parquet(sources["green"])
    tasks = "spark.sql.shuffle.partitions"
    before = spark.conf.get(tasks)
    spark.conf.unset(tasks)
    try:
        months = refresh_new_files(spark, sources, layers, [YELLOW, GREEN])
    finally:
        spark.conf.set(tasks, before)
    assert months == {"yellow": [(START.year, 5)], "green": []}
    assert read_table(spark, f"{layers.gold}.trips_unified").count() == 1
