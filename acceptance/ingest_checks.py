"""Scans, sources, sinks and the audit of what has been loaded."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from acceptance import fixtures as fx
from acceptance.registry import check
from tripstrata import FHV
from tripstrata.functions.columns import available_keys, find_column, require_column
from tripstrata.operators import (
    latest_month,
    missing_partitions,
    monthly_counts,
    narrow,
    profile,
    unify_trips,
)
from tripstrata.plans.bronze import MONTH_COLUMNS, bronze_frame
from tripstrata.session import scratch_dir
from tripstrata.sources import (
    ensure_layers,
    in_months,
    overwrite_months,
    load_new_files,
    read_dataset,
    read_drifting,
    read_new_files,
    read_table,
    run_query,
    with_ingest_metadata,
    with_partition_columns,
    with_source_file,
    write_table,
)
from tripstrata.spec import ColumnMatch, named
from tripstrata.streaming import load_arrivals

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _database(spark) -> str:
    """A database of its own in the scratch folder, so that runs do not meet."""
    name = f"check_{uuid.uuid4().hex}"
    ensure_layers(spark, {name: "it's a check"}, scratch_dir(spark, "tables"))
    return name


@check("SELECT event_id, user_id, ts, event_type, value, props FROM events")
def scan_explicit_schema(spark, sf_dir):
    schema = "event_id bigint, USER_ID bigint, ts timestamp_ntz, event_type string, value double"
    schema += ", props string"
    return read_dataset(spark, f"{sf_dir}/events.parquet", schema).withColumnRenamed(
        "USER_ID", "user_id"
    )


@check("""
    SELECT event_id, ts, event_type, user_id, props,
      CASE WHEN event_type IN ('click', 'view') THEN value END AS value
    FROM events
""")
def scan_merge_schema(spark, sf_dir):
    folder = scratch_dir(spark, "merge")
    columns = ["event_id", "ts", "event_type", "user_id", "props", "value"]
    events = fx.table(spark, sf_dir, "events").select(*columns)
    wide = F.col("event_type").isin("click", "view")
    events.where(wide).write.parquet(f"{folder}/1")
    events.where(~wide).drop("value").write.parquet(f"{folder}/2")
    merged = read_dataset(spark, [f"{folder}/1", f"{folder}/2"])
    return merged.select(*columns)


@check("SELECT l_orderkey, l_linenumber, l_quantity, 'lineitem' AS source FROM lineitem")
def drifting_types(spark, sf_dir):
    """The same columns as bigint, double and int, in files of one folder, read as one."""
    folder = scratch_dir(spark, "drift")
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    for flag, wanted in (("A", "bigint"), ("N", "double"), ("R", "int")):
        part = fx.table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag)
        part.select(
            F.col("l_orderkey").cast(wanted), F.col("l_linenumber").cast(wanted), "l_quantity"
        ).write.mode("append").parquet(folder)
    return read_drifting(spark, [folder], lines.schema).select(
        "l_orderkey", "l_linenumber", "l_quantity", F.lit("lineitem").alias("source")
    )


@check("""
    SELECT 'orders' AS trip_type, o_orderdate AS pickup_datetime,
      CAST(o_custkey AS INTEGER) AS "PULocationID"
    FROM orders
""")
def find_columns_narrow(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    mapping = {
        "pickup_datetime": require_column(orders, ColumnMatch(all_of=("Order", "Date")), "date"),
        "PULocationID": find_column(orders, equals_ci="O_CUSTKEY"),
    }
    return narrow(orders, "orders", mapping, {"PULocationID": "int"})


@check("SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY ALL")
def available_key_subset(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    keys = available_keys(orders, ["O_CUSTKEY", "o_vendor", "o_orderdate", "o_custkey"])
    return orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@check("""
    SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS pickup_year,
      CAST(month(l_shipdate) AS INTEGER) AS pickup_month, 'lineitem.parquet' AS file_name,
      true AS has_load_time
    FROM lineitem
""")
def ingest_metadata(spark, sf_dir):
    lines = read_dataset(spark, f"{sf_dir}/lineitem.parquet")
    loaded = with_ingest_metadata(with_partition_columns(lines, "l_shipdate"))
    return loaded.select(
        "l_orderkey",
        "l_linenumber",
        *MONTH_COLUMNS,
        F.regexp_extract("_source_file", r"/(lineitem\.parquet)(/[^/]+)?$", 1).alias("file_name"),
        F.col("_ingest_timestamp").isNotNull().alias("has_load_time"),
    )


@check(f"""
    SELECT {ORDERS}, CAST(year(o_orderdate) AS INTEGER) AS pickup_year,
      CAST(month(o_orderdate) AS INTEGER) AS pickup_month
    FROM orders
""")
def partitioned_roundtrip(spark, sf_dir):
    """Written twice with different schemas: the second write replaces the first."""
    table = f"{_database(spark)}.orders"
    dated = with_partition_columns(fx.table(spark, sf_dir, "orders"), "o_orderdate")
    write_table(dated.withColumn("extra", F.lit(1)), table, partition_by=MONTH_COLUMNS)
    write_table(dated, table, partition_by=MONTH_COLUMNS, layout="rebalance")
    return read_table(spark, table)


@check(f"SELECT {ORDERS} FROM orders")
def plain_roundtrip(spark, sf_dir):
    table = f"{_database(spark)}.orders"
    write_table(fx.table(spark, sf_dir, "orders"), table)
    return read_table(spark, table)


@check("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS pickup_year,
      CAST(month(o_orderdate) AS INTEGER) AS pickup_month,
      CASE WHEN year(o_orderdate) = 1997 THEN 'second' ELSE 'first' END AS load
    FROM orders
""")
def overwrite_some_months(spark, sf_dir):
    table = f"{_database(spark)}.orders"
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    dated = with_partition_columns(orders, "o_orderdate").drop("o_orderdate")
    write_table(dated.withColumn("load", F.lit("first")), table, partition_by=MONTH_COLUMNS)
    # The second load holds rows of other months too, as monthly files do.
    again = dated.where("pickup_year = 1997 OR o_orderkey % 7 = 0").withColumn("load", F.lit("second"))
    months = [(1997, month) for month in range(1, 13)]
    overwrite_months(again.where(in_months(months)), table, months)
    return read_table(spark, table)


@check("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def new_files_only(spark, sf_dir):
    folder = scratch_dir(spark, "new files")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        orders.where(F.col("o_orderstatus") == status).write.parquet(f"{folder}/{status}")
    loaded = with_source_file(read_dataset(spark, f"{folder}/F", orders.schema))
    return read_new_files(spark, folder, loaded, orders.schema).drop("_source_file")


@check("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def drifting_many_files(spark, sf_dir):
    """A folder of 210 files in three types of one column; all footers are read in one job."""
    folder = scratch_dir(spark, "drift")
    lines = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    for k, kind in enumerate(("int", "double", "bigint")):
        part = lines.where(F.pmod(F.col("l_orderkey"), F.lit(3)) == k).repartition(70)
        part.withColumn("l_partkey", F.col("l_partkey").cast(kind)).write.mode("append").parquet(folder)
    return read_drifting(spark, [folder], lines.schema).drop("_source_file")


@check("SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")
def load_by_ledger(spark, sf_dir):
    """A load for each arrival, in folders whose names look like patterns; a further load finds nothing."""
    folder, database = scratch_dir(spark, "by ledger"), _database(spark)
    table, log = f"{database}.orders", f"{database}.loads"
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    spec = FHV.with_(schema=None, pickup=named("o_orderdate"))
    for status, name in (("F", "a [1]"), ("O", "100% {b,c}"), ("P", "d*?")):
        arrived = orders.where(F.col("o_orderstatus") == status)
        arrived.write.parquet(f"{folder}/{name}")
        if load_new_files(spark, folder, spec, table, log) != arrived.count():
            raise ValueError("a load must bring the rows of the new files")
    if load_new_files(spark, folder, spec, table, log):
        raise ValueError("files were loaded again")
    return read_table(spark, table).select(*orders.columns)


@check("""
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority,
      o_orderdate FROM orders
""")
def load_evolving_files(spark, sf_dir):
    """Arrivals with a wider type, a further column and whole numbers as ``double``, the last one loaded
    again after its load broke off."""
    folder, database = scratch_dir(spark, "evolving"), _database(spark)
    table, log = f"{database}.orders", f"{database}.loads"
    orders = fx.table(spark, sf_dir, "orders")
    spec = FHV.with_(schema=None, pickup=named("o_orderdate"))
    arrivals = (("F", "int", ()), ("O", "bigint", ("o_orderpriority",)), ("P", "double", ()))
    for status, kind, extra in arrivals:
        arrived = orders.where(F.col("o_orderstatus") == status)
        keys = [F.col(name).cast(kind).alias(name) for name in ("o_orderkey", "o_custkey")]
        arrived.select(*keys, *extra, "o_orderdate").write.mode("append").parquet(f"{folder}/{status}")
        load_new_files(spark, folder, spec, table, log)
    # As if the last load had stopped before it was recorded as loaded.
    done = scratch_dir(spark, "log")
    read_table(spark, log).where("state = 'started' OR _source_file NOT LIKE '%/P/%'").write.parquet(done)
    spark.read.parquet(done).write.insertInto(log, overwrite=True)
    load_new_files(spark, folder, spec, table, log)
    return read_table(spark, table).select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")


@check(
    """
    SELECT dispatching_base_num, pickup_datetime, "dropOff_datetime", "PUlocationID",
      "DOlocationID", pickup_year, pickup_month
    FROM fhv_bronze
    """,
    uses=("fhv_bronze",),
)
def load_arriving_files(spark, sf_dir):
    """Two arrivals, a run after each and one more run that finds nothing new."""
    folder = scratch_dir(spark, "arrivals")
    table = f"{_database(spark)}.fhv"
    frame = spark.sql(fx.fhv(fx.SPARK), lineitem=fx.table(spark, sf_dir, "lineitem"))
    for batch in ("O", "F"):
        frame.where(F.col("batch") == batch).drop("batch").write.mode("append").parquet(
            f"{folder}/in"
        )
        load_arrivals(spark, f"{folder}/in", FHV, table, f"{folder}/state")
    load_arrivals(spark, f"{folder}/in", FHV, table, f"{folder}/state", files_per_batch=1)
    return read_table(spark, table).drop("_ingest_timestamp", "_source_file")


@check("""
    SELECT o_orderpriority, count(*) AS orders, min(o_orderdate) AS first_order
    FROM orders GROUP BY o_orderpriority
""")
def run_sql_text(spark, sf_dir):
    table = f"{_database(spark)}.orders"
    write_table(fx.table(spark, sf_dir, "orders"), table)
    return run_query(
        spark,
        f"SELECT o_orderpriority, count(*) AS orders, min(o_orderdate) AS first_order "
        f"FROM {table} GROUP BY o_orderpriority",
    )


@check("""
    SELECT count(*) AS row_count, CAST(6 AS INTEGER) AS column_count,
      'struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,'
      || 'o_orderdate:timestamp_ntz,o_orderpriority:string>' AS schema
    FROM orders
""")
def profile_rows(spark, sf_dir):
    return profile(fx.table(spark, sf_dir, "orders"))


@check("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS pickup_year,
      CAST(month(o_orderdate) AS INTEGER) AS pickup_month, count(*) AS trip_count
    FROM orders GROUP BY ALL
""")
def monthly_order_counts(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    dated = bronze_frame(orders, FHV.with_(pickup=named("o_orderdate")))
    return monthly_counts(dated)


@check(
    """
    SELECT label AS trip_type, CAST(year(month) AS INTEGER) AS pickup_year,
      CAST(month(month) AS INTEGER) AS pickup_month
    FROM (SELECT unnest(['yellow', 'green', 'fhvhv', 'fhv', 'limousine']) AS label)
    CROSS JOIN generate_series(DATE '2023-03-01', DATE '2024-06-01', INTERVAL 1 MONTH) g(month)
    WHERE NOT EXISTS (
      SELECT 1 FROM raw_trips
      WHERE trip_type = label AND pickup_year = year(month) AND pickup_month = month(month))
    """,
    uses=("raw_trips",),
)
def missing_months(spark, sf_dir):
    labels = [*fx.LABELS, "limousine"]
    return missing_partitions(fx.trips(spark, sf_dir), labels, date(2023, 3, 1), 16)


@check("""
    SELECT
      (SELECT strftime(date_trunc('month', max(o_orderdate)), '%Y-%m-%d') FROM orders) AS newest,
      (SELECT strftime(date_trunc('month', max(o_orderdate)), '%Y-%m-%d') FROM orders
       WHERE o_orderdate >= DATE '1998-08-01' AND o_orderdate < DATE '1999-02-01') AS as_of_1999
""")
def latest_months(spark, sf_dir):
    dated = with_partition_columns(fx.table(spark, sf_dir, "orders"), "o_orderdate")
    newest = latest_month(dated).select(F.col("latest_month").cast("string").alias("newest"))
    as_of = latest_month(dated, as_of=date(1999, 3, 15))
    return newest.withColumn("as_of_1999", F.lit(None).cast("string")).unionByName(
        as_of.select(
            F.lit(None).cast("string").alias("newest"),
            F.col("latest_month").cast("string").alias("as_of_1999"),
        )
    ).agg(F.max("newest").alias("newest"), F.max("as_of_1999").alias("as_of_1999"))


@check("SELECT trip_type, count(*) AS trip_count FROM raw_trips WHERE trip_type <> 'fhv' GROUP BY ALL",
       uses=("raw_trips",))
def incomplete_source_skipped(spark, sf_dir):
    sources = {label: fx.bronze(spark, sf_dir, label) for label in fx.LABELS}
    sources["fhv"] = sources["fhv"].drop("dropOff_datetime")
    stacked = unify_trips(sources, fx.SPECS, on_missing="skip")
    return stacked.groupBy("trip_type").agg(F.count(F.lit(1)).alias("trip_count"))
