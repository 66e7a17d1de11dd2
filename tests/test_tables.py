import time

import pytest
from pyspark.sql import functions as F

from tests.rows import START, frame
from tripstrata import FHVHV
from tripstrata.names import SOURCE_FILE
from tripstrata.operators import apply_rules, route
from tripstrata.plans import with_duration
from tripstrata.session import FREE_SHUFFLES, SORTED_MB, open_writers, small_sorts
from tripstrata.sources import (
    ensure_layers,
    in_months,
    overwrite_months,
    read_table,
    release_replaced,
    replace_files,
    replace_split_months,
    run_query,
    stored_months,
    tables,
    with_partition_columns,
    write_split,
    write_split_passes,
    write_table,
)

MONTHS = ("pickup_year", "pickup_month")


def trips(spark, months):
    changes = [{"pickup_datetime": START.replace(month=m)} for m in months]
    return with_partition_columns(frame(spark, "fhvhv", changes), "pickup_datetime").select(
        "tips", *MONTHS
    )


def partitions(spark, table):
    return sorted(row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())


def test_layers_are_idempotent(spark, tmp_path):
    for _ in range(2):
        ensure_layers(spark, {"layer_a": "it's \\ fine"}, str(tmp_path))
        ensure_layers(spark, ["layer_b"], str(tmp_path))
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE DATABASE layer_a").collect()}
    assert described["Comment"] == "it's \\ fine"
    for name in ("layer_a", "layer_b"):
        spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.mark.parametrize("layout", ["as_is", "rebalance"])
@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("external", [False, True])
def test_full_refresh_replaces_schema_and_partitions(spark, database, tmp_path, layout, mode, external):
    table = f"{database}.t"
    path = str(tmp_path / "t") if external else None
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        first = trips(spark, [1, 2, 2]).withColumn("old", F.lit(1))
        assert write_table(first, table, MONTHS, layout, path) == 3
        assert write_table(trips(spark, [3]), table, MONTHS, layout, path) == 1
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert read_table(spark, table).columns == ["tips", *MONTHS]
    assert partitions(spark, table) == ["pickup_year=2025/pickup_month=3"]
    assert read_table(spark, table).count() == 1


def test_unknown_layout(spark, database):
    with pytest.raises(ValueError, match="layout"):
        write_table(spark.range(1), f"{database}.t", layout="sorted")


def test_empty_table(spark, database):
    assert write_table(trips(spark, [1]).where("false"), f"{database}.t", MONTHS) == 0
    assert read_table(spark, f"{database}.t").isEmpty()
    assert write_table(spark.range(0), f"{database}.u") == 0


def test_overwrite_months_leaves_other_months(spark, database):
    table = f"{database}.t"
    write_table(trips(spark, [1, 2, 2]), table, MONTHS)
    months = [(r.pickup_year, r.pickup_month) for r in trips(spark, [2, 3]).collect()]
    assert overwrite_months(trips(spark, [2, 3]).withColumn("tips", F.lit(9.0)), table, months) == 2
    stored = sorted((r.pickup_month, r.tips) for r in read_table(spark, table).collect())
    assert stored == [(1, 2.0), (2, 9.0), (3, 9.0)]
    assert overwrite_months(read_table(spark, table).limit(0), table, months[:1]) == 0
    assert sorted(r.pickup_month for r in read_table(spark, table).collect()) == [1, 3]


def test_a_stray_row_never_replaces_a_month(spark, database):
    table = f"{database}.t"
    write_table(trips(spark, [5] * 100), table, MONTHS)
    new = trips(spark, [6] * 10 + [5])
    june = [(new.first().pickup_year, 6)]
    with pytest.raises(ValueError, match="not to be replaced"):
        overwrite_months(new, table, june)
    assert read_table(spark, table).count() == 100
    assert overwrite_months(new.where(in_months(june)), table, june) == 10
    assert read_table(spark, table).where("pickup_month = 5").count() == 100


def test_a_file_is_replaced_with_its_stray_rows(spark, database):
    table = f"{database}.t"

    def loaded(months, name, tips):
        named = trips(spark, months).withColumn(SOURCE_FILE, F.lit(name))
        return named.withColumn("tips", F.lit(tips))

    first = loaded([5] * 3, "may", 1.0).unionByName(loaded([6, 6, 5], "june", 1.0))
    write_table(first.select(*[c for c in first.columns]), table, MONTHS)
    assert replace_files(loaded([6, 7], "june", 2.0), table) == 5
    stored = sorted((r.pickup_month, r[SOURCE_FILE], r.tips) for r in read_table(spark, table).collect())
    assert stored == [(5, "may", 1.0)] * 3 + [(6, "june", 2.0), (7, "june", 2.0)]


def test_rows_without_a_month_are_replaced_too(spark, database):
    table = f"{database}.t"
    none = {"pickup_year": F.lit(None).cast("int"), "pickup_month": F.lit(None).cast("int")}
    write_table(trips(spark, [1]).unionByName(trips(spark, [1, 1]).withColumns(none)), table, MONTHS)
    assert overwrite_months(trips(spark, [1]).withColumns(none), table, [(None, None)]) == 1
    assert read_table(spark, table).count() == 2
    overwrite_months(trips(spark, [1]).limit(0), table, [(None, None)])
    assert read_table(spark, table).count() == 1


def test_a_failed_pass_leaves_the_old_tables(spark, database):
    rows = with_partition_columns(frame(spark, "fhvhv", [{}, {"trip_time": 5}]), "pickup_datetime")
    routed = route(apply_rules(with_duration(rows, FHVHV), FHVHV.rules))
    clean, rejected = f"{database}.f", f"{database}.f_quarantine"
    write_split(routed, clean, rejected)
    before = read_table(spark, clean).collect() + read_table(spark, rejected).collect()

    def passes():
        yield routed
        yield routed
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        write_split_passes(passes(), clean, rejected)
    assert read_table(spark, clean).collect() + read_table(spark, rejected).collect() == before
    stored = [t.name for t in spark.catalog.listTables(database) if "_v_" in t.name]
    assert len(stored) == 1
    assert write_split_passes([routed, routed], clean, rejected) == 4
    assert read_table(spark, f"{clean}_checked").count() == 4


def test_split_is_written_once_and_read_as_two_tables(spark, database):
    rows = with_partition_columns(
        frame(spark, "fhvhv", [{}, {"trip_time": 5}, {"tips": 1.0}, {"trip_time": None}]),
        "pickup_datetime",
    )
    checked = apply_rules(with_duration(rows, FHVHV), FHVHV.rules)
    clean, rejected = f"{database}.fhvhv", f"{database}.fhvhv_quarantine"
    for _ in range(2):  # a refresh replaces both
        assert write_split(route(checked), clean, rejected) == 4
        assert read_table(spark, clean).count() == 2
        assert read_table(spark, rejected).count() == 2
    assert read_table(spark, clean).columns == checked.columns
    assert read_table(spark, rejected).columns == checked.columns
    again = read_table(spark, clean).unionByName(read_table(spark, rejected))
    assert again.exceptAll(checked).isEmpty() and checked.exceptAll(again).isEmpty()
    assert write_split(route(checked, "drop"), clean, rejected) == 3


def test_month_filter_prunes_clean_partitions(spark, database):
    rows = with_partition_columns(
        frame(spark, "fhvhv", [{}, {"pickup_datetime": START.replace(month=6, day=4)}]),
        "pickup_datetime",
    )
    checked = apply_rules(with_duration(rows, FHVHV), FHVHV.rules)
    write_split(route(checked), f"{database}.a", f"{database}.b")
    may = read_table(spark, f"{database}.a").where("pickup_month = 5")
    plan = may._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "pickup_month" in filters and "_route" in filters
    assert may.count() == 1


def test_run_query(spark, database):
    write_table(trips(spark, [1, 2, 2]), f"{database}.t", MONTHS)
    rows = run_query(spark, f"SELECT count(*) AS n FROM {database}.t").collect()
    assert rows[0].n == 3
    assert run_query(spark, "SELECT max(id) AS m FROM {r}", r=spark.range(4)).first().m == 3


def split_rows(spark, changes):
    rows = with_partition_columns(frame(spark, "fhvhv", changes), "pickup_datetime")
    return route(apply_rules(with_duration(rows, FHVHV), FHVHV.rules))


def counts(spark, clean, rejected):
    return tuple(read_table(spark, x).count() for x in (clean, rejected, f"{clean}_checked"))


MAY, JUNE = (START.year, 5), (START.year, 6)
MIXED = [{}, {"trip_time": 5}, {"pickup_datetime": START.replace(month=6, day=4)}]


@pytest.mark.parametrize("broken", ["_counted", "_partitions", "_point", "_release"])
def test_months_are_replaced_in_one_step(spark, database, monkeypatch, broken):
    clean, rejected = f"{database}.f", f"{database}.f_quarantine"
    write_split(split_rows(spark, MIXED), clean, rejected)
    before = counts(spark, clean, rejected)
    new = split_rows(spark, [{"tips": float(k)} for k in range(5)])

    def fails(*args):
        raise RuntimeError("stopped here")

    whole = getattr(tables, broken)
    monkeypatch.setattr(tables, broken, fails)
    with pytest.raises(RuntimeError):
        replace_split_months(new, clean, [MAY])
    monkeypatch.setattr(tables, broken, whole)
    # Only the last step, the release of old rows, comes after the views have moved.
    moved = broken == "_release"
    after = (5, 1, 6)
    assert counts(spark, clean, rejected) == (after if moved else before)
    assert replace_split_months(new, clean, [MAY]) == 5
    assert counts(spark, clean, rejected) == after


def test_a_reader_that_began_before_ends(spark, database):
    clean, rejected = f"{database}.f", f"{database}.f_quarantine"
    write_split(split_rows(spark, MIXED), clean, rejected)
    old = read_table(spark, f"{clean}_checked").select("trip_time", "pickup_month")
    old._jdf.queryExecution().executedPlan()
    replace_split_months(split_rows(spark, [{}] * 4), clean, [MAY])
    assert old.count() == 3
    assert counts(spark, clean, rejected) == (4, 1, 5)
    newer = read_table(spark, clean).select("trip_time")
    newer._jdf.queryExecution().executedPlan()
    write_split(split_rows(spark, [{}]), clean, rejected)
    assert newer.count() == 4
    assert counts(spark, clean, rejected) == (1, 0, 1)
    release_replaced(spark, clean)
    assert len([t.name for t in spark.catalog.listTables(database) if "_v_" in t.name]) == 1
    assert counts(spark, clean, rejected) == (1, 0, 1)


def test_strays_change_nothing_and_old_batches_go(spark, database):
    clean, rejected = f"{database}.f", f"{database}.f_quarantine"
    write_split(split_rows(spark, MIXED), clean, rejected)
    with pytest.raises(ValueError, match="not to be replaced"):
        replace_split_months(split_rows(spark, MIXED), clean, [MAY])
    assert counts(spark, clean, rejected) == (1, 2, 3)
    for n in (2, 3, 4):
        replace_split_months(split_rows(spark, [{}] * n), clean, [MAY])
        assert counts(spark, clean, rejected) == (n, 1, n + 1)
    replace_split_months(split_rows(spark, [{}]).where("false"), clean, [JUNE, (None, None)])
    assert counts(spark, clean, rejected) == (4, 0, 4)
    assert stored_months(spark, {"fhvhv": clean}).count() == 1
    listed = spark.sql(f"SHOW PARTITIONS {tables.stored_version(spark, clean)}").count()
    release_replaced(spark, clean)
    assert spark.sql(f"SHOW PARTITIONS {tables.stored_version(spark, clean)}").count() == 1 < listed


def test_views_follow_the_columns_of_a_new_build(spark, database):
    clean, rejected = f"{database}.f", f"{database}.f_quarantine"
    write_split(split_rows(spark, MIXED), clean, rejected)
    write_split(split_rows(spark, MIXED).withColumn("it's", F.lit(1)), clean, rejected)
    assert read_table(spark, clean).columns[-3:] != read_table(spark, clean).columns[:3]
    assert "it's" in read_table(spark, clean).columns and "it's" in read_table(spark, rejected).columns
    assert "_route" not in read_table(spark, clean).columns and "_batch" not in read_table(spark, clean).columns


def test_rows_of_partitioned_writes_are_not_sorted(spark, database):
    table = f"{database}.t"
    write_table(trips(spark, [1, 2]), table, partition_by=MONTHS)
    insert = f"EXPLAIN INSERT INTO {table} SELECT id * 1.0D, 2025, int(id % 12) FROM range(100)"
    with open_writers(spark):
        assert "Sort" not in spark.sql(insert).first()[0]
    assert "Sort" in spark.sql(insert).first()[0]


def test_settings_of_a_step_hold_for_all_that_overlap_and_go_back(spark):
    split, tasks = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"
    before = [spark.conf.get(name) for name in (split, tasks)]
    outer, inner = small_sorts(spark, 10_000_000), small_sorts(spark, 1)
    outer.__enter__()
    inner.__enter__()
    assert [spark.conf.get(name) for name in (split, tasks)] == [str(SORTED_MB << 20), "20"]
    outer.__exit__(None, None, None)
    assert [spark.conf.get(name) for name in (split, tasks)] == [str(SORTED_MB << 20), before[1]]
    inner.__exit__(None, None, None)
    assert [spark.conf.get(name) for name in (split, tasks)] == before


def test_settings_that_a_session_leaves_are_not_lowered(spark):
    """No rows ask for no task, which Spark refuses; few ask for less than its default."""
    tasks = "spark.sql.shuffle.partitions"
    before = spark.conf.get(tasks)
    spark.conf.unset(tasks)
    try:
        for rows, held in ((0, "200"), (1, "200"), (200_000_000, "400")):
            with small_sorts(spark, rows):
                assert spark.conf.get(tasks) == held
            assert spark.conf.get(tasks, None) is None
    finally:
        spark.conf.set(tasks, before)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for name in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name}


def test_shuffle_files_of_a_write_go_when_it_ends(spark, database):
    """They do not wait for the driver to collect its garbage."""
    before = shuffle_files(spark)
    rows = trips(spark, [1, 2])
    assert write_table(rows, f"{database}.t", partition_by=MONTHS, layout="rebalance") == 2
    until = time.monotonic() + 5
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(FREE_SHUFFLES, None) is None
