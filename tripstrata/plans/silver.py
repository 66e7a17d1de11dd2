"""Deduplicate, check and split one dataset."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.functions.columns import available_keys, col, find_column, match_column, require_column
from tripstrata.functions.times import minutes_between, seconds_between
from tripstrata.operators.dedup import dedup_first
from tripstrata.operators.quality import (
    apply_rules,
    merge_rule_counters,
    route,
    rule_counters,
    rule_report,
)
from tripstrata.operators.reports import monthly_counts
from tripstrata.plans.bronze import MONTH_COLUMNS
from tripstrata.session import small_sorts
from tripstrata.sources.tables import (
    in_months,
    overwrite_months,
    read_table,
    replace_split_months,
    stored_months,
    stored_version,
    write_split_passes,
)
from tripstrata.spec import DatasetSpec


@dataclass(frozen=True)
class SilverCounts:
    """Rows of one build. ``not_kept`` are the duplicates and, under ``null_policy="drop"``, also
    the rows without a verdict."""

    bronze_rows: int
    not_kept: int
    clean_rows: int
    quarantined_rows: int


def dedup_keys(df: DataFrame, spec: DatasetSpec) -> list[str]:
    """Pickup and dropoff time, then the other identity columns, as far as they exist.

    The pickup time leads because it separates the most rows; the sorts before and after the
    shuffle compare by the first key first. Only a spec with ``may_lack_columns`` may go without one;
    for any other, fewer keys would make different trips equal.
    """
    times = {"pickup time": match_column(df, spec.pickup), "dropoff time": match_column(df, spec.dropoff)}
    keys = available_keys(df, spec.keys)
    missing = [name for name, found in times.items() if found is None]
    missing += [name for name in spec.keys if find_column(df, equals_ci=name) is None]
    if missing and not spec.may_lack_columns:
        raise ValueError(f"{spec.label} has no column for {missing}; columns are {df.columns}")
    return [name for name in times.values() if name] + keys


def with_duration(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Add the trip length in the unit of the spec, if both times exist."""
    pickup, dropoff = match_column(df, spec.pickup), match_column(df, spec.dropoff)
    if pickup is None or dropoff is None:
        return df
    between = minutes_between if spec.duration.unit == "min" else seconds_between
    return df.withColumn(spec.duration.column, between(col(pickup), col(dropoff)))


def checked_frame(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Deduplicated rows with their length, rule flags and verdict."""
    deduped = dedup_first(bronze, dedup_keys(bronze, spec), tiebreak=spec.tiebreak)
    return apply_rules(with_duration(deduped, spec), spec.rules)


def build_silver(
    spark: SparkSession,
    bronze_table: str,
    spec: DatasetSpec,
    clean: str,
    quarantine: str,
    null_policy: str = "quarantine",
    rows_per_pass: int | None = None,
) -> SilverCounts:
    """Write the clean and quarantined trips of one dataset.

    The only shuffle is that of the deduplication. Duplicates share their pickup time and with it
    their month, so the work can be cut into passes over whole months, each of at most
    ``rows_per_pass`` rows unless a single month has more. A pass reads only its own partitions.
    Readers see the new tables when all passes are stored, however many there are. All counts come
    from parquet footers.
    """
    bronze = read_table(spark, bronze_table)
    months = [tuple(row) for row in monthly_counts(bronze).collect()]
    bronze_rows = sum(rows for _, _, rows in months)
    parts = month_passes(months, rows_per_pass or max(1, bronze_rows))
    passes = (
        route(checked_frame(bronze.where(in_months(part)), spec), null_policy) for part in parts
    )
    largest = max(sum(rows for y, m, rows in months if (y, m) in part) for part in parts)
    with small_sorts(spark, largest):
        written = write_split_passes(passes, clean, quarantine, MONTH_COLUMNS)
    counted = rule_counters(read_table(spark, f"{clean}_checked"), spec.rules, *MONTH_COLUMNS)
    _write_counters(counted, clean, "overwrite")
    clean_rows = read_table(spark, clean).count()
    return SilverCounts(
        bronze_rows=bronze_rows,
        not_kept=bronze_rows - written,
        clean_rows=clean_rows,
        quarantined_rows=written - clean_rows,
    )


def rebuild_months(
    spark: SparkSession,
    bronze_table: str,
    spec: DatasetSpec,
    clean: str,
    months: Iterable[tuple[int | None, int | None]],
    null_policy: str = "quarantine",
) -> int:
    """Deduplicate and check only the given months again and replace them on both sides.

    The key holds the pickup time, so no duplicate is in another month. Returns the rows written.
    """
    months = list(months)
    bronze = read_table(spark, bronze_table).where(in_months(months))
    # A month without counters is counted anew, one with old counters would be taken for up to date.
    _forget_counters(spark, clean, months)
    with small_sorts(spark, bronze.count()):
        rows = replace_split_months(route(checked_frame(bronze, spec), null_policy), clean, months)
    checked = read_table(spark, f"{clean}_checked").where(in_months(months))
    _write_counters(rule_counters(checked, spec.rules, *MONTH_COLUMNS), clean, "append")
    return rows


def month_passes(
    months: list[tuple[int | None, int | None, int]], rows_per_pass: int
) -> list[list[tuple[int | None, int | None]]]:
    """Group (year, month, rows) into consecutive passes, always at least one pass."""
    passes: list[list[tuple[int | None, int | None]]] = [[]]
    filled = 0
    for year, month, rows in months:
        if passes[-1] and filled + rows > rows_per_pass:
            passes.append([])
            filled = 0
        passes[-1].append((year, month))
        filled += rows
    return passes


def silver_report(spark: SparkSession, clean: str, spec: DatasetSpec) -> DataFrame:
    """Failures per rule over both halves of a split, from the counters of each month.

    Months without counters of the current version, as after a refresh that broke off, are counted
    from their stored flag columns, and only those.
    """
    checked = read_table(spark, f"{clean}_checked")
    if not spark.catalog.tableExists(_counters_of(clean)):
        return rule_report(checked, spec.rules)
    counters = _current_counters(spark, clean)
    months = stored_months(spark, {spec.label: clean}, side=None).select(*MONTH_COLUMNS).distinct()
    same = [months[c].eqNullSafe(counters[c]) for c in MONTH_COLUMNS]
    missing = [tuple(row) for row in months.join(counters, same, "left_anti").collect()]
    if missing:
        late = rule_counters(checked.where(in_months(missing)), spec.rules, *MONTH_COLUMNS)
        counters = counters.unionByName(late)
    return merge_rule_counters(counters, spec.rules)


def _counters_of(clean: str) -> str:
    return f"{clean}_rule_counts"


def _current_counters(spark: SparkSession, clean: str) -> DataFrame:
    counters = read_table(spark, _counters_of(clean))
    return counters.where(F.col("version") == stored_version(spark, clean)).drop("version")


def _write_counters(counters: DataFrame, clean: str, mode: str) -> None:
    spark, name = counters.sparkSession, _counters_of(clean)
    rows = counters.withColumn("version", F.lit(stored_version(spark, clean)))
    rows = rows.select(*[c for c in rows.columns if c not in MONTH_COLUMNS], *MONTH_COLUMNS)
    # Some tens of bytes a month: one file, or one for each month.
    rows.repartition(*MONTH_COLUMNS).write.partitionBy(*MONTH_COLUMNS).mode(mode).saveAsTable(name)


def _forget_counters(
    spark: SparkSession, clean: str, months: list[tuple[int | None, int | None]]
) -> None:
    name = _counters_of(clean)
    if spark.catalog.tableExists(name):
        overwrite_months(read_table(spark, name).limit(0), name, months)
