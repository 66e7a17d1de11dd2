"""All steps from raw files to summary tables, in dependency order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tripstrata.datasets import ALL
from tripstrata.operators.unify import incomplete_sources
from tripstrata.plans.bronze import load_bronze
from tripstrata.plans.gold import (
    DEMAND,
    DURATION,
    REVENUE,
    UNIFIED,
    build_demand,
    build_durations,
    build_revenue,
    build_unified,
    replace_summary_months,
    replace_unified_months,
)
from tripstrata.plans.silver import SilverCounts, build_silver, dedup_keys, rebuild_months
from tripstrata.sources.ledger import load_new_months
from tripstrata.sources.tables import ensure_layers, read_table
from tripstrata.spec import DatasetSpec


@dataclass(frozen=True)
class Layers:
    """Database names. ``location`` is the parent folder, the warehouse if not given."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    location: str | None = None

    def create(self, spark: SparkSession) -> None:
        comments = {
            self.bronze: "source rows with load metadata",
            self.silver: "deduplicated and checked trips",
            self.gold: "summary tables",
        }
        ensure_layers(spark, comments, self.location)

    def clean(self, label: str) -> str:
        return f"{self.silver}.{label}"

    def quarantine(self, label: str) -> str:
        return f"{self.silver}.{label}_quarantine"


@dataclass(frozen=True)
class PipelineCounts:
    bronze: Mapping[str, int]
    silver: Mapping[str, SilverCounts]
    gold: Mapping[str, int]
    keys: Mapping[str, tuple[str, ...]]
    """The columns that identify a trip of each source."""
    skipped: Mapping[str, list[str]]
    """Sources that are not in the stacked trips, with the columns they lack."""


def run_pipeline(
    spark: SparkSession,
    sources: Mapping[str, str | list[str]],
    layers: Layers = Layers(),
    specs: Iterable[DatasetSpec] = ALL,
    drifting: Iterable[str] = (),
    null_policy: str = "quarantine",
    parallel: int = 4,
    rows_per_pass: int | None = None,
    layout: str = "as_is",
    accuracy: int | None = None,
) -> PipelineCounts:
    """Full refresh of every layer. ``sources`` maps labels to raw folders, ``drifting`` names
    those whose folders or files are given one by one because their types differ.

    The sources do not depend on each other up to their clean tables, so up to ``parallel`` of them
    are worked on at a time and the last tasks of one leave no cores idle. Revenue needs only the
    clean tables, demand and durations the stacked trips. ``rows_per_pass`` bounds the shuffle of a
    clean table, ``layout`` is that of the raw and the stacked table (see ``write_table``), and
    ``accuracy`` makes percentiles approximate.
    """
    by_label = {spec.label: spec for spec in specs if spec.label in sources}
    unknown = set(sources) - set(by_label)
    if unknown:
        raise ValueError(f"no spec for {sorted(unknown)}")
    layers.create(spark)
    drifting = set(drifting)

    def to_clean(label: str) -> tuple[int, SilverCounts]:
        spec, table = by_label[label], f"{layers.bronze}.{label}"
        loaded = load_bronze(spark, sources[label], spec, table, label in drifting, layout)
        return loaded, build_silver(
            spark,
            table,
            spec,
            layers.clean(label),
            layers.quarantine(label),
            null_policy,
            rows_per_pass,
        )

    clean = {label: layers.clean(label) for label in by_label}
    with ThreadPoolExecutor(parallel) as pool:
        built = dict(zip(by_label, pool.map(to_clean, by_label), strict=True))
        pending = {}
        if any(spec.money for spec in by_label.values()):
            pending[REVENUE] = pool.submit(build_revenue, spark, clean, by_label, layers.gold)
        gold = {UNIFIED: build_unified(spark, clean, by_label, layers.gold, layout)}
        pending[DEMAND] = pool.submit(build_demand, spark, layers.gold)
        pending[DURATION] = pool.submit(build_durations, spark, layers.gold, accuracy)
        gold |= {name: future.result() for name, future in pending.items()}
    return PipelineCounts(
        bronze={label: loaded for label, (loaded, _) in built.items()},
        silver={label: counts for label, (_, counts) in built.items()},
        gold=gold,
        keys={
            label: tuple(dedup_keys(read_table(spark, f"{layers.bronze}.{label}"), spec))
            for label, spec in by_label.items()
        },
        skipped=incomplete_sources(
            {label: read_table(spark, name) for label, name in clean.items()}, by_label
        ),
    )


def refresh_months(
    spark: SparkSession,
    layers: Layers,
    months: Iterable[tuple[int | None, int | None]],
    specs: Iterable[DatasetSpec] = ALL,
    null_policy: str = "quarantine",
    accuracy: int | None = None,
) -> None:
    """Bring clean, stacked and summary tables up to date after raw rows of some months changed.

    Only those months are deduplicated, checked, stacked and summed up again. The summaries are then
    put together from their monthly parts, without the trips of other months. ``accuracy`` asks for
    percentiles by a sketch, which is made from all stacked trips.
    """
    months = list(months)
    by_label = {
        spec.label: spec
        for spec in specs
        if spark.catalog.tableExists(f"{layers.bronze}.{spec.label}")
    }
    for label, spec in by_label.items():
        table = f"{layers.bronze}.{label}"
        rebuild_months(spark, table, spec, layers.clean(label), months, null_policy)
    clean = {label: layers.clean(label) for label in by_label}
    replace_unified_months(spark, clean, by_label, layers.gold, months)
    replace_summary_months(spark, clean, by_label, layers.gold, months)
    if accuracy is not None:
        build_durations(spark, layers.gold, accuracy)


def refresh_new_files(
    spark: SparkSession,
    sources: Mapping[str, str],
    layers: Layers,
    specs: Iterable[DatasetSpec] = ALL,
    null_policy: str = "quarantine",
) -> dict[str, list[tuple[int | None, int | None]]]:
    """Load the files that are new in each source's folder and bring all layers up to date with them.

    Raw tables are kept by a ledger (``<bronze>.<label>_loads``). Only months that new or changed files
    have rows in are deduplicated, checked, stacked and summed up; the first run builds everything.
    Returns those months for each source. Months are written down before any row is loaded and until all
    layers have them, so a run that broke off anywhere can be started again.
    """
    by_label = {spec.label: spec for spec in specs if spec.label in sources}
    layers.create(spark)
    todo = f"{layers.bronze}.months_to_refresh"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {todo} (label string, year int, month int) USING parquet")
    changed: dict[str, list[tuple[int | None, int | None]]] = {}
    for label, spec in by_label.items():
        table = f"{layers.bronze}.{label}"

        def remember(months: list[tuple], label: str = label) -> None:
            listed = [(label, *month) for month in months]
            spark.createDataFrame(listed, "label string, year int, month int").write.insertInto(todo)

        loads = f"{table}_loads"
        _, changed[label] = load_new_months(spark, sources[label], spec, table, loads, before=remember)
    clean = {label: layers.clean(label) for label in by_label}
    fresh = [label for label in by_label if not spark.catalog.tableExists(clean[label])]
    if fresh or not spark.catalog.tableExists(f"{layers.gold}.{UNIFIED}"):
        for label, spec in by_label.items():
            table = f"{layers.bronze}.{label}"
            build_silver(spark, table, spec, clean[label], layers.quarantine(label), null_policy)
        build_unified(spark, clean, by_label, layers.gold)
        build_demand(spark, layers.gold)
        build_durations(spark, layers.gold)
        if any(spec.money for spec in by_label.values()):
            build_revenue(spark, clean, by_label, layers.gold)
    else:
        waiting = [tuple(r) for r in read_table(spark, todo).select("year", "month").distinct().collect()]
        if waiting:
            refresh_months(spark, layers, waiting, by_label.values(), null_policy)
    spark.sql(f"TRUNCATE TABLE {todo}")
    return changed
