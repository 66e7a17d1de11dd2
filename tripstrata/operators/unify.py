"""Bring differently shaped trip tables to one narrow shape and stack them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.columns import col, match_column
from tripstrata.names import LABEL
from tripstrata.spec import DatasetSpec

# The shape of the stacked table after its label.
UNIFIED_TYPES = {
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "PULocationID": "int",
    "DOLocationID": "int",
    "pickup_year": "int",
    "pickup_month": "int",
}


def narrow(
    df: DataFrame,
    label: str,
    mapping: Mapping[str, str | Column],
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """A literal label and the mapped columns, nothing else. ``mapping`` is target -> source.

    A raw column that has the label's name is dropped with the rest of the unmapped columns.
    """
    columns = []
    for target, source in mapping.items():
        value = col(source) if isinstance(source, str) else source
        if types and target in types:
            value = value.cast(types[target])
        columns.append(value.alias(target))
    return df.select(F.lit(label).alias(LABEL), *columns)


def stack_mapping(df: DataFrame, spec: DatasetSpec) -> dict[str, str | None]:
    """Target column -> column of the source, None where there is none."""
    return {
        "pickup_datetime": match_column(df, spec.pickup),
        "dropoff_datetime": match_column(df, spec.dropoff),
        "PULocationID": match_column(df, spec.pickup_zone),
        "DOLocationID": match_column(df, spec.dropoff_zone),
        "pickup_year": "pickup_year",
        "pickup_month": "pickup_month",
    }


def incomplete_sources(
    sources: Mapping[str, DataFrame], specs: Mapping[str, DatasetSpec]
) -> dict[str, list[str]]:
    """The sources that cannot be stacked, with the columns they lack."""
    lacking = {
        label: [target for target, found in stack_mapping(df, specs[label]).items() if found is None]
        for label, df in sources.items()
    }
    return {label: missing for label, missing in lacking.items() if missing}


def unify_trips(
    sources: Mapping[str, DataFrame],
    specs: Mapping[str, DatasetSpec],
    on_missing: str = "spec",
) -> DataFrame:
    """Stack the common columns of all sources, keeping duplicates.

    A source that lacks a time or location column is an error, unless its spec says it may lack
    columns; then it is left out (``incomplete_sources`` names it). ``on_missing="raise"`` makes it an
    error for all, ``"skip"`` for none.
    """
    if on_missing not in ("spec", "skip", "raise"):
        raise ValueError("on_missing must be 'spec', 'skip' or 'raise'")
    lacking = incomplete_sources(sources, specs)
    for label, missing in lacking.items():
        if on_missing == "raise" or on_missing == "spec" and not specs[label].may_lack_columns:
            columns = sources[label].columns
            raise ValueError(f"{label} has no column for {missing}; columns are {columns}")
    frames = [
        narrow(df, label, stack_mapping(df, specs[label]), UNIFIED_TYPES)
        for label, df in sources.items()
        if label not in lacking
    ]
    if not frames:
        raise ValueError("no source has the columns to unify")
    return reduce(DataFrame.unionByName, frames)
