"""Which months are there and which are missing."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.times import first_of_month
from tripstrata.names import LABEL


def loaded_months(df: DataFrame) -> DataFrame:
    """Each type and month that has a row. Each task reduces its rows before the shuffle.

    For stored tables, ``stored_months`` tells the same from the catalog, without a scan; its result
    may be passed to all functions here.
    """
    return df.select(LABEL, "pickup_year", "pickup_month").distinct()


def expected_months(df: DataFrame, datasets: Sequence[str], start: date, months: int) -> DataFrame:
    """The grid of types and months, exploded from one row."""
    first = F.lit(start.replace(day=1))
    last = F.add_months(first, months - 1)
    one_row = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in datasets])).alias(LABEL),
        F.sequence(first, last, F.expr("interval 1 month")).alias("grid"),
    )
    dated = one_row.select(LABEL, F.explode("grid").alias("month"))
    return dated.select(
        LABEL, F.year("month").alias("pickup_year"), F.month("month").alias("pickup_month")
    )


def missing_partitions(
    df: DataFrame, datasets: Sequence[str], start: date, months: int
) -> DataFrame:
    """Months of the window in which a type has no trips."""
    expected = expected_months(df, datasets, start, months)
    found = loaded_months(df)
    return expected.join(found, [LABEL, "pickup_year", "pickup_month"], "left_anti")


def latest_month(
    df: DataFrame,
    as_of: date | None = None,
    lag_months: int = 2,
    max_lookback: int = 6,
) -> DataFrame:
    """The newest month with data, NULL if there is none.

    With ``as_of``, months are looked at from ``lag_months`` before it, the usual publishing delay,
    and no further back than ``max_lookback`` months.
    """
    months = df.select(first_of_month(F.col("pickup_year"), F.col("pickup_month")).alias("month"))
    if as_of is not None:
        newest = F.add_months(F.lit(as_of.replace(day=1)), -lag_months)
        oldest = F.add_months(newest, 1 - max_lookback)
        months = months.where(F.col("month").between(oldest, newest))
    return months.agg(F.max("month").alias("latest_month"))
