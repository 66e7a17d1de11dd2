"""Time expressions. All stay inside Spark's generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end. ``unix_timestamp`` accepts both timestamp kinds, a cast
    to bigint does not accept ``timestamp_ntz``."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
