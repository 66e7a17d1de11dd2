"""Validity rules, the clean/quarantine split and the failure report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.functions.columns import col, find_column
from tripstrata.names import CLEAN, QUARANTINE, ROUTE, VERDICT
from tripstrata.spec import Bound, Rule

NULL_POLICIES = ("quarantine", "drop")


def apply_rules(df: DataFrame, rules: Sequence[Rule], nan_is_unknown: bool = False) -> DataFrame:
    """Add one flag per rule and ``is_valid_trip``, their conjunction.

    A flag is NULL when a checked column is NULL, and so is the verdict unless another rule fails.
    Spark takes NaN as larger than any number, so it passes a lower bound; ``nan_is_unknown`` treats it
    as a NULL instead.
    """
    flagged = df.withColumns({rule.flag: rule_flag(df, rule, nan_is_unknown) for rule in rules})
    return flagged.withColumn(VERDICT, reduce(and_, [F.col(rule.flag) for rule in rules]))


def rule_flag(df: DataFrame, rule: Rule, nan_is_unknown: bool = False) -> Column:
    found = [find_column(df, equals_ci=name) for name in rule.columns]
    if None in found:
        if rule.optional:
            return F.lit(True)
        raise ValueError(f"rule {rule.name} needs {rule.columns}; columns are {df.columns}")
    values = [col(name) for name in found]
    if nan_is_unknown:
        kinds = dict(df.dtypes)
        values = [
            F.when(~F.isnan(value), value) if kinds[name] in ("double", "float") else value
            for name, value in zip(found, values, strict=True)
        ]
    return reduce(and_, [_within(value, rule) for value in values])


def _within(value: Column, rule: Rule) -> Column:
    tests = []
    if rule.low is not None:
        tests.append(value >= _bound(rule.low))
    if rule.high is not None:
        tests.append(value <= _bound(rule.high))
    if rule.above is not None:
        tests.append(value > _bound(rule.above))
    if rule.below is not None:
        tests.append(value < _bound(rule.below))
    if not tests:
        raise ValueError(f"rule {rule.name} has no bound")
    return reduce(and_, tests)


def _bound(value: Bound) -> Column:
    if isinstance(value, datetime):
        # A datetime literal would be read in the zone of the driver's machine.
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


def route(checked: DataFrame, null_policy: str = "quarantine") -> DataFrame:
    """Add ``_route``. A row is clean when every check is true.

    With ``null_policy="quarantine"`` every other row is quarantined. With ``"drop"`` rows without
    a verdict are in neither side, as two plain filters on the verdict would have it.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    if null_policy == "drop":
        checked = checked.where(F.col(VERDICT).isNotNull())
    return checked.withColumn(
        ROUTE, F.when(F.coalesce(VERDICT, F.lit(False)), CLEAN).otherwise(QUARANTINE)
    )


def split(checked: DataFrame, null_policy: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Clean and quarantined rows, flags kept on both sides.

    Both are lazy views of the same plan. To store both sides use ``write_split``, which runs it
    once.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    accepted = F.coalesce(VERDICT, F.lit(False))
    rejected = ~accepted if null_policy == "quarantine" else ~F.col(VERDICT)
    return checked.where(accepted), checked.where(rejected)


def rule_report(checked: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: total, and per rule how many rows fail it and for how many it is unknown."""
    return checked.agg(*_rule_counts(rules))


def rule_counters(checked: DataFrame, rules: Sequence[Rule], *by: str) -> DataFrame:
    """The counts of ``rule_report`` for each value of ``by``; they add up to those of all rows."""
    return checked.groupBy(*by).agg(*_rule_counts(rules))


def merge_rule_counters(counters: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The report that the rows behind the counters would give."""
    names = ["total"] + [f"{kind}_{rule.name}" for rule in rules for kind in ("bad", "unknown")]
    return counters.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n) for n in names])


def _rule_counts(rules: Sequence[Rule]) -> list[Column]:
    counts = [F.count(F.lit(1)).alias("total")]
    for rule in rules:
        flag = F.col(rule.flag)
        counts.append(F.count_if(~flag).alias(f"bad_{rule.name}"))
        counts.append(F.count_if(flag.isNull()).alias(f"unknown_{rule.name}"))
    return counts


def rule_alerts(report: DataFrame, rules: Sequence[Rule], max_failed_pct: float) -> DataFrame:
    """The report as one row per rule, with the failed share and whether it exceeds the limit."""
    per_rule = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col(f"bad_{rule.name}").alias("failed"),
                F.col(f"unknown_{rule.name}").alias("unknown"),
            )
            for rule in rules
        ]
    )
    share = F.when(F.col("total") > 0, F.col("failed") * F.lit(100.0) / F.col("total"))
    return (
        report.select("total", F.inline(per_rule))
        .withColumn("failed_pct", F.coalesce(share, F.lit(0.0)))
        .withColumn("alert", F.col("failed_pct") > F.lit(float(max_failed_pct)))
    )
