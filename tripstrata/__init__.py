"""Layered trip tables on Spark: ingest, deduplicate, check, stack, summarise."""

from tripstrata.datasets import ALL, FHV, FHVHV, GREEN, YELLOW
from tripstrata.spec import ColumnMatch, DatasetSpec, Duration, MoneySpec, Rule, named

__all__ = [
    "ALL",
    "FHV",
    "FHVHV",
    "GREEN",
    "YELLOW",
    "ColumnMatch",
    "DatasetSpec",
    "Duration",
    "MoneySpec",
    "Rule",
    "named",
]
