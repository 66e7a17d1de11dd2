"""Plain descriptions of a trip source: its columns, its identity and what counts as a valid trip.

Everything here is data. The operators read these descriptions, so a further source needs a new
``DatasetSpec`` and no new code.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

Bound = int | float | datetime


@dataclass(frozen=True)
class ColumnMatch:
    """How to recognise a column: by its name in any case, or by words its name must contain."""

    equals_ci: str | None = None
    all_of: tuple[str, ...] = ()

    def __post_init__(self):
        if (self.equals_ci is None) == (not self.all_of):
            raise ValueError("give either equals_ci or all_of")


def named(name: str) -> ColumnMatch:
    return ColumnMatch(equals_ci=name)


@dataclass(frozen=True)
class Rule:
    """A bounds check over one or more columns, all of which must pass.

    ``low``/``high`` are inclusive, ``above``/``below`` are exclusive. Bounds of time columns are
    datetimes without offset. An ``optional`` rule passes every row when one of its columns does
    not exist.
    """

    name: str
    columns: tuple[str, ...]
    low: Bound | None = None
    high: Bound | None = None
    above: Bound | None = None
    below: Bound | None = None
    optional: bool = False

    @classmethod
    def between(cls, name: str, columns: str | tuple[str, ...], low, high, optional=False) -> Rule:
        return cls(name, _as_tuple(columns), low=low, high=high, optional=optional)

    @classmethod
    def gt(cls, name: str, columns: str | tuple[str, ...], bound, optional=False) -> Rule:
        return cls(name, _as_tuple(columns), above=bound, optional=optional)

    @classmethod
    def window(cls, name: str, column: str, start: datetime, end: datetime) -> Rule:
        """Times from ``start`` on and before ``end``. No source has such a rule by default: add
        one to keep trips with dates outside the loaded months out of the clean table."""
        return cls(name, (column,), low=start, below=end)

    @property
    def flag(self) -> str:
        return f"is_valid_{self.name}"


@dataclass(frozen=True)
class Duration:
    """Name and unit ("min" or "sec") of the trip length derived from the two timestamps."""

    column: str
    unit: str


@dataclass(frozen=True)
class MoneySpec:
    """Fare columns. Without a reported ``total``, revenue is total fare plus total tips."""

    fare: str
    tips: str
    total: str | None = None


@dataclass(frozen=True)
class DatasetSpec:
    label: str
    schema: str | None
    pickup: ColumnMatch
    dropoff: ColumnMatch
    pickup_zone: ColumnMatch
    dropoff_zone: ColumnMatch
    duration: Duration
    rules: tuple[Rule, ...]
    keys: tuple[str, ...]
    """Identity columns besides pickup and dropoff time."""
    money: MoneySpec | None = None
    may_lack_columns: bool = False
    """Whether tables may come without some keys, and without times or zones. Duplicates are then
    found by the keys there are, and a table that cannot be stacked is left out and reported. For any
    other source a missing column is an error."""
    tiebreak: tuple[str, ...] | None = None
    """Order among duplicates with equal ingest time; ``None`` means all remaining columns."""

    def with_(self, **changes) -> DatasetSpec:
        return replace(self, **changes)


def _as_tuple(columns: str | tuple[str, ...]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)
