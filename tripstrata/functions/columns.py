"""Finding columns by name before a plan is built. Only ``df.columns`` is read, never a row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstrata.spec import ColumnMatch


def col(name: str) -> Column:
    """A column by its literal name, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def find_column(
    df: DataFrame | Iterable[str],
    *,
    all_of: Sequence[str] = (),
    equals_ci: str | None = None,
) -> str | None:
    """First column equal to ``equals_ci`` or containing every word of ``all_of``, in any case."""
    wanted = [word.lower() for word in all_of]
    if equals_ci is None and not wanted:
        raise ValueError("give either equals_ci or all_of")
    for name in df.columns if isinstance(df, DataFrame) else df:
        lowered = name.lower()
        if equals_ci is not None:
            if lowered == equals_ci.lower():
                return name
        elif all(word in lowered for word in wanted):
            return name
    return None


def match_column(df: DataFrame | Iterable[str], match: ColumnMatch) -> str | None:
    return find_column(df, all_of=match.all_of, equals_ci=match.equals_ci)


def require_column(df: DataFrame, match: ColumnMatch, what: str) -> str:
    """Like ``match_column``, but a missing column is an error that lists what there is."""
    name = match_column(df, match)
    if name is None:
        raise ValueError(f"no {what} column found; columns are {df.columns}")
    return name


def available_keys(df: DataFrame | Iterable[str], candidates: Iterable[str]) -> list[str]:
    """The candidates that exist, spelled as in ``df``, each once."""
    columns = df.columns if isinstance(df, DataFrame) else list(df)
    found = (find_column(columns, equals_ci=name) for name in candidates)
    return list(dict.fromkeys(name for name in found if name is not None))
