from tripstrata.functions.columns import (
    available_keys,
    col,
    find_column,
    match_column,
    require_column,
)
from tripstrata.functions.times import first_of_month, minutes_between, seconds_between

__all__ = [
    "available_keys",
    "col",
    "find_column",
    "first_of_month",
    "match_column",
    "minutes_between",
    "require_column",
    "seconds_between",
]
