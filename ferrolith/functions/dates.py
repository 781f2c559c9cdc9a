"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(text: Column, pattern: str) -> Column:
    """Date by pattern; NULL when the text does not fit."""
    return F.try_to_date(text, pattern)


def weekday(moment: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(moment)


def date_parts(moment: Column) -> dict[str, Column]:
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
        "weekday": F.weekday(moment),
    }


def minutes_between(later: Column, earlier: Column) -> Column:
    """Elapsed minutes as a double, from microsecond timestamps."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return micros.cast("double") / F.lit(60_000_000.0)


def whole_minutes_between(later: Column, earlier: Column) -> Column:
    """Elapsed whole minutes (truncated)."""
    return F.timestamp_diff("MINUTE", earlier, later)
