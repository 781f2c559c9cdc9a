"""Grouped reports from short specifications.

A report says which rows count, what is measured per group, how small a group
may be, and what leads the table. One operator turns any of them into an
aggregate, so a study's reports are data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Measure = Callable[[], Column]


def rows() -> Measure:
    return lambda: F.count("*")


def distinct(column: str) -> Measure:
    return lambda: F.count_distinct(column)


def holds(condition: str) -> Measure:
    """Rows for which an SQL condition is true."""
    return lambda: F.count_if(F.expr(condition))


def measured(how: Callable[[str], Column], column: str, digits: int | None = None) -> Measure:
    """An aggregate function of a column, rounded."""
    return lambda: how(column) if digits is None else F.round(how(column), digits)


@dataclass(frozen=True)
class Report:
    """``only``: SQL condition on the rows; ``least``: a measure and its least value per group; ``lead``: the measure that
    orders the groups, largest first (ties by key). Without ``key`` the report is one row."""

    measures: Mapping[str, Measure]
    key: str | None = None
    only: str | None = None
    least: tuple[str, float] | None = None
    lead: str | None = None
    settings: Mapping[str, float] = field(default_factory=dict)

    def with_settings(self, **settings: float) -> Report:
        """The report with other values for the names in braces of ``only`` and for ``least``."""
        return replace(self, settings={**self.settings, **settings})

    def run(self, df: DataFrame) -> DataFrame:
        kept = df.filter(self.only.format(**self.settings)) if self.only else df
        table = kept.groupBy(*([self.key] if self.key else [])).agg(*[make().alias(name) for name, make in self.measures.items()])
        if self.least:
            name, value = self.least
            table = table.filter(F.col(name) >= self.settings.get("least", value))
        return table.orderBy(F.desc(self.lead), self.key) if self.lead else table
