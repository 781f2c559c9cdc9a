"""Deduplication, first-n, sampling and set operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolith.operators.ordering import hash_order


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``.

    A ``min_by`` aggregate: rows are reduced before the shuffle, so a key
    with most of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int,
                    name: str = "place") -> DataFrame:
    """The first ``n`` rows per key with their place.

    Spark turns ``row_number <= n`` into a group limit before the shuffle, so
    each map task sends at most ``n`` rows per key.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).filter(F.col(name) <= n)


def best_column(df: DataFrame, columns: Sequence[str], name: str = "best", absolute: bool = False) -> DataFrame:
    """Name of the column with the largest value per row (first of equals)."""
    value = lambda c: F.abs(c) if absolute else F.col(c)
    top = F.greatest(*[value(c) for c in columns])
    label = None
    for column in columns:
        hit = value(column) == top
        label = F.when(hit, column) if label is None else label.when(hit, column)
    return df.withColumn(name, label)


def random_sample(df: DataFrame, row_id: str, n: int, seed: int) -> DataFrame:
    """``n`` reproducible random rows (smallest hashes; a distributed top-n)."""
    return df.orderBy(hash_order(F.col(row_id), seed), row_id).limit(n)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``."""
    return left.subtract(right)


def exclusion_band(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Drop rows with low < value < high; NULL values stay."""
    inside = (F.col(column) > low) & (F.col(column) < high)
    return df.filter(~F.coalesce(inside, F.lit(False)))


def sigma_filter(df: DataFrame, columns: Sequence[str], width: float = 3.0) -> DataFrame:
    """Keep values within ``width`` standard deviations of the mean, column after column.

    Each column's statistics come from the rows the previous columns left
    over, so they are fetched one by one (a single row each). The resulting
    plan is one filter with literal limits, which reaches the scan. NULL
    values stay.
    """
    kept = df
    for column in columns:
        stats = kept.agg(F.avg(column).alias("mean"), F.stddev_samp(column).alias("spread")).first()
        if stats["mean"] is None or stats["spread"] is None:
            continue
        low, high = stats["mean"] - width * stats["spread"], stats["mean"] + width * stats["spread"]
        kept = kept.filter(F.col(column).between(low, high) | F.col(column).isNull())
    return kept


def pick(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename columns in one step."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def drop_index_column(df: DataFrame, name: str = "Unnamed: 0") -> DataFrame:
    """Drop the index column some CSV writers leave behind, when it is there."""
    return df.drop(name)
