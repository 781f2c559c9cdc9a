"""Joins and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def previous_pairs(df: DataFrame, row_id: str, previous_id: str, delay: str, gap: str) -> DataFrame:
    """Rows that follow another row, with that row's delay.

    Keeps rows that name a previous row and a gap. A previous row that is
    missing, or has no delay, counts as delay 0. ``is_problem`` marks a
    previous delay longer than the gap.
    """
    followers = df.filter(F.col(previous_id).isNotNull() & F.col(gap).isNotNull())
    previous = df.filter(F.col(delay).isNotNull()).select(
        F.col(row_id).alias(previous_id), F.col(delay).alias("prev_delay")
    )
    joined = followers.join(previous, previous_id, "left")
    return with_problem_flag(joined, F.col("prev_delay"), F.col(gap))


def with_problem_flag(df: DataFrame, previous_delay: Column, gap: Column) -> DataFrame:
    filled = F.coalesce(previous_delay.cast("double"), F.lit(0.0))
    return df.withColumns({"prev_delay_filled": filled, "is_problem": filled > gap})


def lookup_with_fallback(df: DataFrame, precise: DataFrame, coarse: DataFrame, precise_keys: Sequence[str],
                         coarse_keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Fill ``values`` from ``precise``, else from ``coarse``; ``match_level`` names the source."""
    fine = precise.select(*precise_keys, *[F.col(v).alias(f"_fine_{v}") for v in values])
    rough = coarse.select(*coarse_keys, *[F.col(v).alias(f"_rough_{v}") for v in values])
    joined = df.join(fine, list(precise_keys), "left").join(rough, list(coarse_keys), "left")
    has_fine, has_rough = (F.col(f"_{side}_{values[0]}").isNotNull() for side in ("fine", "rough"))
    level = F.when(has_fine, "precise").when(has_rough, "coarse").otherwise("none")
    picked = [
        F.when(has_fine, F.col(f"_fine_{v}")).otherwise(F.col(f"_rough_{v}")).alias(v) for v in values
    ]
    return joined.select(*df.columns, *picked, level.alias("match_level"))


def only_new(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``done`` yet."""
    return df.join(done.select(*keys), list(keys), "left_anti")


def missing_ids(df: DataFrame, row_id: str, block: int = 65_536) -> DataFrame:
    """Ids between 1 and the largest id that do not occur.

    One row yields the block numbers, a shuffle spreads them, and each block
    generates its own ids, so the sequence is built in parallel.
    """
    top = df.agg(F.max(F.col(row_id).cast("bigint")).alias("top"))
    blocks = top.filter(F.col("top") >= 1).select(
        "top", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(top - 1) div {block}"))).alias("block")
    )
    start = F.col("block") * block + 1
    ids = blocks.repartition("block").select(
        F.explode(F.sequence(start, F.least(start + (block - 1), F.col("top")))).alias(row_id)
    )
    return ids.join(df.select(F.col(row_id).cast("bigint").alias(row_id)), row_id, "left_anti")


def with_group_average(df: DataFrame, detail: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Join rows with the average of their details; rows lacking either side's value are dropped."""
    averages = detail.groupBy(key).agg(F.avg(value).alias(name))
    return df.join(averages, key).dropna()


def keep_top_keys(df: DataFrame, ranking: DataFrame, key: str, n: int) -> DataFrame:
    """Rows whose key is among the ``n`` most frequent keys of ``ranking`` (ties by key)."""
    best = (
        ranking.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), key).limit(n).select(key)
    )
    return df.join(F.broadcast(best), key, "left_semi")  # at most n rows


def rank_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, where: Column,
              order: Sequence[Column]) -> DataFrame:
    """Inner join, filter and order."""
    return left.join(right, F.col(left_key) == F.col(right_key)).filter(where).orderBy(*order)
