"""Ordered computations that stay distributed.

A window without a partition key, or with a key that holds a large share of
the rows, runs in one task. The operators here cut the order into ranges
first: each range is one small window, and only one total per range is
carried over to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE = "_range"


def range_count(df: DataFrame) -> int:
    """Ranges an order is cut into: a few for each shuffle partition of the session, 64 at least and 4096 at most."""
    return min(4096, max(64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def with_ranges(df: DataFrame, order: str, ranges: int | None = None) -> DataFrame:
    """Add ``_range``: the index of the value range ``order`` falls into.

    The limits are quantiles of the column (numbers) or a hash sample of its
    distinct values (anything else), so the ranges hold similar row counts.
    They form one array of at most ``ranges`` values (default: by the session,
    so that a larger cluster gets smaller ranges).
    """
    ranges = ranges or range_count(df)
    kind = dict(df.dtypes)[order]
    numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    if numeric:
        steps = [i / ranges for i in range(1, ranges)]
        limits = df.select(F.percentile_approx(order, steps, ranges * 20).alias("limits"))
    else:
        limits = (
            df.select(order).filter(F.col(order).isNotNull())
            .orderBy(F.xxhash64(order), order).limit(ranges)
            .agg(F.array_sort(F.array_distinct(F.collect_list(order))).alias("limits"))
        )
    # Two steps: which block of limits, then where inside it.
    block = max(1, int(ranges**0.5))
    below = lambda edges: F.size(F.filter(edges, lambda edge: edge < F.col(order)))
    bounds = limits.select(F.struct("limits", F.filter("limits", lambda edge, i: (i + 1) % block == 0).alias("coarse")).alias("b"))
    return (
        df.withColumn("_b", bounds.scalar())
        .withColumn("_block", below(F.col("_b.coarse")) * block)
        # Never NULL, so that a later join on it adds no filter that repeats the search below the aggregate.
        .withColumn(RANGE, F.coalesce(
            F.col("_block") + below(F.slice(F.col("_b.limits"), F.col("_block") + 1, F.lit(block))), F.lit(0)))
        .drop("_b", "_block")
    )


def running_totals(df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (),
                   ranges: int | None = None) -> DataFrame:
    """Add ``cum_<c>``: inclusive running totals in ascending ``order`` within ``by``.

    ``df`` must hold one row per (``by``, ``order``): aggregate ties first.
    Group keys must not be NULL.
    """
    keys = [*by, RANGE]
    # One shuffle by range serves both the window and the range totals.
    ranged = with_ranges(df, order, ranges).repartition(*keys)
    inside = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_in_{c}") for c in sums])
    before = W.partitionBy(*(by or [F.lit(0)])).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(*keys).agg(*[F.sum(c).alias(f"_all_{c}") for c in sums])
        .select(*keys, *[F.coalesce(F.sum(f"_all_{c}").over(before), F.lit(0)).alias(f"_pre_{c}") for c in sums])
    )
    return local.join(carried, keys).select(
        *df.columns, *[(F.col(f"_in_{c}") + F.col(f"_pre_{c}")).alias(f"cum_{c}") for c in sums]
    )


def sequential_ids(df: DataFrame, order: str, name: str, ranges: int | None = None) -> DataFrame:
    """Number the rows 1, 2, 3 … by a unique column, without a one-task sort."""
    numbered = running_totals(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], ranges=ranges)
    return numbered.withColumnRenamed("cum__one", name).drop("_one")


def hash_order(row_id: Column, seed: int) -> Column:
    """Reproducible random order key: md5 of id and seed, the same in any SQL engine."""
    return F.md5(F.concat_ws("#", row_id.cast("string"), F.lit(str(seed))))


def random_rank(df: DataFrame, row_id: str, seed: int, by: Sequence[str] = (),
                name: str = "rank") -> DataFrame:
    """Add the 1-based random rank of each row within ``by``.

    md5 is uniform, so its first three hex digits cut each group into up to
    4096 even slices however large the group is; ranks inside a slice are
    shifted by the sizes of the slices before it.
    """
    keys = [*by, "_slice"]
    hashed = df.withColumn("_hash", hash_order(F.col(row_id), seed)).withColumn(
        "_slice", F.coalesce(F.substring("_hash", 1, 3), F.lit(""))  # not NULL: the join needs no filter
    ).repartition(*keys)
    inside = W.partitionBy(*keys).orderBy("_hash")
    ranked = hashed.withColumn("_pos", F.row_number().over(inside))
    before = W.partitionBy(*(by or [F.lit(0)])).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shift = (
        hashed.groupBy(*keys).agg(F.count("*").alias("_rows"))
        .select(*keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    )
    return ranked.join(shift, keys).select(
        *df.columns, (F.col("_pos") + F.col("_shift")).cast("bigint").alias(name)
    )


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float],
                    by: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group as columns ``q_<percent>``.

    Works on value counts and running totals, so no task holds a whole group.
    NULL values and NULL groups are left out.
    """
    present = df
    for column in [*by, value]:
        present = present.filter(F.col(column).isNotNull())
    group = list(by) or ["_all"]
    if not by:
        present = present.withColumn("_all", F.lit(1))
    counts = present.groupBy(*group, value).agg(F.count("*").alias("n"))
    ranked = running_totals(counts, value, ["n"], group, ranges)
    if by:
        sized = ranked.join(counts.groupBy(*group).agg(F.sum("n").alias("_size")), group)
    else:
        sized = ranked.withColumn("_size", counts.select(F.sum("n")).scalar())
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n")
    picks = []
    for p in probabilities:
        place = (F.col("_size") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            inside = (first <= index) & (index < last)
            picks.append(F.max(F.when(inside, F.col(value).cast("double"))).alias(f"_{side}_{p}"))
    spread = sized.groupBy(*group).agg(F.max("_size").alias("_size"), *picks)
    results = []
    for p in probabilities:
        place = (F.col("_size") - 1) * F.lit(float(p))
        low, high = F.col(f"`_lo_{p}`"), F.col(f"`_hi_{p}`")
        results.append((low + (high - low) * (place - F.floor(place))).alias(f"q_{round(p * 100)}"))
    return spread.select(*by, *results)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by).withColumnRenamed("q_50", name)


def previous_row(df: DataFrame, entity: str, moment: str, row_id: str, carry: Sequence[str],
                 ranges: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` from the entity's previous row in (``moment``, ``row_id``) order.

    Time is cut into ranges that hold about as many rows each, however the rows
    lie in it. Inside a range this is a plain ``lag``; the first row of an entity
    in a range takes its last row of the ranges before, from a table with one
    row per (entity, range).
    """
    keys = [entity, RANGE]
    timed = with_ranges(df.withColumn("_micros", F.unix_micros(F.col(moment).cast("timestamp"))), "_micros", ranges)
    sliced = timed.drop("_micros").repartition(*keys)
    fields = [moment, *[c for c in carry if c != moment]]
    record = F.struct(*fields)
    inside = W.partitionBy(*keys).orderBy(moment, row_id)
    local = sliced.withColumn("_prev", F.lag(record).over(inside))
    lasts = sliced.groupBy(*keys).agg(F.max_by(record, F.struct(moment, row_id)).alias("_last"))
    across = W.partitionBy(entity).orderBy(RANGE)
    carried = lasts.select(*keys, F.lag("_last").over(across).alias("_carried"))
    joined = local.join(carried, keys, "left").withColumn("_prev", F.coalesce("_prev", "_carried"))
    return joined.select(*df.columns, *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in fields])
