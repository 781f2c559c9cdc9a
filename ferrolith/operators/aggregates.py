"""Grouped statistics.

NULL groups are left out (``keep_null`` brings them back where offered).
Everything is a two-phase hash aggregate; exact quantiles go through
:mod:`ferrolith.operators.ordering`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import numbers
from ferrolith.operators.ordering import exact_quantiles


def present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without NULL in ``columns``."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def group_counts(df: DataFrame, keys: Sequence[str], name: str = "n", keep_null: bool = False) -> DataFrame:
    """Row count per key, largest first (ties by key)."""
    rows = df if keep_null else present(df, keys)
    return rows.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys)


def shares(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count and percentage of the total per key."""
    counts = present(df, keys).groupBy(*keys).agg(F.count("*").alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("pct", numbers.percent(F.col("n"), total))


def imbalance(df: DataFrame, key: str) -> DataFrame:
    """Largest over smallest class size."""
    counts = present(df, [key]).groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(
        F.max("n").alias("majority"), F.min("n").alias("minority"),
        F.try_divide(F.max("n").cast("double"), F.min("n").cast("double")).alias("imbalance_ratio"),
    )


def means(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of several columns per group."""
    return present(df, by).groupBy(*by).agg(*[F.avg(c).alias(c) for c in columns])


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), quartiles: bool = False) -> DataFrame:
    """Long summary: one row per (group, column) with count, mean, std, min, max and quartiles."""
    long = present(df, by).unpivot(list(by), [_as_double(c) for c in columns], "column", "value")
    keys = [*by, "column"]
    stats = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    if quartiles:
        marks = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys)
        stats = stats.join(marks, keys, "left")
    return stats


def _as_double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-null count, distinct values, most frequent value (ties: smallest) and its count."""
    long = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "value")
    counts = present(long, ["value"]).groupBy("column", "value").agg(F.count("*").alias("n"))
    best = F.row_number().over(_window("column", F.desc("n"), "value"))
    top = counts.withColumn("_rank", best).filter(F.col("_rank") == 1).select("column", F.col("value").alias("top"))
    sizes = counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), F.max("n").alias("freq"))
    return sizes.join(top, "column")


def _window(key: str, *order):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count and share per column, from one pass over the rows."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot(["rows"], list(columns), "column", "missing").withColumn(
        "missing_pct", numbers.percent(F.col("missing"), F.col("rows"))
    )


def true_premium(df: DataFrame, flags: Sequence[str], value: str) -> DataFrame:
    """Mean value with a flag minus mean value without it, one row per flag, largest first."""
    def gap(flag: str) -> Column:
        return F.avg(F.when(F.col(flag), F.col(value))) - F.avg(F.when(~F.col(flag), F.col(value)))

    return (
        df.agg(*[gap(f).alias(f) for f in flags]).unpivot([], list(flags), "feature", "delta")
        .orderBy(F.desc("delta"), "feature")
    )


def availability(df: DataFrame, key: str, row_id: str, flags: Mapping[str, Column], minimum: int = 0) -> DataFrame:
    """Rows with a flag over *distinct ids*, per key, as ``pct_<flag>``.

    An id that occurs twice under one key counts twice above and once below,
    so the rate can pass 100; ``pct_ids_<flag>`` counts distinct ids on both sides.
    """
    ids = F.count_distinct(row_id)
    rates = []
    for name, flag in flags.items():
        rates.append(numbers.percent(F.count_if(flag), ids).alias(f"pct_{name}"))
        rates.append(numbers.percent(F.count_distinct(F.when(flag, F.col(row_id))), ids).alias(f"pct_ids_{name}"))
    rated = present(df, [key]).groupBy(key).agg(ids.alias("ids"), *rates)
    return rated.filter(F.col("ids") >= minimum)


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    a = F.when(both, x.cast("double"))
    b = F.when(both, y.cast("double"))
    n = F.count(a)
    mixed = F.covar_pop(a, b)
    spread = F.sqrt(F.var_pop(a) * F.var_pop(b))
    return F.when((n > 1) & (F.min(a) < F.max(a)) & (F.min(b) < F.max(b)), F.try_divide(mixed, spread))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long correlation matrix (both triangles and the diagonal) from a single aggregate row."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    row = df.agg(*[correlation(F.col(a), F.col(b)).alias(f"{a}|{b}") for a, b in pairs])
    half = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr").select(
        F.split_part("pair", F.lit("|"), F.lit(1)).alias("x"),
        F.split_part("pair", F.lit("|"), F.lit(2)).alias("y"), "corr",
    )
    mirrored = half.select(F.explode(F.array(
        F.struct(F.col("x").alias("x"), F.col("y").alias("y"), F.col("corr").alias("corr")),
        F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col("corr").alias("corr")),
    )).alias("cell")).select("cell.*")
    spread = [F.min(c) < F.max(c) for c in columns]
    own = df.agg(*[F.when(s, F.lit(1.0)).alias(c) for s, c in zip(spread, columns)])
    diagonal = own.unpivot([], list(columns), "x", "corr").select("x", F.col("x").alias("y"), "corr")
    return mirrored.unionByName(diagonal)


def target_correlations(df: DataFrame, columns: Sequence[str], target: str, group: str,
                        together: bool = True) -> DataFrame:
    """Correlation of each column with ``target`` per group, as rows (group, column, corr).

    ``together`` drops a row when any listed column is NULL; otherwise each
    pair drops its own NULL rows.
    """
    rows = present(df, [*columns, target] if together else [])
    wide = present(rows, [group]).groupBy(group).agg(
        *[correlation(F.col(c), F.col(target)).alias(c) for c in columns])
    return wide.unpivot([group], list(columns), "column", "corr")


def category_report(df: DataFrame, value: str, categories: Sequence[str]) -> DataFrame:
    """One row of statistics with a map category → median for each category column."""
    tagged = df.select(
        F.col(value).cast("double").alias("value"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("name")) for c in categories
        ])).alias("category"),
    ).select("value", "category.*")
    medians = exact_quantiles(tagged, "value", [0.5], ["kind", "name"])
    whole = exact_quantiles(df.select(F.col(value).cast("double").alias("value")), "value", [0.5])
    maps = medians.agg(*[
        F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("kind") == c, F.struct("name", F.col("q_50").alias("median")))))).alias(f"by_{c}")
        for c in categories
    ])
    stats = df.agg(
        F.count("*").alias("total"), F.avg(value).alias("mean"), F.min(value).alias("min"),
        F.max(value).alias("max"), F.stddev_samp(value).alias("std"),
    )
    return stats.select(
        "*", whole.scalar().alias("median"), *[maps.select(f"by_{c}").scalar().alias(f"by_{c}") for c in categories]
    )


def hit_summary(files: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """Files processed, files with at least one hit, hits, and the two ratios."""
    per_file = hits.groupBy(key).agg(F.count("*").alias("_hits"))
    joined = files.select(key).join(per_file, key, "left")
    total, found = F.count("*"), F.count("_hits")
    return joined.agg(
        total.alias("files"), found.alias("files_with_hits"), F.coalesce(F.sum("_hits"), F.lit(0)).alias("hits"),
        numbers.percent(found, total).alias("detection_rate"),
        F.try_divide(F.coalesce(F.sum("_hits"), F.lit(0)).cast("double"), total.cast("double")).alias("hits_per_file"),
    )


def latency_summary(df: DataFrame, seconds: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean latency and throughput (1 / mean)."""
    return df.groupBy(*by).agg(
        F.avg(seconds).alias("mean_seconds"), F.try_divide(F.lit(1.0), F.avg(seconds)).alias("per_second"))


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"))
