"""The tables behind charts: histograms, box plots, trend lines, bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.operators.aggregates import present
from ferrolith.operators.ordering import exact_quantiles


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins between the smallest and the largest value; the last bin is closed."""
    rows = present(df, [value, *by])
    low = rows.select(F.min(value).cast("double")).scalar()
    high = rows.select(F.max(value).cast("double")).scalar()
    width = (high - low) / F.lit(float(bins))
    place = F.floor((F.col(value) - low) / F.nullif(width, F.lit(0.0)))
    slot = F.least(F.lit(bins - 1), F.coalesce(place, F.lit(0))).cast("int")
    counts = rows.groupBy(*by, slot.alias("bin")).agg(F.count("*").alias("n"))
    return counts.withColumns({
        "bin_start": low + F.col("bin") * width,
        "bin_end": low + (F.col("bin") + 1) * width,
    })


def ranged_histogram(df: DataFrame, value: str, low: float, high: float, max_bins: int,
                     by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins over [low, high]; values outside are not shown.

    The width is the smallest of 1, 2, 5 × 10^k that needs at most ``max_bins`` bins.
    """
    width = _round_width((high - low) / max_bins)
    inside = present(df, by).filter((F.col(value) >= low) & (F.col(value) <= high))
    start = F.floor(F.col(value) / width) * width
    return inside.groupBy(*by, start.cast("double").alias("bin_start")).agg(F.count("*").alias("n"))


def _round_width(least: float) -> float:
    size = 1.0
    while size > least:
        size /= 10
    while True:
        for factor in (1, 2, 5):
            if size * factor >= least:
                return size * factor
        size *= 10


def box_stats(df: DataFrame, value: str, by: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values within ``reach`` × IQR) and the outlier count per group."""
    rows = present(df, [*by, value])
    quartiles = exact_quantiles(rows, value, [0.25, 0.5, 0.75], by)
    fenced = quartiles.withColumns({
        "_low": F.col("q_25") - (F.col("q_75") - F.col("q_25")) * reach,
        "_high": F.col("q_75") + (F.col("q_75") - F.col("q_25")) * reach,
    })
    joined = rows.select(*by, value).join(fenced, list(by))
    x = F.col(value)
    inside = (x >= F.col("_low")) & (x <= F.col("_high"))
    return joined.groupBy(*by, "q_25", "q_50", "q_75").agg(
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"), F.count("*").alias("n"))


def outliers(df: DataFrame, value: str, by: Sequence[str], reach: float = 1.5) -> DataFrame:
    """The rows outside the whisker fences."""
    rows = present(df, [*by, value])
    quartiles = exact_quantiles(rows, value, [0.25, 0.75], by)
    spread = F.col("q_75") - F.col("q_25")
    outside = (F.col(value) < F.col("q_25") - spread * reach) | (F.col(value) > F.col("q_75") + spread * reach)
    return rows.join(quartiles, list(by)).filter(outside).select(*df.columns)


def trend_lines(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per group: slope, intercept, R²."""
    rows = present(df, [x, y, *by])
    return rows.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.count("*").alias("n"))


def mean_bands(df: DataFrame, x: str, y: str, z: float = 1.96) -> DataFrame:
    """Mean of ``y`` per ``x`` with a normal confidence band."""
    rows = present(df, [x, y])
    half = F.lit(z) * F.stddev_samp(y) / F.sqrt(F.count(y))
    return rows.groupBy(x).agg(
        F.avg(y).alias("mean"), (F.avg(y) - half).alias("low"), (F.avg(y) + half).alias("high"))


def ordered_counts(df: DataFrame, category: str, hue: str) -> DataFrame:
    """Count per (category, hue) with the category total, largest category first."""
    counts = present(df, [category, hue]).groupBy(category, hue).agg(F.count("*").alias("n"))
    totals = counts.groupBy(category).agg(F.sum("n").alias("total"))
    return counts.join(totals, category).orderBy(F.desc("total"), category, hue)


def map_points(df: DataFrame, place: str, columns: Sequence[str], row: str, order: str, n: int) -> DataFrame:
    """Average position and values per place with the row count; the best ``n`` by ``order``."""
    grouped = df.groupBy(place).agg(*[F.avg(c).alias(c) for c in columns], F.count(row).alias("n"))
    return grouped.orderBy(F.desc(order), place).limit(n)
