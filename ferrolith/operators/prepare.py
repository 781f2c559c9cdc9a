"""Splits, encoders and scalers as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import numbers
from ferrolith.operators.ordering import exact_quantiles, random_rank


def holdout(df: DataFrame, row_id: str, test_share: float = 0.2, seed: int = 42,
            by: Sequence[str] = ()) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(test_share × size)`` random rows, per stratum in ``by``."""
    ranked = random_rank(df, row_id, seed, by, "_rank")
    sizes = df.groupBy(*by).agg(F.count("*").alias("_size"))
    sized = ranked.join(sizes, list(by)) if by else ranked.withColumn("_size", sizes.scalar())
    return sized.withColumn("is_test", F.col("_rank") <= F.ceil(F.col("_size") * F.lit(test_share))).select(
        *df.columns, "is_test")


def folds(df: DataFrame, row_id: str, k: int = 5, seed: int = 42, by: Sequence[str] = ()) -> DataFrame:
    """Add ``fold`` 0 … k-1; fold sizes differ by at most one row per stratum."""
    ranked = random_rank(df, row_id, seed, by, "_rank")
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))


def label_codes(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Sorted distinct values over all frames with codes 0, 1, 2 … (``column``, ``code``)."""
    from ferrolith.operators.ordering import sequential_ids

    values = frames[0].select(column)
    for frame in frames[1:]:
        values = values.unionByName(frame.select(column))
    coded = sequential_ids(values.filter(F.col(column).isNotNull()).distinct(), column, "code")
    return coded.withColumn("code", (F.col("code") - 1).cast("int"))


def encode_labels(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    return df.join(codes.withColumnRenamed("code", name), column, "left")


def fill_and_scale(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Mean-fill and standardise with the population deviation (constant columns become 0).

    Statistics come from ``fit_on`` (default: ``df``). After mean filling the
    deviation is that of the filled column.
    """
    base = df if fit_on is None else fit_on
    scaled = {}
    for column in columns:
        mean = base.select(F.avg(column)).scalar()
        filled = base.select(F.sqrt(F.var_pop(column) * F.count(column) / F.count("*"))).scalar()
        value = F.coalesce(F.col(column).cast("double"), mean)
        scaled[column] = F.coalesce(F.try_divide(value - mean, filled), F.lit(0.0))
    return df.withColumns(scaled)


def fill_most_frequent(df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULL with the most frequent value (smallest of equals)."""
    base = df if fit_on is None else fit_on
    for column in columns:
        counts = base.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
        mode = counts.orderBy(F.desc("_n"), column).limit(1).select(column).scalar()
        df = df.withColumn(column, F.coalesce(F.col(column), mode))
    return df


def visit_features(df: DataFrame) -> DataFrame:
    """Ratio, product and activity flag of pages and age."""
    pages, age = F.col("total_pages_visited"), F.col("age")
    return df.withColumns({
        "pages_per_age": pages / (age + 0.1), "interaction_age_pages": age * pages,
        "is_active": (pages > 2).cast("int")})


# Weights of the rule score.
RULE_WEIGHTS = (0.4, 0.4, 0.2)


def rule_score(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Rule score from quantiles of ``reference``: few pages, high ratio, low product."""
    high = exact_quantiles(reference, "pages_per_age", [0.75]).scalar()
    low = exact_quantiles(reference, "interaction_age_pages", [0.25]).scalar()
    few, dense, small = RULE_WEIGHTS
    score = (
        F.when(F.col("total_pages_visited") <= 2, few).otherwise(0.0)
        + F.when(F.col("pages_per_age") > high, dense).otherwise(0.0)
        + F.when(F.col("interaction_age_pages") < low, small).otherwise(0.0)
    )
    return df.withColumn("rule_score", score)


def boosted_score(probability: str, weight: float = 0.15):
    """Probability plus weighted rule score, limited to [0, 1]."""
    return numbers.clip(F.col(probability) + F.col("rule_score") * weight, 0.0, 1.0)
