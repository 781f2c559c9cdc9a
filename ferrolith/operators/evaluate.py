"""Model evaluation over scored rows.

Every metric is an aggregate. Curves are built from score totals, not from a
global sort of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ferrolith.operators.ordering import running_totals

# Threshold grids of the reports (first, step, count).
GRID_FINE = (0.3, 0.005, 60)
GRID_COARSE = (0.3, 0.02, 15)


def linear_grid(first: float, last: float, count: int) -> tuple[float, float, int]:
    """Evenly spaced grid that includes both ends."""
    return first, (last - first) / (count - 1), count


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """R², RMSE and MAE."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = y - p
    return df.groupBy(*by).agg(
        (F.lit(1.0) - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.count("*").alias("n"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(actual, predicted).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages and accuracy.

    Works on the confusion counts, so its cost is the number of classes.
    """
    cells = confusion(df, actual, predicted)
    sides = cells.select(F.explode(F.array(
        F.struct(F.col(actual).cast("string").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("guessed"),
                 F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col(predicted).cast("string").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("guessed"),
                 F.lit(0).cast("bigint").alias("hit")),
    )).alias("s")).select("s.*")
    totals = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hit")])
    precision, recall = _share("hit", "guessed"), _share("hit", "support")
    classes = totals.select(
        "label", precision.alias("precision"), recall.alias("recall"),
        _f1(F.col("hit"), F.col("guessed") - F.col("hit"), F.col("support") - F.col("hit")).alias("f1"),
        "support", "hit")
    metrics = ("precision", "recall", "f1")
    macro = classes.agg(F.lit("macro avg").alias("label"), *[F.avg(m).alias(m) for m in metrics], F.sum("support").alias("support"))
    weighted = classes.agg(F.lit("weighted avg").alias("label"), *[
        (F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in metrics], F.sum("support").alias("support"))
    hit_rate = F.sum("hit") / F.sum("support")
    accuracy = classes.agg(F.lit("accuracy").alias("label"), *[hit_rate.alias(m) for m in metrics], F.sum("support").alias("support"))
    return classes.drop("hit").unionByName(macro).unionByName(weighted).unionByName(accuracy)


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(tp * F.lit(2.0), tp * 2 + fp + fn), F.lit(0.0))


def binary_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1."""
    y, p = F.col(actual) == 1, F.col(predicted) == 1
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y == p).alias("right"))
    return counts.select(
        *by, _share("right", "n").alias("accuracy"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")), F.lit(0.0)).alias("recall"),
        _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"))


def roc_auc(df: DataFrame, actual: str, score: str) -> DataFrame:
    """Area under the ROC curve; tied scores count half.

    Rows are summed per score first; running totals over the scores then say
    how many negatives lie below each one. NULL when one class is missing.
    """
    per_score = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg"))
    ranked = running_totals(per_score, "score", ["neg"])
    below = (F.col("cum_neg") - F.col("neg")).cast("double") + F.col("neg") / 2.0
    wins = F.sum(F.col("pos") * below)
    return ranked.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def threshold_sweep(df: DataFrame, actual: str, score: str, grid: tuple[float, float, int] = GRID_FINE,
                    by: Sequence[str] = ()) -> DataFrame:
    """F1 at every threshold of an even grid; ``is_best`` marks the first maximum.

    A row is counted once, at the highest threshold it still passes. One
    aggregate with at most grid + 1 groups replaces one job per threshold.
    """
    first, step, count = grid
    s = F.col(score).cast("double")
    at = lambda i: F.lit(first) + i * F.lit(step)
    guess = F.floor((s - first) / F.lit(step))
    slot = F.when(at(guess + 1) <= s, guess + 1).when(at(guess) > s, guess - 1).otherwise(guess)
    passed = F.greatest(F.lit(-1), F.least(F.lit(count - 1), slot)).cast("int")
    counts = df.groupBy(*by, passed.alias("slot")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg"))
    group = list(by) or ["_all"]
    if not by:
        counts = counts.withColumn("_all", F.lit(1))
    totals = counts.groupBy(*group).agg(F.sum("pos").alias("positives"))
    slots = totals.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    above = W.partitionBy(*group).orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = slots.join(counts, [*group, "slot"], "left").withColumns({
        "tp": F.coalesce(F.sum("pos").over(above), F.lit(0)), "fp": F.coalesce(F.sum("neg").over(above), F.lit(0))})
    scored = filled.withColumns({
        "fn": F.col("positives") - F.col("tp"), "threshold": at(F.col("slot"))})
    scored = scored.withColumn("f1", _f1(F.col("tp"), F.col("fp"), F.col("fn")))
    best = F.row_number().over(W.partitionBy(*group).orderBy(F.desc("f1"), "slot"))
    return scored.select(*by, "threshold", "tp", "fp", "fn", "f1", (best == 1).alias("is_best"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    return sweep.filter("is_best").drop("is_best")


def compare_models(metrics: DataFrame, model: str, by: str) -> DataFrame:
    """All models with the winner marked (largest metric, ties by name)."""
    best = metrics.select(F.max_by(model, F.col(by))).scalar()
    return metrics.withColumn("is_best", F.col(model) == best)


def audit(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Absolute error and correctness per prediction."""
    return df.withColumns({
        "abs_error": F.abs(F.col(predicted) - F.col(actual)), "correct": F.col(predicted) == F.col(actual)})


def first_errors(audited: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return audited.filter(~F.col("correct")).orderBy(*order).limit(n)
