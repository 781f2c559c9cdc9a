"""Least squares, ridge and lasso from sums of products.

One aggregate gives, for each fold, the counts, sums and cross products of the
scaled inputs and the label. What a fit without some fold needs is the total
less that fold, so a whole cross-validated grid is solved from that small table
and reads the rows once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.models.regression import LASSO_ALPHAS, RIDGE_ALPHAS


def scaled_inputs(train: DataFrame, numeric: Sequence[str], categories: Sequence[str] = ()) -> dict[str, Column]:
    """Model inputs as expressions: numbers filled with the training mean and scaled by the population deviation,
    categories as 0/1 without the first in alphabetical order; a missing category is the most frequent one.

    Statistics come from one pass; the driver gets one row with the category lists.
    """
    asked = [f for c in numeric for f in (
        F.avg(c).alias(f"m_{c}"), F.sqrt(F.var_pop(c) * F.count(c) / F.count("*")).alias(f"s_{c}"))]
    asked += [f for c in categories for f in (
        F.array_sort(F.collect_set(F.col(c).cast("string"))).alias(f"v_{c}"), F.mode(F.col(c).cast("string"), True).alias(f"f_{c}"))]
    row = train.agg(*asked).first()
    out = {}
    for c in numeric:
        mean, spread = row[f"m_{c}"], row[f"s_{c}"]
        scaled = (F.coalesce(F.col(c).cast("double"), F.lit(mean)) - F.lit(mean)) / F.lit(spread) if spread else F.lit(0.0)
        out[c] = scaled
    for c in categories:
        filled = F.coalesce(F.col(c).cast("string"), F.lit(row[f"f_{c}"]))
        out.update({f"{c}_{v}": F.coalesce((filled == v).cast("double"), F.lit(0.0)) for v in row[f"v_{c}"][1:]})
    return out


@dataclass
class Products:
    """Sums of products of (1, inputs, label) with themselves, per fold: an array (folds, p + 2, p + 2)."""

    names: list[str]
    folds: np.ndarray

    @property
    def total(self) -> np.ndarray:
        return self.folds.sum(axis=0)

    def without(self, fold: int) -> np.ndarray:
        return self.total - self.folds[fold]


def products(train: DataFrame, inputs: dict[str, Column], label: str, fold: str | None = None, k: int = 1) -> Products:
    """The sums of ``train`` by ``fold`` (0 … k-1) in one aggregate; rows without a label are left out."""
    columns = [F.lit(1.0), *inputs.values(), F.col(label).cast("double")]
    size = len(columns)
    named = train.filter(F.col(label).isNotNull()).select(
        (F.col(fold) if fold else F.lit(0)).alias("fold"), *[c.alias(f"c{i}") for i, c in enumerate(columns)])
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    rows = named.groupBy("fold").agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"s{i}_{j}") for i, j in pairs]).collect()  # k rows
    sums = np.zeros((k, size, size))
    for row in rows:
        for i, j in pairs:
            sums[row["fold"], i, j] = sums[row["fold"], j, i] = row[f"s{i}_{j}"]
    return Products(list(inputs), sums)


def ridge_weights(s: np.ndarray, alpha: float = 0.0) -> np.ndarray:
    """(intercept, weights) of least squares with ``alpha`` times the squared weights, from one sum table."""
    n, x, y = s[0, 0], s[0, 1:-1], s[0, -1]
    inner = s[1:-1, 1:-1] - np.outer(x, x) / n + alpha * np.eye(len(x))
    weights = np.linalg.lstsq(inner, s[1:-1, -1] - x * y / n, rcond=1e-12)[0]
    return np.concatenate([[(y - weights @ x) / n], weights])


def lasso_weights(s: np.ndarray, alpha: float, start: np.ndarray | None = None, tolerance: float = 1e-13, sweeps: int = 100_000) -> np.ndarray:
    """(intercept, weights) of half the mean squared error plus ``alpha`` times the absolute weights, by coordinate descent."""
    n, x, y = s[0, 0], s[0, 1:-1], s[0, -1]
    inner, cross = s[1:-1, 1:-1] - np.outer(x, x) / n, s[1:-1, -1] - x * y / n
    weights = np.zeros(len(x)) if start is None else start[1:].copy()
    for _ in range(sweeps):
        before = weights.copy()
        for j in np.flatnonzero(np.diag(inner) > 1e-12 * n):
            rest = cross[j] - inner[j] @ weights + inner[j, j] * weights[j]
            weights[j] = np.sign(rest) * max(abs(rest) - n * alpha, 0.0) / inner[j, j]
        if np.abs(weights - before).max(initial=0.0) <= tolerance * max(1.0, np.abs(weights).max(initial=0.0)):
            break
    return np.concatenate([[(y - weights @ x) / n], weights])


def r2_of(s: np.ndarray, weights: np.ndarray) -> float:
    """R² of a model on the rows behind a sum table."""
    w = np.append(weights, -1.0)
    return 1.0 - float(w @ s @ w) / float(s[-1, -1] - s[0, -1] ** 2 / s[0, 0])


def grid_r2(sums: Products, alphas: Sequence[float], lasso: bool = False) -> list[float]:
    """Mean R² over the folds of each penalty, in the order given; the lasso starts from the next larger penalty."""
    k, found = len(sums.folds), dict.fromkeys(alphas, 0.0)
    for fold in range(k):
        inside, weights = sums.without(fold), None
        for alpha in sorted(alphas, reverse=True):
            weights = lasso_weights(inside, alpha, weights) if lasso else ridge_weights(inside, alpha)
            found[alpha] += r2_of(sums.folds[fold], weights) / k
    return [found[a] for a in alphas]


def chosen(sums: Products, lasso: bool = False, alphas: Sequence[float] | None = None) -> tuple[np.ndarray, float]:
    """(weights fitted on all folds, penalty) of the penalty with the highest mean R²; of equal ones the first."""
    grid = alphas or (LASSO_ALPHAS if lasso else RIDGE_ALPHAS)
    scores = grid_r2(sums, grid, lasso)
    alpha = grid[scores.index(max(scores))]
    return (lasso_weights if lasso else ridge_weights)(sums.total, alpha), alpha


def predicted(inputs: dict[str, Column], weights: np.ndarray) -> Column:
    total = F.lit(float(weights[0]))
    for column, weight in zip(inputs.values(), weights[1:], strict=True):
        total = total + column * F.lit(float(weight))
    return total
