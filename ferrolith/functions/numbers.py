"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_number(value: Column, kind: str = "double") -> Column:
    """Cast that yields NULL for text that is not a number."""
    return value.try_cast(kind)


def is_free(price: Column) -> Column:
    """True when a price text is missing or zero; False for anything else, also bad text."""
    zero = F.coalesce(as_number(price) == 0, F.lit(False))
    return price.isNull() | zero


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole * 100``; NULL when ``whole`` is not positive."""
    ratio = F.when(whole > 0, F.try_divide(part.cast("double"), whole.cast("double")) * 100)
    return ratio if digits is None else F.round(ratio, digits)


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole != 0, F.try_divide(part.cast("double"), whole.cast("double")))


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit a value to [low, high]; NULL stays NULL."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def round_half_even(value: Column, digits: int = 0) -> Column:
    """Scale, round half to even, scale back (what array libraries do)."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ordered_label(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first rule that holds."""
    label = None
    for condition, name in rules:
        label = F.when(condition, name) if label is None else label.when(condition, name)
    return label if otherwise is None else label.otherwise(otherwise)


def below_label(value: Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label by ascending exclusive upper limits."""
    return ordered_label([(value < limit, name) for limit, name in limits], otherwise)


def right_closed_bin(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``(e0, e1], (e1, e2] …``; a value outside, or equal to the first edge, is NULL."""
    rules = [
        ((value > low) & (value <= high), label)
        for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True)
    ]
    return ordered_label(rules)


def code_label(code: Column, labels: dict) -> Column:
    """Map codes to labels; unknown codes become NULL."""
    return ordered_label([(code == F.lit(k), v) for k, v in labels.items()])


def price_interval(price: Column, margin: float = 0.15) -> Column:
    """Struct (low, high, method): price ± margin, floored at zero, half-even 2 decimals."""
    spread = price * F.lit(margin)
    return F.struct(
        round_half_even(F.greatest(F.lit(0.0), price - spread), 2).alias("low"),
        round_half_even(price + spread, 2).alias("high"),
        F.lit(f"±{margin:.0%} empirical margin").alias("method"),
    )


def box_area(width: Column, height: Column) -> Column:
    return width * height


def box_ratio(width: Column, height: Column) -> Column:
    """Width over height, 0 for a flat box."""
    return F.when(height > 0, F.try_divide(width, height)).otherwise(F.lit(0.0))


def percent_text(value: Column) -> Column:
    """``0.1234`` as ``12.34%``."""
    return F.format_string("%.2f%%", value * 100)
