"""Image-set profile: split shares, sizes, brightness classes, box statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrolith.functions import numbers
from ferrolith.operators.aggregates import describe, shares

# Upper limits and labels of the brightness classes.
LIGHT_LIMITS = [(60, "Nuit/Très sombre"), (100, "Faible luminosité"), (150, "Luminosité moyenne")]
LIGHT_TOP = "Jour/Bien éclairé"
HARD_LIGHT = ("Nuit/Très sombre", "Faible luminosité")
GREY_WEIGHTS = (0.299, 0.587, 0.114)  # red, green, blue


def light_class(brightness: Column, limits=tuple(LIGHT_LIMITS)) -> Column:
    return numbers.below_label(brightness, limits, LIGHT_TOP)


def _statistics(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    """Mean grey value and variance of the Laplacian per image (blue-green-red bytes)."""
    red, green, blue = GREY_WEIGHTS
    for heights, widths, channels, pixels in batches:
        rows = []
        for h, w, c, data in zip(heights, widths, channels, pixels, strict=True):
            image = np.frombuffer(data, dtype=np.uint8).reshape(int(h), int(w), int(c)).astype(np.float64)
            grey = image[:, :, 0] if c == 1 else image[:, :, 0] * blue + image[:, :, 1] * green + image[:, :, 2] * red
            inner = grey[1:-1, 1:-1]
            edges = grey[:-2, 1:-1] + grey[2:, 1:-1] + grey[1:-1, :-2] + grey[1:-1, 2:] - 4 * inner
            rows.append((float(grey.mean()), float(edges.var()) if edges.size else 0.0))
        yield pd.DataFrame(rows, columns=["brightness", "sharpness"])


def with_light(images: DataFrame) -> DataFrame:
    """Add brightness, sharpness and the brightness class. Arrow batches; the pixels are dropped."""
    measure = F.pandas_udf(_statistics, "brightness double, sharpness double")
    measured = images.withColumn("_m", measure("height", "width", "channels", "pixels"))
    return measured.select(
        *[c for c in images.columns if c != "pixels"], "_m.brightness", "_m.sharpness"
    ).withColumn("light", light_class(F.col("brightness")))


def split_shares(inventory: DataFrame) -> DataFrame:
    return shares(inventory.filter(F.col("kind") == "image"), ["split"])


def size_summary(images: DataFrame) -> DataFrame:
    sized = images.withColumn("ratio", F.col("width") / F.col("height"))
    return describe(sized, ["width", "height", "ratio"])


def hard_light_share(lit: DataFrame) -> DataFrame:
    return lit.agg(
        F.count("*").alias("images"), F.avg("brightness").alias("mean_brightness"),
        numbers.percent(F.count_if(F.col("light").isin(*HARD_LIGHT)), F.count("*")).alias("hard_pct"))


def box_summary(boxes: DataFrame) -> DataFrame:
    return boxes.agg(
        F.count("*").alias("n"), *[F.avg(c).alias(c) for c in ("width", "height", "area", "ratio")])
