"""File readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrolith.functions import numbers

ANNOTATION_SCHEMA = """
imagePath string, imageHeight int, imageWidth int,
lps array<struct<lp_id: string, poly_coord: array<array<int>>,
  characters: array<struct<char_id: string, bbox_coord: array<array<int>>>>>>
"""
FORECAST_SCHEMA = """
city string, latitude double, longitude double,
list array<struct<main: struct<temp: double>, pop: double, rain: struct<`3h`: double>>>
"""


def read_json(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Typed JSON. One record per line is splittable; ``multi_line`` reads each file in one task.

    Records that do not parse keep their text in ``_corrupt_record``.
    """
    return (
        spark.read.schema(f"{schema.strip()}, _corrupt_record string")
        .option("multiLine", multi_line).option("mode", "PERMISSIVE").json(path)
    )


def read_csv(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8", sep: str = ",") -> DataFrame:
    """Typed CSV with a header; ``encoding="ISO-8859-1"`` reads legacy files."""
    return (
        spark.read.schema(schema).option("header", True).option("encoding", encoding)
        .option("sep", sep).option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path)
    )


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str],
              split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A database table; ``split`` = (column, low, high, parts) reads it in parallel."""
    if split is None:
        return spark.read.jdbc(url, table, properties=properties)
    column, low, high, parts = split
    return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high,
                           numPartitions=parts, properties=properties)


def read_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Label lines ``class x_center y_center width height``; short and non-numeric lines are skipped."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.split(F.trim("value"), r"\s+").alias("parts"))
    names = ("class", "x_center", "y_center", "width", "height")
    fields = [numbers.as_number(F.get("parts", F.lit(i))).alias(name) for i, name in enumerate(names)]
    boxes = lines.filter(F.size("parts") >= 5).select("file", *fields).dropna(subset=list(names))
    width, height = F.col("width"), F.col("height")
    return boxes.withColumns({
        "class": F.col("class").cast("int"), "area": numbers.box_area(width, height),
        "ratio": numbers.box_ratio(width, height)})


def read_plate_annotations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ANNOTATION_SCHEMA).option("multiLine", True).json(path)


def plates(annotations: DataFrame) -> DataFrame:
    """One row per plate with the corners of its outline."""
    return annotations.select(
        F.col("imagePath").alias("image"), "imageWidth", "imageHeight", F.posexplode("lps").alias("plate_index", "plate")
    ).select("image", "plate_index", F.col("plate.lp_id").alias("plate"), *_extent(F.col("plate.poly_coord")),
             F.size("plate.characters").alias("n_characters"))


def characters(annotations: DataFrame) -> DataFrame:
    """One row per character of each plate."""
    unfolded = annotations.select(F.col("imagePath").alias("image"), F.posexplode("lps").alias("plate_index", "plate"))
    each = unfolded.select("image", "plate_index", F.posexplode("plate.characters").alias("char_index", "char"))
    return each.select("image", "plate_index", "char_index", F.col("char.char_id").alias("char"),
                       *_extent(F.col("char.bbox_coord")))


def _extent(points: Column) -> list[Column]:
    xs = F.transform(points, lambda p: p[0])
    ys = F.transform(points, lambda p: p[1])
    return [F.array_min(xs).alias("x1"), F.array_min(ys).alias("y1"),
            F.array_max(xs).alias("x2"), F.array_max(ys).alias("y2")]


def file_inventory(spark: SparkSession, folder: str, glob: str = "*",
                   splits: Sequence[str] = ("train", "valid", "test")) -> DataFrame:
    """Path, size, extension, kind and split of the files below a folder; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        .load(folder).select("path", "length")
    )
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    kind = F.when(extension.isin("jpg", "jpeg", "png"), "image").when(
        (extension == "txt") & F.contains(F.col("path"), F.lit("/labels/")), "label").otherwise("other")
    split = numbers.ordered_label([(F.contains(F.col("path"), F.lit(f"/{s}/")), s) for s in splits])
    return listed.withColumns({"extension": extension, "kind": kind, "split": split})


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded images: path, width, height, channels, pixels."""
    return spark.read.format("image").option("dropInvalid", True).load(folder).select(
        F.col("image.origin").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"), F.col("image.data").alias("pixels"))
