"""Writers. All of them write in parallel from the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """CSV with a header, replacing earlier output (also straight to an object store path)."""
    df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Full refresh of a catalog table."""
    df.write.mode("overwrite").saveAsTable(name)


def replace_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], batch: int = 50) -> None:
    """Full refresh of a database table in batches."""
    df.write.mode("overwrite").option("batchsize", batch).jdbc(url, table, properties=properties)


def head_of_table(spark: SparkSession, name: str, n: int = 5) -> DataFrame:
    """First rows of a loaded table, for a look after loading."""
    return spark.table(name).limit(n)
