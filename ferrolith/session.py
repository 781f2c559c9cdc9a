"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def build_session(app: str = "ferrolith", cores: str | int = "*", partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters pass their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL: list[str] = []
_SETTLED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a session on a local master may leave it unset; it then gets a folder
    of this machine. On a cluster an unset folder is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="ferrolith-"))
    return _LOCAL[0]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder once and continue from the files, read as ``schema`` if given.

    Survives executor loss, cuts the lineage of iterative jobs, keeps a plan
    used several times from being computed several times, and later readers
    take only the columns they need. ``clean_up`` removes the files.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    _SETTLED.append(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


#: Rows of a few numbers that may be broadcast (some tens of MB).
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted to hold at most ``rows`` rows, else for a merge join.

    The planner would judge it by the size of its compressed files.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("merge")


def settled() -> list[str]:
    """Folders that ``settle`` has written in this process and nothing has deleted yet."""
    return list(_SETTLED)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders of ``settle`` after their last reader."""
    for name in paths:
        if name in _SETTLED:
            _SETTLED.remove(name)
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clean_up(spark: SparkSession) -> int:
    """Delete every folder ``settle`` wrote in this process; call it when no result is read any more."""
    n = len(_SETTLED)
    remove(spark, settled())
    return n
