"""Session-level plumbing: durable stage output and size checks.

A stage that is read more than once is written as Parquet under the shared folder named by
``spark.checkpoint.dir``.  That cuts lineage, survives the loss of any executor, and gives
Catalyst the stage's real size, so it picks broadcast or shuffle joins on measured bytes.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for stage output; a temporary one only when Spark itself is local."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master.split("[")[0] != "local":
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach before running on a cluster"
        )
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="scoreloom-")
    return _LOCAL_ROOTS[app]


def stage_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/scoreloom/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    ``partition_by`` lays the rows out in one folder per value, so a filter on it opens only those.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_row(df: DataFrame) -> Column:
    """A one-row table as a struct-valued scalar subquery, evaluated once and usable in any expression."""
    return df.select(F.struct("*")).scalar()


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; exact file size when ``df`` scans a materialised stage."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 switches broadcasting off)."""
    text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    number = text.rstrip("bkmg")
    return int(float(number) * units.get(text[len(number):], 1))


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)
