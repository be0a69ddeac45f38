"""Written intermediate tables: cut lineage once, survive executor loss, never stay machine-local.

A staged table is ordinary Parquet below the folder that the session names in
``spark.checkpoint.dir``. Only a local session without that setting falls back to a
temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000

_local_dir: str | None = None
_written: list[str] = []


def staging_dir(spark: SparkSession) -> str:
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="tidedock-stage-")
    return _local_dir


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path in the staging folder that ``release_staged`` will delete."""
    path = f"{staging_dir(spark)}/{name}"
    _written.append(path)
    return path


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_small(df: DataFrame, name: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Write ``df`` and mark it for broadcast only if its counted size allows that."""
    written = stage(df, name)
    return F.broadcast(written) if written.count() <= limit else written


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this process has staged, once nothing reads them any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    count = 0
    while _written:
        target = jvm.org.apache.hadoop.fs.Path(_written.pop())
        count += bool(target.getFileSystem(conf).delete(target, True))
    return count
