"""Session helpers: the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read, taken from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary
    folder. A cluster without the setting is an error, since a machine-local folder
    would be lost with the machine.
    """
    path = spark.conf.get(_CONF, None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder all executors share")
    known = context.getCheckpointDir()
    if known is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="annalist-"))
        known = context.getCheckpointDir()
    return known.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write a new parquet folder.

    A partitioned one is rebalanced first: small partitions get one file instead of one
    per task, and adaptive execution splits a partition that is too large for one.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(path)


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write to a new parquet folder in the shared folder and read it back.

    Cuts the lineage and survives the loss of executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    write_parquet(df, path, partition_by)
    return spark.read.schema(df.schema).parquet(path)
