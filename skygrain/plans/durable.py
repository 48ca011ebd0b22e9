"""Written tables that cut lineage and survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    A machine-local folder is made only for a ``local`` master with nothing configured, as in tests.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    spark.conf.set(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="skygrain-"))
    return spark.conf.get(CHECKPOINT_CONF)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing was written to yet."""
    return f"{shared_dir(spark)}/skygrain/{label}-{uuid.uuid4().hex}"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run within it delete their shuffle files at their end; else these stay until the driver collects garbage."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table of this session that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for an equi-join by sorting, whatever its size: a table whose rows grow with the input is not sent to the driver.

    A written table of two long columns takes some 7 bytes a row on disk, which is what Spark plans by, and over 100 in
    the hash table of a broadcast, which the driver builds; a plan may hold several.
    """
    return df.hint("merge")


def materialize(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Parquet rather than ``checkpoint()``: later passes read only the columns they name. With ``free`` the shuffle files
    of the write are deleted at its end, as the written table stands in for them.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with freed(spark) if free else nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
