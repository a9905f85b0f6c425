"""Session helpers: where intermediate tables live and how they are written."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

_LOCAL_SCRATCH: list[str] = []
_WRITTEN: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    without that setting falls back to a temporary folder, which goes when the
    process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not _LOCAL_SCRATCH:
        _LOCAL_SCRATCH.append(tempfile.mkdtemp(prefix="quipu-"))
        atexit.register(shutil.rmtree, _LOCAL_SCRATCH[0], ignore_errors=True)
    return _LOCAL_SCRATCH[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    path = os.path.join(scratch_dir(spark), f"quipu-{label}-{uuid.uuid4().hex}")
    _WRITTEN.append(path)
    return path


@contextmanager
def scratch_job(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what the job inside has written to the shared folder.

    The job's results must be written elsewhere by then, for instance published.
    """
    before = len(_WRITTEN)
    try:
        yield
    finally:
        for path in _WRITTEN[before:]:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        del _WRITTEN[before:]


def settle(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a result feeds several later jobs: it is computed once, its
    lineage ends at durable files, and losing an executor costs no recompute.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spill_cache(df: DataFrame) -> DataFrame:
    """Keep a frame that an iterative Spark ML solver scans many times."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def on_all_tasks(df: DataFrame, small: int = 0) -> DataFrame:
    """Spread an input that its splits leave to too few tasks, before costly work per row.

    Few splits are little data, which is cheap to move.  Of many splits most may hold no
    rows: all rows of a row group go to the split with its middle, so a large file of one
    row group is the work of one task.  So the rows of the splits are counted, and spread
    if their waves would take over half as long again as even ones.  Else they stay where
    they are, as do splits of at most ``small`` rows.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    if splits >= tasks or small:
        held = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count(F.lit(1)).alias("n"))
        filled, fullest, rows = held.agg(F.count("n"), F.max("n"), F.sum("n")).first()
        if not filled or fullest <= small or 2 * -(-filled // tasks) * fullest * tasks <= 3 * rows:
            return df
    return df.repartition(tasks * -(-splits // tasks))


def task_count(spark: SparkSession) -> int:
    """Number of partitions for compute-bound steps that byte-based coalescing would starve."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
