"""Session builder and the lineage cut used by iterative operators."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

T, R = TypeVar("T"), TypeVar("R")


def build_session(app: str = "tapewire", master: str | None = None, **settings: str) -> SparkSession:
    """Session with UTC, ANSI and AQE on; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for checkpoints: the one the cluster names, or a scratch one in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from the written rows."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def drop_checkpoint(spark: SparkSession, file: str | None) -> None:
    """Delete the files of a checkpoint that nothing reads any more."""
    if file:
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def side_by_side(work: Callable[[T], R], items: Sequence[T], at_once: int = 8) -> list[R]:
    """Results of `work` for all items in their order, a few Spark jobs at a time."""
    with ThreadPool(min(at_once, max(1, len(items)))) as pool:
        return pool.map(inheritable_thread_target(work), items)
