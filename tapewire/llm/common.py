"""Staged tables and shared files for the operators of this subpackage."""

from __future__ import annotations

import gc

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tapewire.sources.files import scratch_folder

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: a word is a run of anything but ASCII white space


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that `spark.checkpoint.dir` names; removed when the application ends."""
    folder = scratch_folder(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a staged table that nothing reads any more, and shuffles behind it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    release(spark)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
WIDE_ROWS = 1024  # of documents' texts or sets that a task hands to Python at once


def stage(df: DataFrame, name: str, folder: str | None = None, batch_rows: int | None = None) -> DataFrame:
    """Write `df` once to the shared folder and go on from the files.

    The rows are evaluated once, survive lost executors, and come back without a
    partitioning, so later joins on them have two shuffles that AQE can split. A
    caller that means to remove the table gives its own new `folder`. With `batch_rows`
    Python functions of this step get batches of at most so many rows: a batch of wide
    rows is held by the JVM and by the worker, more than once each.
    """
    spark = df.sparkSession
    folder = folder or shared_folder(spark, name)
    before = spark.conf.get(BATCH_ROWS)
    if batch_rows:
        spark.conf.set(BATCH_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.parquet(folder)
    finally:
        if batch_rows:
            spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(folder)


MOST_TASKS = 20_000  # of one stage; beyond it a task has more than its share


def dealt(ranges: DataFrame, size: str, keys: list[str], each: int) -> DataFrame:
    """Small rows that stand for `size` bytes each, dealt by `keys` over one task per `each` bytes.

    The rows themselves are few and short, so AQE would put them all into one task; a
    stated number of partitions is kept.
    """
    total = ranges.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    return ranges.repartition(min(MOST_TASKS, max(1, -(-int(total) // each))), *keys)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written.

    It does so when the driver's garbage is collected, which a driver with little to
    do may put off for a whole job; a long chain of steps would keep all its shuffles.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


FILTER_BITS = 1 << 26
FILTER_PARTS = 1 << 10


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A filter of fixed size (8 MB) that holds every id of `column`, and by chance some others.

    A task packs the bits of one stretch, so the driver gets at most FILTER_PARTS
    rows of 8 KB however many ids there are.
    """
    stretch = FILTER_BITS // FILTER_PARTS
    place = ids.select(F.pmod(F.xxhash64(column), F.lit(FILTER_BITS)).alias("place")).distinct()

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(stretch, np.uint8)
        bits[rows["place"].to_numpy() % stretch] = 1
        return pd.DataFrame({"part": [int(rows["place"].iloc[0]) // stretch], "bits": [np.packbits(bits).tobytes()]})

    packed = place.groupBy(F.floor(F.col("place") / stretch)).applyInPandas(pack, "part long, bits binary")
    out = np.zeros((FILTER_PARTS, stretch // 8), np.uint8)
    for row in packed.collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def in_filter(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the filter holds the hashed places."""
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)


def open_store(uri: str):
    """pyarrow file system and path of a Hadoop style uri, for use inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)
