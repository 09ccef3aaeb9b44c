"""Incremental jobs with Structured Streaming: history append, resume, upsert.

Each micro-batch writes a folder named by its batch id, from the folders of
earlier batches. A batch that is run again after a failure overwrites its own
folder with the same rows, so every job can be restarted from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from tapewire.operators.dedup import keep_first, unseen, upsert

BatchStep = Callable[[DataFrame, DataFrame | None], DataFrame]


def _earlier(spark: SparkSession, folder: str, schema: StructType, batch_id: int, last_only: bool) -> DataFrame | None:
    """Rows written by earlier batches, or by the last of them."""
    if batch_id == 0:
        return None
    written = spark.read.schema(StructType([*schema.fields]).add("batch", LongType())).parquet(folder)
    wanted = F.col("batch") == batch_id - 1 if last_only else F.col("batch") < batch_id
    return written.where(wanted).drop("batch")


def run_batches(
    source: DataFrame, folder: str, schema: StructType, step: BatchStep, last_only: bool = False
) -> None:
    """Feed all available input through `step(new rows, earlier rows)` and stop."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = _earlier(batch.sparkSession, f"{folder}/table", schema, batch_id, last_only)
        step(batch, before).write.mode("overwrite").parquet(f"{folder}/table/batch={batch_id}")

    query = (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_new(keys: Sequence[str], order: Sequence[str]) -> BatchStep:
    """First row per key in the batch, without the keys already in the history."""

    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        fresh = keep_first(batch, keys, list(order))
        return fresh if before is None else unseen(fresh, before, keys)

    return step


def upsert_into(key: str, order: str, columns: Sequence[str]) -> BatchStep:
    """The whole table after the batch; with no earlier table the batch starts it."""

    def step(batch: DataFrame, before: DataFrame | None) -> DataFrame:
        if before is None:
            return keep_first(batch, [key], [F.desc(order)]).select(*columns)
        return upsert(before, batch, key, order)

    return step


def read_table(spark: SparkSession, folder: str, last_only: bool = False) -> DataFrame:
    """The table so far: all batches, or the newest version."""
    written = spark.read.parquet(f"{folder}/table")
    if last_only:
        written = written.where(F.col("batch") == written.agg(F.max("batch")).first()[0])
    return written.drop("batch")


def arrivals(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)
