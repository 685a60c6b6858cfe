"""Incremental snapshots: entities resolved after every batch of chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def snapshot_stream(chunks: DataFrame, extract: Callable[[DataFrame], DataFrame], resolve: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start a query that, after each batch, stores the extracted rows and rewrites the resolved snapshot of all rows so far.

    ``folder/raw/batch=n`` holds what a batch extracted (overwritten when a batch is
    repeated, so a restart neither loses nor doubles rows) and ``folder/snapshot_n``
    the entities resolved from all batches up to n.
    """
    spark: SparkSession = chunks.sparkSession

    def each(batch: DataFrame, n: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{folder}/raw/batch={n}")
        so_far = spark.read.parquet(f"{folder}/raw").where(f"batch <= {n}").drop("batch")
        resolve(so_far).write.mode("overwrite").parquet(f"{folder}/snapshot_{n}")

    writer = chunks.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
