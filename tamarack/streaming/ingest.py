"""Incremental ingest of manifest lines with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tamarack.schemas import MANIFEST


def manifest_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """New manifest files as a stream of rows."""
    return spark.readStream.schema(MANIFEST).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def fetch_once(rows: DataFrame, event_time: str | None = None, late: str = "7 days") -> DataFrame:
    """Each doc_id once; with an event time, what was seen is forgotten once it is older than ``late``."""
    known = rows.filter("doc_id is not null")
    if event_time is None:
        return known.dropDuplicates(["doc_id"])
    return known.withWatermark(event_time, late).dropDuplicatesWithinWatermark(["doc_id"])


def run(rows: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Write ``transform`` of every batch to Parquet, a folder per batch, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).withColumn("ingested", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
