"""Streaming scans over folders of parquet files.

The reference's in-process random generators are not rebuilt; a stream is a
folder that receives event files.  ``max_files`` bounds each micro-batch.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.functions.time import event_time
from clickflow.schemas import DRIVER_EVENTS


def stream_table(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_events(spark: SparkSession, path: str, max_files: int | None = None,
                  schema=DRIVER_EVENTS) -> DataFrame:
    """Driver-shaped event files as a stream, with ``ts`` as an event-time TIMESTAMP.

    Watermarks refuse TIMESTAMP_NTZ, so ``ts`` is converted to the instant
    with the same UTC reading (window alignment stays the batch one).
    """
    return stream_table(spark, path, schema, max_files).withColumn("ts", event_time("ts"))
