"""Row-format text sink (one UTF-8 line per row), optionally bucketed by the
hour of arrival like the reference's default bucket assigner.

Spark commits a streaming file sink per micro-batch through its checkpoint
(stronger than the reference, whose parts stay in progress without
checkpoints).  Rolling: a new part per micro-batch (the trigger interval plays
the roll-over interval) and ``max_records_per_file`` caps part size; there is
no idle-time roll.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.session import checkpoint_subdir

# Fixed value: the hourly bucket folder format of the reference's file sink.
BUCKET_FORMAT = "yyyy-MM-dd--HH"


def arrival_bucket(col: Column | None = None) -> Column:
    """Hour bucket of the arrival (processing) time, or of ``col``."""
    return F.date_format(F.current_timestamp() if col is None else col, BUCKET_FORMAT)


def _shape(df: DataFrame, text_col: str, bucket: bool, partition_by=()) -> tuple[DataFrame, list[str]]:
    cols = [F.col(text_col).cast("string").alias("value"), *[F.col(c) for c in partition_by]]
    parts = list(partition_by)
    if bucket:
        cols.append(arrival_bucket().alias("bucket"))
        parts = ["bucket"]
    return df.select(*cols), parts


def write_text(df: DataFrame, path: str, text_col: str = "value", mode: str = "append", bucket: bool = False,
               max_records_per_file: int | None = None, partition_by=()) -> None:
    """``partition_by`` writes e.g. all routed branches at once, one folder per ``route``."""
    out, parts = _shape(df, text_col, bucket, partition_by)
    w = out.write.mode(mode).option("encoding", "UTF-8")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        w = w.partitionBy(*parts)
    w.text(path)


def stream_text(df: DataFrame, path: str, text_col: str = "value", checkpoint: str | None = None,
                bucket: bool = True, trigger: str = "15 minutes", max_records_per_file: int | None = None,
                available_now: bool = False, partition_by=()):
    """Start a streaming text sink; returns the StreamingQuery."""
    out, parts = _shape(df, text_col, bucket, partition_by)
    ckpt = checkpoint or checkpoint_subdir(df.sparkSession, "text-sink-" + path.strip("/").replace("/", "_"))
    w = out.writeStream.format("text").option("path", path).option("checkpointLocation", ckpt).outputMode("append")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        w = w.partitionBy(*parts)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
