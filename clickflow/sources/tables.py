"""Batch scans of the parquet tables.

Scans return plain lazy DataFrames: column pruning and filter pushdown into
the parquet reader are left to Catalyst, so callers should select and filter
after the scan rather than materialise anything here.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.time import millis_of

# Driver event mapping: the app side of a payment pair is a click, the
# third-party side a purchase (both keyed by user).
APP_TYPE = "click"
THIRD_TYPE = "purchase"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def as_click_events(events: DataFrame) -> DataFrame:
    """Driver events in the reference's Event shape: user, action, times (ms).

    ``event_id`` is kept because per-key sequences are ordered by (ts, event_id).
    """
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user"),
        F.col("event_type").alias("action"),
        millis_of(events, "ts").alias("times"),
    )


def app_side(events: DataFrame) -> DataFrame:
    """App payments: click events.  The filter reaches the parquet scan."""
    return events.where(F.col("event_type") == APP_TYPE).select("user_id", "event_id", "ts")


def third_side(events: DataFrame) -> DataFrame:
    """Third-party payments: purchase events."""
    return events.where(F.col("event_type") == THIRD_TYPE).select("user_id", "event_id", "ts")
