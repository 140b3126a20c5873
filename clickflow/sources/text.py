"""Text scans: one row per line."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.functions.text import split_lines


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``readTextFile``: a text file (or folder) as rows of ``value``.

    Spark splits large files into input splits, so one huge file is still
    read by many tasks.
    """
    return spark.read.text(path)


def document_lines(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """Every line of every document as ``value`` (whole texts, all lines)."""
    return documents.select(F.explode(split_lines(text_col)).alias("value"))
