"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.session import ensure_checkpoint_dir

A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def scratch_path(spark, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage and stops two consumers from computing the same rows twice;
    any executor can read the files, so a lost one costs only a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII texts take the fast built-in; the result is the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, A_Z, A_Z.lower()))


def crc_fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the id's decimal text, modulo ``folds`` (null id: null)."""
    return F.crc32(key.cast("string").cast("binary")) % folds
