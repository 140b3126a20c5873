"""Corpus pipeline: documents in, token ids out.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that calls one
operator of ``clickflow.llm``; its result is written as Parquet and read again
as the next stage's ``docs``.  All stages but the last return the columns of
``documents``; texts that change get their ``n_chars`` anew.  Rows with nulls
in any column, empty and very long texts, repeated rows and empty tables pass
through as the operators' docstrings say.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm.bpe import encode_documents
from clickflow.llm.common import crc_fold, materialize
from clickflow.llm.decontaminate import decontaminate
from clickflow.llm.language_id import identify, train
from clickflow.llm.line_dedup import dedup_lines
from clickflow.llm.ngram_join import keep_one
from clickflow.sources import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise; null and letterless texts and gibberish go."""
    learned = docs.where(F.coalesce(crc_fold(F.col("doc_id")) != 0, F.lit(True)))
    judged = identify(docs.withColumn("__row", F.struct(*docs.columns)).select("__row", "text"), train(learned))
    return judged.where("not rejected").select("__row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are deleted; documents that lose all their words go."""
    kept = dedup_lines(docs, keep_empty=False)
    changed = F.when(F.col("deleted_lines") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return kept.withColumn("n_chars", changed).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs, k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of the bytes they decode to."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                            with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("bpe", bpe),
]

# SQL can express neither the language models nor the byte-level BPE; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
