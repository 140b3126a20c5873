"""Row shaping: tokenising, unpivoting, routing and merging (no shuffles)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.text import event_string, java_space_split


def tokenize(lines: DataFrame, line_col: str = "value", out: str = "word") -> DataFrame:
    """One row per token of ``line.split(" ")`` (Java semantics)."""
    return lines.select(F.explode(java_space_split(line_col)).alias(out))


def word_count(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """(word, n): tokens counted.  Partial counts are combined map-side
    before the shuffle, so a very frequent word costs one row per task."""
    return tokenize(lines, line_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def unpivot_event(events: DataFrame, id_col: str = "event_id",
                  fields: Sequence[str] = ("user", "action", "times")) -> DataFrame:
    """Each event as (key, value) text rows, one per field."""
    cast = events.select(id_col, *[F.col(f).cast("string").alias(f) for f in fields])
    return cast.unpivot([id_col], list(fields), "key", "value")


def user_pairs(events: DataFrame, user_col: str = "user") -> DataFrame:
    """(user, 1) per event.

    The reference unpivots and then keeps the ``user`` rows; that is the same
    as projecting the user field, and projecting first lets the scan read one
    column instead of tripling the rows.
    """
    return events.select(F.col(user_col).alias("user"), F.lit(1).cast("long").alias("n"))


def event_text(events: DataFrame, user: str = "user", action: str = "action",
               times: str = "times", out: str = "value") -> DataFrame:
    return events.withColumn(out, event_string(user, action, times))


def route(df: DataFrame, rules: Sequence[tuple[Column, str]], default: str = "main",
          out: str = "route") -> DataFrame:
    """Tag every row with the first matching rule's name (side outputs).

    All branches stay in one DataFrame; a branch is ``branch(df, name)`` and
    writing the branches together is ``partitionBy(out)`` on the sink.
    """
    expr = None
    for cond, tag in rules:
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    expr = F.lit(default) if expr is None else expr.otherwise(F.lit(default))
    return df.withColumn(out, expr)


def branch(routed: DataFrame, name: str, route_col: str = "route") -> DataFrame:
    return routed.where(F.col(route_col) == F.lit(name))


# The prefixes the reference's co-map puts in front of each
# merged branch ("first stream:" / "second stream:").
FIRST_PREFIX = "第一条流："
SECOND_PREFIX = "第二条流："


def merge_tagged(first: DataFrame, second: DataFrame, text_col: str = "value",
                 first_prefix: str = FIRST_PREFIX, second_prefix: str = SECOND_PREFIX,
                 out: str = "value") -> DataFrame:
    """Connect two branches, map each with its own prefix, one output (UNION ALL)."""
    a = first.select(F.concat(F.lit(first_prefix), F.col(text_col)).alias(out))
    b = second.select(F.concat(F.lit(second_prefix), F.col(text_col)).alias(out))
    return a.unionByName(b)


def merge_routed(df: DataFrame, branches: Sequence[tuple[Column, str]], text_col: str = "value",
                 out: str = "value") -> DataFrame:
    """``merge_tagged`` for branches of one DataFrame, in one scan.

    ``branches`` are (condition, prefix) pairs in routing order: a row goes to
    the first branch whose condition holds (as ``route`` decides).  Rows of
    no listed branch are filtered out by the conditions themselves, so the
    filter reaches the scan (e.g. ``event_type IN (...)`` in parquet).
    """
    prefix, keep = None, None
    for cond, p in branches:
        prefix = F.when(cond, F.lit(p)) if prefix is None else prefix.when(cond, F.lit(p))
        keep = cond if keep is None else (keep | cond)
    return df.where(keep).select(F.concat(prefix, F.col(text_col)).alias(out))
