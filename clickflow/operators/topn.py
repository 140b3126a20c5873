"""Top-N per window.

Batch: ``row_number() <= k`` over the window group.  Spark plans a
window-group limit on both sides of the shuffle, so each task forwards at
most k rows per group.  Ties are broken by count descending, then the tie
columns ascending.

Stream: ``row_number`` is refused on streams, so the top k is the head of a
sorted list built by a second (chained) aggregation, which Spark runs in
append mode behind the first one's watermark.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topn_rows(counts: DataFrame, k: int, group: Sequence[str], item: Sequence[str], count_col: str = "n",
              rank_col: str = "rk") -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.col(count_col).desc(), *[F.col(c).asc() for c in item])
    return counts.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= k)


def topn_array(counts: DataFrame, k: int, group: Sequence[str], item: str, count_col: str = "n",
               out: str = "top") -> DataFrame:
    """Per group, an array of at most k structs (item, n) in rank order.

    Batch form: the rank filter runs first, so each collected list holds at
    most k entries.
    """
    ranked = topn_rows(counts, k, group, [item], count_col, "_cf_rk")
    return (ranked.groupBy(*group)
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_cf_rk").alias("rk"), F.col(item).alias(item),
                                                      F.col(count_col).alias(count_col)))).alias("_cf_l"))
            .select(*group, F.transform("_cf_l", lambda s: F.struct(s[item].alias(item),
                                                                    s[count_col].alias(count_col))).alias(out)))


def topn_array_stream(counts: DataFrame, k: int, group: Sequence[str], item: str, count_col: str = "n",
                      out: str = "top") -> DataFrame:
    """Streaming form: chained aggregation over the (append-mode) counts.

    The list per window holds one entry per distinct item of that window --
    the same state the reference keeps in its list state until the timer.
    """
    collected = counts.groupBy(*group).agg(
        F.collect_list(F.struct((-F.col(count_col)).alias("neg"), F.col(item).alias(item),
                                F.col(count_col).alias(count_col))).alias("_cf_l"))
    head = F.slice(F.array_sort("_cf_l"), 1, k)
    return collected.select(*group, F.transform(head, lambda s: F.struct(s[item].alias(item),
                                                                          s[count_col].alias(count_col))).alias(out))


def render_top(col: str = "top", item: str = "event_type", count_col: str = "n"):
    """'click:3,view:2' text of a top array."""
    return F.array_join(F.transform(col, lambda s: F.concat(s[item], F.lit(":"), s[count_col].cast("string"))), ",")
