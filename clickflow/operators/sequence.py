"""Per-key sequences without a single task per key.

Running totals, count windows and sessions need what lies before a row in its
key.  ``Window.partitionBy(key)`` would put a whole key into one task.  Here
the rows of a heavy key (more than ``PIECE_ROWS`` rows) are cut into pieces by
the first order column, at cut points that follow the rows' density:

* A sample of the heavy keys' rows is picked by a hash of the row, about
  ``SAMPLED`` rows a piece.  Every ``SAMPLED``-th of its order values, sorted,
  is a cut point.  An outlier or a burst moves no other piece's borders, and no
  piece is much larger than ``PIECE_ROWS`` rows of all heavy keys together.
* Heavy keys and cut points are scalar subqueries, so building a plan runs
  nothing, and pure functions of the table: no order of merging matters, so two
  branches of a plan cannot disagree about a row's piece.
* A table has ``MAX_PIECES`` pieces at most; beyond ``MAX_PIECES * PIECE_ROWS``
  rows a piece is that share of the table, so both subqueries stay small
  (``SAMPLED * MAX_PIECES`` numbers) however large the table is.

1. Totals per (key, piece) of heavy keys, combined map-side; a running total
   over a key's earlier pieces gives what each piece starts from.
2. That start joins the piece as its first row, so one window per (key, piece)
   gives final results: no join, and one plan for keys of every size.  A light
   key is one piece and needs no start.

Rows that share the first order column cannot be cut apart: a key with far
more than ``PIECE_ROWS`` rows at one instant (or without one) is one piece.
Order columns that are neither times nor integers make one piece a key.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.time import epoch_micros

PIECE_ROWS = 200_000  # rows of a piece, about
MAX_PIECES = 10_000   # of a table
SAMPLED = 64          # rows of a piece, about, that its cut points are taken from

_PIECE, _ROW, _POS = "_cf_piece", "_cf_row", "_cf_pos"
_LIGHT = -1           # the piece of all rows of a key that is not cut


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _number(df: DataFrame, col: str) -> Column | None:
    """The order column as a long, or None if it is no time or integer."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(kind, T.TimestampNTZType):
        return epoch_micros(col)
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(col)).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(col).cast("long")
    return None


def _with_steps(sorted_values: Column) -> Column:
    """The values with the steps of a bisection over them (powers of two, falling)."""
    powers = F.sequence(F.floor(F.log2(F.size(sorted_values) + 1)).cast("int"), F.lit(0))
    return F.struct(sorted_values.alias("values"), F.transform(powers, lambda i: F.pow(2, i).cast("int")).alias("steps"))


def _up_to(searched: Column, value: Column) -> Column:
    """How many of the values (see ``_with_steps``) are not above ``value``."""
    return F.aggregate(searched["steps"], F.lit(0), lambda at, step: F.when(
        F.get(searched["values"], at + step - 1) <= value, at + step).otherwise(at))


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` written once, however often it is used: a plan would hold a subquery each time."""
    return F.transform(F.array(value), use)[0]


def with_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``df`` with the piece of each row: its place among the cut points from 1 on, 0 without an order value,
    ``_LIGHT`` in keys that are not cut.  Rows that have their piece already keep it."""
    if _PIECE in df.columns:
        return df
    at = _number(df, order[0])
    if at is None:
        return df.withColumn(_PIECE, F.lit(_LIGHT))
    key = F.xxhash64(*keys) if keys else F.lit(0).cast("long")
    slim = df.select(key.alias("k"), at.alias("at"), F.xxhash64(*keys, *order).alias("pick"))
    many = slim.agg(F.greatest(F.lit(piece_rows), F.ceil(F.count(F.lit(1)) / MAX_PIECES)).cast("long").alias("w"))
    counts = slim.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("many", many.scalar())
    heavy = counts.where("n > many").agg(F.collect_list("k").alias("heavy"))
    asked = slim.withColumns({"heavy": heavy.scalar(), "many": many.scalar()})
    sampled = _with(F.struct("heavy", "many"), lambda x: F.when(
        F.array_contains(x["heavy"], F.col("k")) & (F.pmod(F.col("pick"), x["many"]) < SAMPLED), F.col("at")))
    every = F.filter(F.array_sort(F.collect_list(sampled)), lambda _, i: (i + 1) % SAMPLED == 0)
    cuts = asked.agg(every.alias("cuts")).select(_with_steps(F.col("cuts")).alias("cuts"))
    known = df.withColumns({"_cf_heavy": heavy.scalar(), "_cf_cuts": cuts.scalar()})
    piece = _with(F.struct("_cf_heavy", "_cf_cuts"), lambda x: F.when(~F.array_contains(x["_cf_heavy"], key), _LIGHT).when(
        at.isNull(), 0).otherwise(_up_to(x["_cf_cuts"], at) + 1))
    return known.withColumn(_PIECE, piece).drop("_cf_heavy", "_cf_cuts")


def _with_starts(base: DataFrame, keys: list[str], totals: dict[str, Column], merge: dict) -> DataFrame:
    """``base`` plus one first row per (key, piece) that holds ``merge`` of ``totals`` over the key's earlier pieces."""
    per_piece = base.where(F.col(_PIECE) != _LIGHT).groupBy(*keys, _PIECE).agg(*[v.alias(c) for c, v in totals.items()])
    before = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_piece.select(*keys, _PIECE, *[merge[c](c).over(before).alias(c) for c in totals],
                              F.lit(False).alias(_ROW))
    return base.withColumn(_ROW, F.lit(True)).unionByName(starts, allowMissingColumns=True)


def keyed_prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict,
                      piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Inclusive running sums per key in ``order``: ``{out: value column}``.

    ``order`` must be a total order inside a key.  SQL semantics: nulls are
    skipped, the sum is null until the key's first value; its type is that of
    ``sum(value)``.  All columns of ``df`` are kept.
    """
    keys, order = list(keys), list(order)
    values = {f"_cf_v{i}": (F.col(v) if isinstance(v, str) else v) for i, v in enumerate(sums.values())}
    base = with_pieces(df.select("*", *[v.alias(t) for t, v in values.items()]), keys, order, piece_rows)
    kinds = df.select(*[F.sum(v).alias(t) for t, v in values.items()]).schema
    rows = _with_starts(base, keys, {t: F.sum(t) for t in values}, {t: F.sum for t in values})
    run = Window.partitionBy(*keys, _PIECE).orderBy(_ROW, *_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    outs = [F.sum(t).over(run).cast(kinds[t].dataType).alias(o) for o, t in zip(sums, values)]
    return rows.select(*df.columns, _ROW, *outs).where(_ROW).drop(_ROW)


def keyed_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "rn",
                     piece_rows: int = PIECE_ROWS) -> DataFrame:
    """1-based position of each row within its key, ordered by ``order`` (a running sum of ones)."""
    return keyed_prefix_sums(df, keys, order, {out: F.lit(1).cast("long")}, piece_rows)


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                piece_rows: int = PIECE_ROWS) -> DataFrame:
    """The largest ``value`` of a key's rows up to and including each row (nulls skipped)."""
    keys, order = list(keys), list(order)
    base = with_pieces(df.withColumn(out, F.col(value)), keys, order, piece_rows)
    rows = _with_starts(base, keys, {out: F.max(out)}, {out: F.max})
    run = Window.partitionBy(*keys, _PIECE).orderBy(_ROW, *_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.max(out).over(run)).where(_ROW).select(*[c for c in df.columns if c != _PIECE], out)


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: str, after: str, position: str,
                    piece_rows: int = PIECE_ROWS, keep_piece: bool = False) -> DataFrame:
    """``df`` with the rows around each row of its key: ``before`` and ``after`` are structs of the order columns
    (null at the ends), ``position`` counts from 1.

    A piece gets the last row of the earlier pieces and their number of rows
    as its first row, and the first row of the later pieces as its last.
    ``keep_piece`` leaves the piece in the result, for the next operator.
    """
    keys, order = list(keys), list(order)
    base = with_pieces(df.withColumn(before, F.struct(*order)), keys, order, piece_rows)
    per_piece = base.where(F.col(_PIECE) != _LIGHT).groupBy(*keys, _PIECE).agg(
        F.max(before).alias("_cf_last"), F.min(before).alias("_cf_first"), F.count(F.lit(1)).alias(_POS))
    earlier = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(1, Window.unboundedFollowing)
    per_piece = per_piece.select(*keys, _PIECE, F.max("_cf_last").over(earlier).alias("_cf_last"),
                                 F.min("_cf_first").over(later).alias("_cf_first"), F.sum(_POS).over(earlier).alias(_POS))
    # 0: what lies before the piece, 1: its rows, 2: what lies after it.
    edge = F.explode(F.array(F.struct(F.lit(0).alias(_ROW), F.col("_cf_last").alias(before), F.col(_POS)),
                             F.struct(F.lit(2).alias(_ROW), F.col("_cf_first").alias(before), F.lit(None).cast("long").alias(_POS))))
    edges = per_piece.select(*keys, _PIECE, edge.alias("_cf_e")).select(*keys, _PIECE, "_cf_e.*").where(
        F.col(before).isNotNull())
    rows = base.withColumns({_ROW: F.lit(1), _POS: F.lit(1).cast("long")}).unionByName(edges, allowMissingColumns=True)
    local = Window.partitionBy(*keys, _PIECE).orderBy(_ROW, *_cols(order))
    around = rows.withColumns({
        after: F.lead(before).over(local), "_cf_previous": F.lag(before).over(local),
        position: F.sum(_POS).over(local.rowsBetween(Window.unboundedPreceding, 0))})
    kept = [*df.columns, *[_PIECE] * keep_piece]
    return around.where(F.col(_ROW) == 1).select(*kept, F.col("_cf_previous").alias(before), after, position)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "total",
                piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Keyed running reduce summing ``value``: every row emits its key's new total
    (the reference's keyed reduce adds the tuple's second field)."""
    return keyed_prefix_sums(df, keys, order, {out: value}, piece_rows)


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n",
                  piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Keyed running reduce without a window: every row emits its key's new total."""
    return keyed_row_number(df, keys, order, out, piece_rows)


def count_window_sliding(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                         slide: int = 1, out: str = "n", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Sliding count window (size, slide) per key, summing one per element.

    The window fires on every ``slide``-th element of the key and covers the
    last ``size`` elements (fewer at the start), so the reduced count is
    ``least(position, size)``.  Nothing but the position is needed.
    """
    if size < 1 or slide < 1:
        raise ValueError("size and slide must be positive")
    numbered = keyed_row_number(df, keys, order, _POS, piece_rows)
    if slide > 1:
        numbered = numbered.where(F.col(_POS) % slide == 0)
    return numbered.withColumn(out, F.least(F.col(_POS), F.lit(size).cast("long"))).drop(_POS)


def count_window_tumbling(df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                          ts: str = "ts", out: str = "n", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Tumbling count window of ``size`` per key; only full windows fire.

    Rows are grouped by (key, (position - 1) div size): every group has at
    most ``size`` rows, so the aggregation cannot be skewed.
    """
    if size < 1:
        raise ValueError("size must be positive")
    numbered = keyed_row_number(df, keys, order, _POS, piece_rows)
    bucketed = numbered.withColumn("win", F.floor((F.col(_POS) - 1) / size).cast("long"))
    return (bucketed.groupBy(*keys, "win")
            .agg(F.count(F.lit(1)).alias(out), F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"))
            .where(F.col(out) == size))


def count_window_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, size: int,
                     slide: int = 1, out: str = "total", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Count window (size, slide) per key reducing by summing ``value`` (the
    reference's reduce adds the tuple's second field): on every ``slide``-th
    row, the sum over the key's last ``size`` rows (SQL sum: nulls skipped,
    null when all are null).

    Rows are numbered, then dealt into blocks of consecutive positions; the
    last ``size - 1`` rows of a block are also given to the next, so every
    window is summed from its own rows and nothing else (a NaN or an overflow
    stays inside the windows that hold it).  Blocks have a fixed row bound.
    """
    if size < 1 or slide < 1:
        raise ValueError("size and slide must be positive")
    keys = list(keys)
    rows = max(piece_rows, 8 * size)
    numbered = keyed_row_number(df, keys, order, _POS, piece_rows)
    block = F.floor((F.col(_POS) - 1) / rows)
    # A block's tail also belongs to the block of the position `size - 1` rows on.
    last = F.floor((F.col(_POS) + size - 2) / rows)
    dealt = numbered.withColumn(_ROW, block).withColumn(_PIECE, F.explode(F.sequence(block, last)))
    w = Window.partitionBy(*keys, _PIECE).orderBy(_POS).rowsBetween(1 - size, 0)
    summed = dealt.withColumn(out, F.sum(value).over(w)).where(F.col(_ROW) == F.col(_PIECE))
    if slide > 1:
        summed = summed.where(F.col(_POS) % slide == 0)
    return summed.select(*[c for c in df.columns if c != out], out)


def sessions(df: DataFrame, keys: Sequence[str], ts: str, gap, tiebreak: Sequence[str] = (),
             out: str = "n", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Session windows per key: (session_start, session_end, keys, n).

    A row covers ``[ts, ts + gap)``; a row joins the open session unless it
    starts after the latest end seen so far for its key (rows exactly one
    gap apart join).  ``gap`` is a duration string or an interval column
    (dynamic gap); rows with a gap that is not positive form no session.

    Same result as grouping by ``session_window``, but no key is one task: the
    latest end before a row is a running maximum, the session's number a
    running sum of session starts, both by pieces, and the last grouping is by
    (key, session) with map-side combining.
    """
    keys, order = list(keys), [ts, *tiebreak]
    gap_col = F.expr(f"INTERVAL {gap}") if isinstance(gap, str) else gap
    ends = df.select(*keys, *order, (F.col(ts) + gap_col).alias("_cf_end")).where(F.col("_cf_end") > F.col(ts))
    base = with_pieces(ends, keys, order, piece_rows)
    rows = _with_starts(base, keys, {"_cf_end": F.max("_cf_end")}, {"_cf_end": F.max})
    local = Window.partitionBy(*keys, _PIECE).orderBy(_ROW, *_cols(order))
    before = F.max("_cf_end").over(local.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("_cf_last", before).where(_ROW)
    opened = opened.withColumn("_cf_new", (F.col("_cf_last").isNull() | (F.col(ts) > F.col("_cf_last"))).cast("long"))
    opened = opened.select(*keys, *order, "_cf_end", _PIECE, "_cf_new")
    numbered = _with_starts(opened, keys, {"_cf_new": F.sum("_cf_new")}, {"_cf_new": F.sum})
    sid = F.sum("_cf_new").over(local.rowsBetween(Window.unboundedPreceding, 0))
    whole = numbered.withColumn("_cf_sid", sid).where(_ROW).groupBy(*keys, "_cf_sid").agg(
        F.min(ts).alias("session_start"), F.max("_cf_end").alias("session_end"), F.count(F.lit(1)).alias(out))
    return whole.select("session_start", "session_end", *keys, out)
