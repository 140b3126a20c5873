"""Two-input operators: window join, window co-group, interval join and
two-sided reconciliation.

Range conditions are never evaluated per key alone: a hot key would make a
sort-merge join compare every left row with every right row of that key.
Both sides also carry a time bucket in the equi-join key.  The left row sits
in the bucket of its own time; the right row is copied to every bucket its
valid partners can sit in (at most two, since the bucket is as wide as the
time range).  Each pair therefore meets in exactly one bucket, the join
shuffles on (key, bucket), and a hot key is spread over its time range.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.time import epoch_micros, millis_of, to_micros
from clickflow.operators.sequence import PIECE_ROWS, keyed_row_number, running_max, with_neighbours

# Reconciliation status names.
MATCHED = "MATCHED"
MISSING_THIRD = "MISSING_THIRD"   # app payment without a third-party partner in time
MISSING_APP = "MISSING_APP"       # third-party payment without an app partner in time

_B = "_cf_b"


def _micros(df: DataFrame, col: str) -> Column:
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return epoch_micros(col)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(dt, (T.LongType, T.IntegerType)):
        return F.col(col).cast("long") * 1000  # epoch milliseconds
    raise TypeError(f"{col}: not a time column ({dt})")


def _prefixed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


def _bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str], lt: str, rt: str,
              lo: int, hi: int, how: str) -> DataFrame:
    """Rows of ``left`` joined to ``right`` where right.t - left.t is in [lo, hi] (micros).

    ``left`` keeps its own columns; ``right``'s key columns are renamed away
    and its other columns must not clash with ``left``'s.
    """
    width = max(hi - lo, 1)
    lus, rus = "_cf_lus", "_cf_rus"
    l2 = left.withColumn(lus, _micros(left, lt)).withColumn(_B, F.floor(F.col(lus) / width))
    rk = [f"_cf_rk{i}" for i in range(len(keys))]
    r1 = right.select(*[F.col(k).alias(r) for k, r in zip(keys, rk)],
                      *[c for c in right.columns if c not in keys])
    r1 = r1.withColumn(rus, _micros(right, rt))
    r2 = r1.withColumn("_cf_rb", F.explode(F.sequence(F.floor((F.col(rus) - hi) / width),
                                                      F.floor((F.col(rus) - lo) / width))))
    cond = [F.col(k) == F.col(r) for k, r in zip(keys, rk)]
    cond += [F.col(_B) == F.col("_cf_rb"),
             F.col(rus).between(F.col(lus) + F.lit(lo), F.col(lus) + F.lit(hi))]
    out = l2.join(r2, on=cond, how=how)
    return out.drop(lus, rus, _B, "_cf_rb", *rk)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], lower: str | int, upper: str | int,
                  ts: str = "ts", left_prefix: str = "app_", right_prefix: str = "third_") -> DataFrame:
    """Inner interval join: same key and right.ts in [left.ts + lower, left.ts + upper], both ends inclusive."""
    lo, hi = to_micros(lower), to_micros(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    lp, rp = _prefixed(left, keys, left_prefix), _prefixed(right, keys, right_prefix)
    return _bucketed(lp, rp, keys, left_prefix + ts, right_prefix + ts, lo, hi, "inner")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: str | int = "5 seconds",
              ts: str = "ts", left_prefix: str = "app_", right_prefix: str = "third_") -> DataFrame:
    """Pair each app row with every third-party row of the same key within
    +-tolerance (MATCHED); rows with no partner in range alert with the
    missing side named.  Equal to a full outer interval join: the pairs come
    from one bucketed join, the rows without a partner from
    ``reconcile_alerts``, which looks at neighbours only and joins nothing.
    """
    tol = to_micros(tolerance)
    L, R = _prefixed(left, keys, left_prefix), _prefixed(right, keys, right_prefix)
    both = _bucketed(L, R, keys, left_prefix + ts, right_prefix + ts, -tol, tol, "inner").withColumn(
        "status", F.lit(MATCHED))
    alone = _alone(left, right, keys, tol, ts)
    cols = [c for c in left.columns if c not in keys]
    app = alone.where(F.col("_cf_side") == 0).select(*keys, *[F.col(c).alias(left_prefix + c) for c in cols],
                                                     F.lit(MISSING_THIRD).alias("status"))
    third = alone.where(F.col("_cf_side") == 1).select(*keys, *[F.col(c).alias(right_prefix + c) for c in cols],
                                                       F.lit(MISSING_APP).alias("status"))
    return both.unionByName(app, allowMissingColumns=True).unionByName(third, allowMissingColumns=True)


def _alone(left: DataFrame, right: DataFrame, keys: Sequence[str], tol: int, ts: str) -> DataFrame:
    """Rows of either side (``_cf_side``) with no row of the other within +-tol, from one pass over both.

    The tagged union is bucketed by time, each row also given to the buckets
    next to its own; in a bucket the last row of the other side before and
    the first after a row decide.  Rows without a time never have a partner
    and are added as they are, so they need no bucket.
    """
    cols = [c for c in left.columns if c not in keys]
    one, other = (d.select(*keys, *cols, F.lit(s).alias("_cf_side"), _micros(d, ts).alias("_cf_us"))
                  for d, s in ((left, 0), (right, 1)))
    width = max(tol, 1)
    own = F.floor(F.col("_cf_us") / width)
    tagged = one.unionByName(other)
    rows = tagged.where(F.col("_cf_us").isNotNull()).withColumn(_B, F.explode(F.array(own - 1, own, own + 1))).withColumn(
        "_cf_own", own)
    w = Window.partitionBy(*keys, _B).orderBy("_cf_us")
    before, after = w.rangeBetween(-tol, 0), w.rangeBetween(0, tol)

    def seen(side):
        at = F.when(F.col("_cf_side") == side, 1)
        return F.coalesce(F.max(at).over(before), F.max(at).over(after), F.lit(0))
    marked = rows.withColumns({"_cf_l": seen(0), "_cf_r": seen(1)}).where(F.col(_B) == F.col("_cf_own"))
    has = F.when(F.col("_cf_side") == 0, F.col("_cf_r")).otherwise(F.col("_cf_l")) == 1
    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()  # null keys never have a partner
    timeless = tagged.where(F.col("_cf_us").isNull())
    return marked.where(~(has & keyed)).select(*keys, *cols, "_cf_side").unionByName(
        timeless.select(*keys, *cols, "_cf_side"))


def reconcile_alerts(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: str | int = "5 seconds",
                     ts: str = "ts") -> DataFrame:
    """Only the alerts: rows of either side without a partner within +-tolerance.

    Both sides must have the same columns; output is those columns + status.
    """
    alone = _alone(left, right, keys, to_micros(tolerance), ts)
    status = F.when(F.col("_cf_side") == 0, MISSING_THIRD).otherwise(MISSING_APP)
    return alone.withColumn("status", status).drop("_cf_side")


def window_join(left: DataFrame, right: DataFrame, keys: Sequence[str], size: str, ts: str = "ts",
                left_prefix: str = "app_", right_prefix: str = "third_") -> DataFrame:
    """Inner join of rows with equal key in the same tumbling window.

    The window start is part of the equi-join key, so the shuffle is on
    (key, window) and every window of a hot key is its own join group.
    Emits every pair of a (key, window), as the windowed join defines.
    """
    L = _prefixed(left, keys, left_prefix)
    w = F.window(left_prefix + ts, size)
    L = L.withColumn("window_start", w.start).withColumn("window_end", w.end)
    R = _prefixed(right, keys, right_prefix)
    rk = [f"_cf_rk{i}" for i in range(len(keys))]
    R = R.select(*[F.col(k).alias(r) for k, r in zip(keys, rk)],
                 *[c for c in R.columns if c not in keys],
                 F.window(right_prefix + ts, size).start.alias("_cf_rws"))
    cond = [F.col(k) == F.col(r) for k, r in zip(keys, rk)] + [F.col("window_start") == F.col("_cf_rws")]
    out = L.join(R, on=cond, how="inner").drop("_cf_rws", *rk)
    first = [*keys, "window_start", "window_end"]
    return out.select(*first, *[c for c in out.columns if c not in first])


def _tagged(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    sides = (left, F.lit(0)), (right, F.lit(1))
    one, other = (d.select(*keys, ts, F.col(value).alias("_cf_v"), side.alias("_cf_side")) for d, side in sides)
    return one.unionByName(other)


def window_cogroup(left: DataFrame, right: DataFrame, keys: Sequence[str], size: str, value: str,
                   ts: str = "ts", left_out: str = "app_values", right_out: str = "third_values") -> DataFrame:
    """Per (key, tumbling window): the sorted values of both sides, one row a
    group, emitted even when one side is empty.

    One aggregation over the tagged union, batch and stream alike.  A row
    holds all values of its key and window, as the co-group function gets
    them; ``window_cogroup_rows`` gives the same content without lists.
    """
    lists = [F.array_sort(F.collect_list(F.when(F.col("_cf_side") == 0, F.col("_cf_v")))).alias(left_out),
             F.array_sort(F.collect_list(F.when(F.col("_cf_side") == 1, F.col("_cf_v")))).alias(right_out)]
    agg = _tagged(left, right, keys, ts, value).groupBy(*keys, F.window(ts, size).alias("_cf_w")).agg(*lists)
    return agg.select(*keys, F.col("_cf_w.start").alias("window_start"), F.col("_cf_w.end").alias("window_end"),
                      left_out, right_out)


def window_cogroup_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], size: str, value: str,
                        ts: str = "ts", left_tag: str = "app", right_tag: str = "third") -> DataFrame:
    """The co-group of every (key, tumbling window) as rows: side, rank in the side by value, value.

    Sorted by (keys, window, side, rank) the rows are the two lists that a
    co-group function sees, however many values a group has: ranks are keyed
    row numbers, which cut large groups into pieces.
    """
    w = F.window(ts, size)
    framed = _tagged(left, right, keys, ts, value).select(
        *keys, w.start.alias("window_start"), w.end.alias("window_end"),
        F.when(F.col("_cf_side") == 0, left_tag).otherwise(right_tag).alias("side"), F.col("_cf_v").alias(value))
    group = [*keys, "window_start", "window_end", "side"]
    return keyed_row_number(framed, group, [value], "rank").select(*group, "rank", value)


def reconcile_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str], tolerance: str | int = "5 seconds",
                         ts: str = "ts", id_col: str = "event_id", piece_rows: int = PIECE_ROWS) -> DataFrame:
    """1:1 reconciliation: each row pairs with at most one row of the other side.

    The batch form of the keyed process that keeps one pending row: rows of a
    key are taken in (time in ms, app before third, id) order; a row within
    ``tolerance`` of the pending row of the other side is MATCHED with it, any
    other row replaces the pending one, which is reported missing.
    Output: keys, app and third id and ms, status.

    The process is a small automaton whose state after a row is "this row is
    pending" or "nothing is".  A row out of reach of the row before makes the
    first state, whatever came earlier; a row in reach turns one state into
    the other.  Such steps compose: a stretch of rows either sets the state or
    turns it as often as it has rows.  So a row's state is the parity of its
    distance from the last setting row, a running maximum of positions, and no
    chain of rows in reach of each other is walked by one task, however long.
    """
    keys, tol_ms = list(keys), to_micros(tolerance) // 1000
    order = ["_cf_ms", "_cf_side", "_cf_id"]
    sides = [d.select(*keys, millis_of(d, ts).alias("_cf_ms"), F.lit(s).alias("_cf_side"), F.col(id_col).alias("_cf_id"))
             for d, s in ((left, 0), (right, 1))]
    timeline = with_neighbours(sides[0].unionByName(sides[1]), keys, order, "_cf_prev", "_cf_next", "_cf_at", piece_rows,
                               keep_piece=True)

    def reach(earlier: str, later: str) -> Column:
        other = F.col(earlier + "_cf_side") != F.col(later + "_cf_side")
        return F.coalesce(other & (F.col(later + "_cf_ms") - F.col(earlier + "_cf_ms") <= tol_ms), F.lit(False))
    timeline = timeline.withColumns({"_cf_sets": F.when(~reach("_cf_prev.", ""), F.col("_cf_at")),
                                     "_cf_more": reach("", "_cf_next.")})
    states = running_max(timeline, keys, order, "_cf_sets", "_cf_set", piece_rows)
    second = (F.col("_cf_at") - F.col("_cf_set")) % 2 == 1
    app = F.col("_cf_side") == 0

    def pick(mine: Column, field: str) -> Column:
        return F.when(mine, F.col(field)).when(second, F.col(f"_cf_prev.{field}"))
    status = F.when(second, MATCHED).when(app, MISSING_THIRD).otherwise(MISSING_APP)
    return states.where(second | ~F.col("_cf_more")).select(
        *keys, pick(app, "_cf_id").alias(f"app_{id_col}"), pick(app, "_cf_ms").alias("app_ms"),
        pick(~app, "_cf_id").alias(f"third_{id_col}"), pick(~app, "_cf_ms").alias("third_ms"), status.alias("status"))
