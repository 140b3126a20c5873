"""Time windows: tumbling, sliding, session (fixed and per-row gap).

All time windows are half-open ``[start, end)`` and aligned to the epoch.
The same functions serve batch and streaming inputs; on a stream, put a
watermark on ``ts`` first (``withWatermark``) and use append mode.
Counting is a partial + final aggregation, so a hot key is pre-combined in
every task before the shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.time import to_micros
from clickflow.operators.sequence import sessions


def _counted(df: DataFrame, win: Column, keys: Sequence[str], prefix: str, out: str) -> DataFrame:
    agg = df.groupBy(win.alias("_cf_w"), *keys).agg(F.count(F.lit(1)).alias(out))
    return agg.select(F.col("_cf_w.start").alias(f"{prefix}_start"), F.col("_cf_w.end").alias(f"{prefix}_end"),
                      *keys, out)


def tumbling_counts(df: DataFrame, size: str, keys: Sequence[str], ts: str = "ts", out: str = "n") -> DataFrame:
    return _counted(df, F.window(ts, size), keys, "window", out)


def sliding_counts(df: DataFrame, size: str, slide: str, keys: Sequence[str], ts: str = "ts",
                   out: str = "n") -> DataFrame:
    """Counts per (sliding window, keys).

    Batch, when the slide divides the size: rows are counted once per pane (a
    window as wide as the slide) and the panes' counts are added to the
    size / slide windows they lie in; rows themselves are never copied.
    """
    wide, step = to_micros(size), to_micros(slide)
    if df.isStreaming or wide % step or wide == step:
        return _counted(df, F.window(ts, size, slide), keys, "window", out)
    panes = df.groupBy(F.window(ts, slide).alias("_cf_p"), *keys).agg(F.count(F.lit(1)).alias(out))
    # Fixed-length steps: a pane's windows start up to size - slide before it.
    back = F.explode(F.sequence(F.lit(0), F.lit(wide // step - 1)))
    moved = panes.select("_cf_p.start", *keys, out, back.alias("_cf_k"))
    start = F.col("start") - F.make_dt_interval(secs=F.col("_cf_k") * F.lit(step / 1_000_000))
    rows = moved.select(start.alias("window_start"), *keys, out)
    agg = rows.groupBy("window_start", *keys).agg(F.sum(out).alias(out))
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(wide / 1_000_000))
    return agg.select("window_start", end.alias("window_end"), *keys, out)


def session_counts(df: DataFrame, gap: str, keys: Sequence[str], ts: str = "ts", out: str = "n",
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sessions per key with a fixed gap; rows exactly one gap apart share a session.

    Batch: ``sequence.sessions``, which cuts every key into pieces.  Streams:
    Spark's ``session_window``, whose state is per key.
    """
    if not df.isStreaming:
        return sessions(df, keys, ts, gap, tiebreak, out)
    return _counted(df, F.session_window(ts, gap), keys, "session", out)


def dynamic_session_counts(df: DataFrame, gap: Column, keys: Sequence[str], ts: str = "ts",
                           out: str = "n", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Sessions whose gap comes from the row (``gap`` is an interval column).

    A row extends its session to ``ts + gap``; the next row joins it when it
    is not after that end.  Rows with a zero gap form no session.
    """
    if not df.isStreaming:
        return sessions(df, keys, ts, gap, tiebreak, out)
    return _counted(df, F.session_window(ts, gap), keys, "session", out)
