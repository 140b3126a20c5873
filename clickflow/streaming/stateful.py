"""Per-key state across micro-batches (``applyInPandasWithState``).

Used only where a stream needs per-row emission with memory of earlier
micro-batches: keyed running totals and count windows (``timers`` holds what
also needs timers).  State per key is a handful of numbers.  A key's rows of a
micro-batch are taken ``HELD_ROWS`` at a time: up to that many are put in
order, more come as stretches in arrival order, each in order, so a backlog on
one key needs no more Python memory than that.
"""
from __future__ import annotations

import decimal
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

HELD_ROWS = 100_000  # rows of a key that are in Python at a time


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def _stretches(pdfs: Iterable[pd.DataFrame], order: list[str]) -> Iterator[pd.DataFrame]:
    """A key's rows of a micro-batch in frames of about ``HELD_ROWS`` rows, each in ``order``."""
    held, n = [], 0
    for frame in pdfs:
        if len(frame):
            held.append(frame)
            n += len(frame)
        if n >= HELD_ROWS:
            yield pd.concat(held, ignore_index=True).sort_values(order, kind="stable", ignore_index=True)
            held, n = [], 0
    if held:
        yield pd.concat(held, ignore_index=True).sort_values(order, kind="stable", ignore_index=True)


def running_count_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str],
                        carry: Sequence[str] = (), out: str = "n", value: str | None = None) -> DataFrame:
    """Every input row emits its key's new running count (keyed reduce, no
    window), or with ``value`` the running sum of that field (nulls skipped).

    Within a micro-batch rows are taken in ``order`` (see ``HELD_ROWS``); across
    micro-batches in arrival order, as a keyed stream does.  State per key: one
    number (two with ``value``).
    """
    keys, order, carry = list(keys), list(order), [c for c in carry if c not in keys]
    out_type = T.LongType() if value is None else _sum_type(stream.schema[value].dataType)
    schema = T.StructType(_fields(stream, keys + carry) + [T.StructField(out, out_type)])
    state_schema = "seen long" if value is None else f"seen long, total {out_type.simpleString()}"

    def step(key, pdfs, state):
        seen, total = (*state.get, None)[:2] if state.exists else (0, None)
        for pdf in _stretches(pdfs, order):
            n = seen + np.arange(1, len(pdf) + 1, dtype="int64")
            seen = int(n[-1])
            if value is None:
                yield pdf[keys + carry].assign(**{out: n})
                continue
            known = pdf[value].notna().to_numpy()
            zero = decimal.Decimal(0) if isinstance(out_type, T.DecimalType) else 0
            # Cumulative sum over the frame, started from the state (exact for decimals: object dtype).
            run = np.cumsum(pdf[value].where(known, zero).to_numpy(dtype=_np_type(out_type)))
            run = run + (zero if total is None else total)
            started = np.full(len(pdf), total is not None) | np.logical_or.accumulate(known)
            res = pdf[keys + carry].copy()
            res[out] = pd.Series(run, index=res.index, dtype="object").where(started, None)
            if started[-1]:
                total = run[-1] if isinstance(out_type, T.DecimalType) else run[-1].item()
            yield res
        if seen:
            state.update((seen,) if value is None else (seen, total))

    return stream.groupBy(*keys).applyInPandasWithState(
        step, schema, state_schema, "append", GroupStateTimeout.NoTimeout)


def _np_type(dt: T.DataType):
    """Numpy type of sums: decimals stay exact as objects."""
    return object if isinstance(dt, T.DecimalType) else np.int64 if isinstance(dt, T.LongType) else np.float64


def _sum_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.DecimalType):
        return T.DecimalType(min(38, dt.precision + 10), dt.scale)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def count_window_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str], size: int,
                       slide: int | None = None, carry: Sequence[str] = (), out: str = "n",
                       value: str | None = None) -> DataFrame:
    """Count window (size, slide) per key on a stream.

    Fires on every ``slide``-th row of the key and covers the last ``size``
    rows; ``slide=None`` (tumbling) fires only when a window of ``size`` is
    full.  Without ``value`` the reduce counts (``min(position, size)``); with
    ``value`` it sums that field over the window (nulls skipped, null when all
    are null).  State per key: the row count and at most ``size - 1`` values.
    """
    slide = size if slide is None else slide
    keys, order, carry = list(keys), list(order), [c for c in carry if c not in keys]
    out_type = T.LongType() if value is None else _sum_type(stream.schema[value].dataType)
    schema = T.StructType(_fields(stream, keys + carry) + [T.StructField(out, out_type)])
    state_schema = "seen long" if value is None else \
        f"seen long, tail array<{stream.schema[value].dataType.simpleString()}>"

    zero = decimal.Decimal(0) if isinstance(out_type, T.DecimalType) else 0
    kind = _np_type(out_type)

    def step(key, pdfs, state):
        seen, tail = (*state.get, None)[:2] if state.exists else (0, None)
        tail = list(tail) if tail is not None else []
        for pdf in _stretches(pdfs, order):
            pos = seen + np.arange(1, len(pdf) + 1, dtype="int64")
            seen, fire = int(pos[-1]), pos % slide == 0
            if value is None:
                if fire.any():
                    yield pdf.loc[fire, keys + carry].assign(**{out: np.minimum(pos[fire], size)})
                continue
            vals = tail + [None if pd.isna(x) else x for x in pdf[value].tolist()]
            if fire.any():
                # Every window is summed from its own rows: one strided view over values padded in front.
                padded = np.array([zero] * (size - 1) + [zero if x is None else x for x in vals], dtype=kind)
                known = np.array([False] * (size - 1) + [x is not None for x in vals])
                ends = len(tail) + np.flatnonzero(fire)      # a row's window starts here in the padded values
                views = [np.lib.stride_tricks.sliding_window_view(x, size)[ends] for x in (padded, known)]
                res = pdf.loc[fire, keys + carry].copy()
                res[out] = pd.Series(views[0].sum(axis=1), index=res.index, dtype="object").where(views[1].any(axis=1), None)
                yield res
            tail = vals[-(size - 1):] if size > 1 else []
        if seen:
            state.update((seen,) if value is None else (seen, tail))

    return stream.groupBy(*keys).applyInPandasWithState(
        step, schema, state_schema, "append", GroupStateTimeout.NoTimeout)
