"""Keyed state with timers (``transformWithState``).

For what the built-in stateful operators cannot say: a fold that keeps k
entries until its window is complete, payments that wait for a partner with a
deadline each, windows that close by the clock, and a co-group whose groups
are too large for a row.  A processor sees its key's rows of a micro-batch as
a stream of chunks and its state as small entries, so a key with a whole
backlog in one micro-batch needs no more Python memory than a chunk.

The state lives in RocksDB (``build_session`` sets the provider; other
sessions need ``spark.sql.streaming.stateStore.providerClass`` set to it).
Times are epoch milliseconds inside the processors.
"""
from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickflow.functions.time import to_micros
from clickflow.operators.joins import MATCHED, MISSING_APP, MISSING_THIRD
from clickflow.session import ROCKSDB

CHUNK = 10_000  # rows of an emitted frame
BLOCK = 1_000   # values of a state entry of a large group


def _needs_rocksdb(spark: SparkSession) -> None:
    name = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(name, None) != ROCKSDB:
        raise ValueError(f"keyed state with timers needs {name}={ROCKSDB}")


def _event_time(ts: str) -> Column:
    """``ts`` as the event time of rows that go to Python, whose frames know times from 1677 to 2262 only.

    Farther times count as the nearest of these for the watermark; the
    processors get true times as numbers.
    """
    at, low, high = F.col(ts), F.lit("1700-01-01").cast("timestamp"), F.lit("2250-01-01").cast("timestamp")
    return F.when(at < low, low).when(at > high, high).otherwise(at)


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def _with_state(rows: DataFrame, keys: Sequence[str], processor: StatefulProcessor, schema: T.StructType,
                time: str = "EventTime") -> DataFrame:
    _needs_rocksdb(rows.sparkSession)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", time)


def _frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of at most ``CHUNK`` rows; whole numbers may be null."""
    chunk: list[tuple] = []
    for row in rows:
        chunk.append(row)
        if len(chunk) >= CHUNK:
            yield pd.DataFrame(chunk, columns=columns, dtype=object)
            chunk = []
    if chunk:
        yield pd.DataFrame(chunk, columns=columns, dtype=object)


class _TopK(StatefulProcessor):
    """The k largest (count, item) of a window; state: those k, a timer just after the window's start."""

    def __init__(self, k: int, columns: list[str]):
        self.k, self.columns = k, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getListState("top", "item string, n long")

    def handleInputRows(self, key, rows, timerValues):
        best = [(-n, item) for item, n in self.top.get()]
        if not best:
            self.handle.registerTimer(key[0] + 1)
        for frame in rows:
            best = heapq.nsmallest(self.k, [*best, *zip((-frame["n"]).tolist(), frame["item"].tolist())],
                                   key=lambda e: (e[0], e[1] is not None, e[1] or ""))
        self.top.put([(item, -int(n)) for n, item in best])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        entries = list(self.top.get())
        self.top.clear()
        yield from _frames(((key[0], rank, item, n) for rank, (item, n) in enumerate(entries, 1)), self.columns)

    def close(self) -> None:
        pass


def stream_topn_state(stream: DataFrame, size: str, slide: str, item: str, k: int, delay: str,
                      ts: str = "ts") -> DataFrame:
    """Top ``k`` items per sliding window: per-item counts by Spark's aggregation, then k entries of state a window.

    The counts of a window come when the watermark has passed its end; the
    fold keeps the k largest (count descending, item ascending, null first)
    and a timer at window start + 1 ms, already due by then, emits them in the
    same micro-batch.  Rows: window_start, window_end, rk, item, n.  ``item``
    is taken as text.
    """
    counts = (stream.withWatermark(ts, delay)
              .groupBy(F.window(ts, size, slide).alias("window"), F.col(item).cast("string").alias("item"))
              .agg(F.count(F.lit(1)).alias("n")))
    keyed = counts.select(F.unix_millis("window.start").alias("start"), "window", "item", "n")
    columns = ["start", "rk", "item", "n"]
    schema = T.StructType().add("start", "long").add("rk", "long").add("item", "string").add("n", "long")
    top = _with_state(keyed, ["start"], _TopK(k, columns), schema)
    start = F.timestamp_millis("start")
    end = F.timestamp_millis(F.col("start") + to_micros(size) // 1000)
    return top.select(start.alias("window_start"), end.alias("window_end"), "rk", F.col("item").alias(item), "n")


class _Payments(StatefulProcessor):
    """1:1 pairing in event time.

    State: the pending payment, and rows that the watermark has not passed, by
    time bucket as wide as the tolerance.  Timers, all from the arrival of a
    row on: the end of its bucket, and its own deadline.
    """

    def __init__(self, tolerance: int, row_types: str, columns: list[str]):
        self.tolerance, self.width, self.row_types, self.columns = tolerance, max(1, tolerance), row_types, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", self.row_types)
        self.waiting = handle.getMapState("waiting", "bucket long", f"rows array<struct<{self.row_types.replace(' ', ':').replace(',:', ',')}>>")

    def handleInputRows(self, key, rows, timerValues):
        for frame in rows:
            buckets: dict[int, list[tuple]] = {}
            for row in zip(frame["ms"].tolist(), frame["side"].tolist(), frame["id"].tolist()):
                buckets.setdefault(row[0] // self.width, []).append(row)
            for ms in {row[0] for new in buckets.values() for row in new}:
                self.handle.registerTimer(ms + self.tolerance + 1)
            for bucket, new in buckets.items():
                known = self.waiting.getValue((bucket,))
                if known is None:
                    self.handle.registerTimer((bucket + 1) * self.width)
                self.waiting.updateValue((bucket,), ([*(map(tuple, known[0]) if known else ()), *new],))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # Timers come in order of time, so earlier buckets are done: only the timer's own and the one before can hold
        # rows up to its time.
        now = expiredTimerInfo.getExpiryTimeInMs()
        pending, out = self.pending.get() if self.pending.exists() else None, []
        before = pending
        for bucket in (now // self.width - 1, now // self.width):
            held = self.waiting.getValue((bucket,))
            if held is None:
                continue
            rows = sorted(map(tuple, held[0]))
            due = [r for r in rows if r[0] < now]
            if len(due) < len(rows):
                if due:
                    self.waiting.updateValue((bucket,), (rows[len(due):],))
            else:
                self.waiting.removeKey((bucket,))
            for row in due:
                if pending is not None and pending[1] != row[1] and row[0] - pending[0] <= self.tolerance:
                    pair = (pending, row) if row[1] else (row, pending)
                    out.append((*key, pair[0][2], pair[0][0], pair[1][2], pair[1][0], MATCHED))
                    pending = None
                    continue
                if pending is not None:
                    out.append(self._missing(key, pending))
                pending = row
        if pending is not None and pending[0] + self.tolerance < now:
            out.append(self._missing(key, pending))
            pending = None
        if pending is None:
            self.pending.clear()
        elif pending != before:
            self.pending.update(pending)
        yield from _frames(iter(out), self.columns)

    @staticmethod
    def _missing(key, row: tuple) -> tuple:
        if row[1]:
            return (*key, None, None, row[2], row[0], MISSING_APP)
        return (*key, row[2], row[0], None, None, MISSING_THIRD)

    def close(self) -> None:
        pass


def reconcile_state(app: DataFrame, third: DataFrame, keys: Sequence[str], tolerance: str | int,
                    delay: str = "0 seconds", ts: str = "ts", id_col: str = "event_id") -> DataFrame:
    """1:1 reconciliation with event-time timers, as the reference's keyed co-process.

    The stream form of ``operators.reconcile_one_to_one``, with its result:
    rows of a key are taken in event time (app before third, then id), however
    they arrive within ``delay``; one payment is pending; a row of the other
    side within ``tolerance`` is MATCHED with it, a timer at its deadline or a
    row that replaces it reports it missing.  A pair is emitted when the
    watermark passes the later row's bucket of time or the deadline.
    """
    keys, tol_ms = list(keys), to_micros(tolerance) // 1000
    tagged = [d.select(*keys, _event_time(ts).alias("_ts"), F.unix_millis(ts).alias("ms"), F.lit(s).alias("side"),
                       F.col(id_col).alias("id")).withWatermark("_ts", delay) for d, s in ((app, 0), (third, 1))]
    rows = tagged[0].unionByName(tagged[1]).where("ms is not null")
    id_type = app.schema[id_col].dataType
    schema = T.StructType([*_fields(app, keys), T.StructField(f"app_{id_col}", id_type), T.StructField("app_ms", T.LongType()),
                           T.StructField(f"third_{id_col}", id_type), T.StructField("third_ms", T.LongType()),
                           T.StructField("status", T.StringType())])
    row_types = f"ms bigint, side int, id {id_type.simpleString()}"
    return _with_state(rows, keys, _Payments(tol_ms, row_types, schema.names), schema)


class _ClockWindows(StatefulProcessor):
    """Counts of windows that the clock closes; state: a count per open window, a timer at each window's end."""

    def __init__(self, size: int, slide: int, columns: list[str]):
        self.size, self.slide, self.columns = size, slide, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "start long", "n long")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        for frame in rows:
            arrived = frame["arrived"].dropna().astype("int64").value_counts().to_dict()
            arrived[now] = arrived.get(now, 0) + int(frame["arrived"].isna().sum())
            new: dict[int, int] = {}
            for ms, n in arrived.items():
                last = ms // self.slide * self.slide
                for start in range(last, ms - self.size, -self.slide):
                    new[start] = new.get(start, 0) + n
            for start, n in new.items():
                if n:
                    known = self.open.getValue((start,))
                    if known is None:
                        self.handle.registerTimer(start + self.size)
                    self.open.updateValue((start,), (n + (known[0] if known else 0),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size
        known = self.open.getValue((start,))
        if known is not None:
            self.open.removeKey((start,))
            yield from _frames(iter([(start, start + self.size, *key, known[0])]), self.columns)

    def close(self) -> None:
        pass


class _ClockSessions(StatefulProcessor):
    """Sessions that the clock closes; state: (start, end, rows) of the open one, a timer at its end."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "start long, end long, n long")

    def handleInputRows(self, key, rows, timerValues):
        now = timerValues.getCurrentProcessingTimeInMs()
        open_, out = self.open.get() if self.open.exists() else None, []
        before = open_
        for frame in rows:
            arrived = frame["arrived"].fillna(now).astype("int64")
            for ms, gap in sorted(zip(arrived.tolist(), frame["gap"].tolist())):
                if gap <= 0:
                    continue
                if open_ is not None and ms <= open_[1]:
                    open_ = min(open_[0], ms), max(open_[1], ms + gap), open_[2] + 1
                    continue
                if open_ is not None:
                    out.append((open_[0], open_[1], *key, open_[2]))
                open_ = ms, ms + gap, 1
        if open_ is not None and open_ != before:
            if before is not None and before[1] != open_[1]:
                self.handle.deleteTimer(before[1])
            self.open.update(open_)
            self.handle.registerTimer(open_[1])
        yield from _frames(iter(out), self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.open.exists():
            start, end, n = self.open.get()
            if end <= expiredTimerInfo.getExpiryTimeInMs():
                self.open.clear()
                yield from _frames(iter([(start, end, *key, n)]), self.columns)

    def close(self) -> None:
        pass


def _clock(stream: DataFrame, keys: Sequence[str], arrival: str | None, processor, prefix: str, out: str,
           *more: Column) -> DataFrame:
    arrived = F.unix_millis(F.col(arrival)) if arrival else F.lit(None).cast("long")
    rows = stream.select(*keys, arrived.alias("arrived"), *more)
    names = [f"{prefix}_start", f"{prefix}_end"]
    schema = T.StructType([*[T.StructField(n, T.LongType()) for n in names], *_fields(stream, keys),
                           T.StructField(out, T.LongType())])
    closed = _with_state(rows, list(keys), processor(schema.names), schema, "ProcessingTime")
    return closed.withColumns({n: F.timestamp_millis(n) for n in names})


def processing_time_counts(stream: DataFrame, size: str, keys: Sequence[str], slide: str | None = None,
                           arrival: str | None = None, out: str = "n") -> DataFrame:
    """Counts per tumbling or sliding processing-time window and key, emitted when the clock passes the window's end.

    No later row is needed.  A row arrives when its micro-batch starts, or at
    the time in column ``arrival`` (see ``sources.stream_events``).
    """
    wide = to_micros(size) // 1000
    step = to_micros(slide) // 1000 if slide else wide
    return _clock(stream, keys, arrival, lambda names: _ClockWindows(wide, step, names), "window", out)


def processing_time_sessions(stream: DataFrame, gap: str | Column, keys: Sequence[str], arrival: str | None = None,
                             out: str = "n") -> DataFrame:
    """Sessions per key in processing time, emitted when the clock passes their end.

    ``gap`` is a duration, or a column of milliseconds (dynamic gap); a row
    extends its session to arrival + gap, rows without a gap form none.
    """
    ms = F.lit(to_micros(gap) // 1000) if isinstance(gap, str) else F.coalesce(gap.cast("long"), F.lit(0))
    return _clock(stream, keys, arrival, _ClockSessions, "session", out, ms.cast("long").alias("gap"))


class _Cogroup(StatefulProcessor):
    """Values of both sides of a (key, window), ranked by merging sorted runs; a timer at the window's end.

    State: runs (a chunk's values of one side, sorted, in blocks) and their number.
    """

    def __init__(self, value_type: str, tags: tuple[str, str], columns: list[str]):
        self.value_type, self.tags, self.columns = value_type, tags, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "n int")
        self.blocks = handle.getMapState("blocks", "run int, block int", f"side int, v array<{self.value_type}>")

    def handleInputRows(self, key, rows, timerValues):
        n = self.runs.get()[0] if self.runs.exists() else 0
        if not n:
            self.handle.registerTimer(key[-1])
        for frame in rows:
            for side, values in frame.groupby("side")["value"]:
                run = sorted((None if pd.isna(v) else v for v in values.tolist()), key=_nulls_first)
                for block in range(0, len(run), BLOCK):
                    self.blocks.updateValue((n, block // BLOCK), (int(side), run[block:block + BLOCK]))
                n += 1
        self.runs.update((n,))
        return iter(())

    def _run(self, run: int, first: list) -> Iterator:
        block, values = 0, first
        while values is not None:
            yield from values
            block += 1
            held = self.blocks.getValue((run, block))
            values = held[1] if held is not None else None

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        sides: dict[int, list[Iterator]] = {0: [], 1: []}
        for run in range(self.runs.get()[0]):
            side, values = self.blocks.getValue((run, 0))
            sides[side].append(self._run(run, values))
        for side, runs in sides.items():
            merged = enumerate(heapq.merge(*runs, key=_nulls_first), 1)
            yield from _frames(((*key, self.tags[side], rank, v) for rank, v in merged), self.columns)
        self.runs.clear()
        self.blocks.clear()

    def close(self) -> None:
        pass


def _nulls_first(value):
    return value is not None, value


def stream_window_cogroup_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], size: str, value: str, delay: str,
                               ts: str = "ts", left_tag: str = "app", right_tag: str = "third") -> DataFrame:
    """The stream form of ``operators.window_cogroup_rows``: side, rank in the side by value, value.

    A group's values wait in state as sorted runs.  At the window's end they
    are merged and emitted row by row, so no list of a whole group is ever in
    a row or in memory.
    """
    keys = list(keys)
    # The window is the event-time column: rows are late when their window is closed, not when they are old.
    wide = to_micros(size) // 1000
    end_ms = (F.floor(F.unix_millis(ts) / wide).cast("long") + 1) * wide
    sides = [d.select(*keys, F.col(value).alias("value"), _event_time(ts).alias("_ts"), end_ms.alias("end"), F.lit(s).alias("side"))
             .withWatermark("_ts", delay).withColumn("window", F.window("_ts", size)).drop("_ts")
             for d, s in ((left, 0), (right, 1))]
    rows = sides[0].unionByName(sides[1]).where("end is not null")
    value_type = left.schema[value].dataType
    schema = T.StructType([*_fields(left, keys), T.StructField("end", T.LongType()), T.StructField("side", T.StringType()),
                           T.StructField("rank", T.LongType()), T.StructField("value", value_type)])
    processor = _Cogroup(value_type.simpleString(), (left_tag, right_tag), schema.names)
    ranked = _with_state(rows, [*keys, "end"], processor, schema)
    end = F.timestamp_millis("end")
    start = F.timestamp_millis(F.col("end") - wide)
    return ranked.select(*keys, start.alias("window_start"), end.alias("window_end"), "side", "rank",
                         F.col("value").alias(value))
