"""Keyed state with timers: stream = batch for all windows, small state, chunks of rows, windows closed by the clock."""
import gc
import tempfile
import time
import weakref

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow import streaming as st
from clickflow.schemas import DRIVER_EVENTS
from clickflow.sources import app_side, end_folder, stream_events, third_side
from clickflow.streaming import timers
from conftest import SF001, rows
from streamutil import run_to_memory, write_batches


@pytest.fixture(scope="module")
def batch_events(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")


@pytest.fixture(scope="module")
def ended_dir(spark):
    """sf0.001 events in 3 files, rows shuffled inside each, then the end of the input."""
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values(["ts", "event_id"], ignore_index=True)
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    chunks = [pdf.iloc[j * len(pdf) // 3:(j + 1) * len(pdf) // 3].sample(frac=1.0, random_state=j) for j in range(3)]
    folder = write_batches(tempfile.mkdtemp(prefix="cf-end-"), chunks)
    end_folder(spark, folder, DRIVER_EVENTS, rows=[{"event_type": t} for t in ("click", "purchase", "view")])
    return folder


def _ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def test_topn_state_equals_batch_for_all_windows(spark, ended_dir, batch_events):
    s = stream_events(spark, ended_dir, max_files=1)
    got = _ntz(run_to_memory(st.stream_topn_state(s, "2 hours", "1 hour", "event_type", 2, "0 seconds")),
               "window_start", "window_end")
    counts = op.sliding_counts(batch_events, "2 hours", "1 hour", ["event_type"])
    want = op.topn_rows(counts, 2, ["window_start", "window_end"], ["event_type"])
    assert rows(got) == rows(want.select(*got.columns))


def test_reconcile_state_equals_batch_for_all_rows(spark, ended_dir, batch_events):
    s = stream_events(spark, ended_dir, max_files=1)
    got = run_to_memory(st.reconcile_state(app_side(s), third_side(s), ["user_id"], "8 hours"))
    want = op.reconcile_one_to_one(app_side(batch_events), third_side(batch_events), ["user_id"], "8 hours")
    assert {r.status for r in got.collect()} == {"MATCHED", "MISSING_APP", "MISSING_THIRD"}
    assert rows(got) == rows(want.select(*got.columns))


def test_cogroup_rows_equal_batch_for_all_windows(spark, ended_dir, batch_events, monkeypatch):
    monkeypatch.setattr(timers, "BLOCK", 2)
    s = stream_events(spark, ended_dir, max_files=1)
    got = _ntz(run_to_memory(st.stream_window_cogroup_rows(app_side(s), third_side(s), ["user_id"], "10 days", "event_id",
                                                           "0 seconds")), "window_start", "window_end")
    want = op.window_cogroup_rows(app_side(batch_events), third_side(batch_events), ["user_id"], "10 days", "event_id")
    assert rows(got) == rows(want.select(*got.columns))


class FakeState(dict):
    """The calls of the state API that the processors make, and how many entries are held at most."""

    def __init__(self):
        super().__init__()
        self.value, self.entries, self.most = None, [], 0

    exists = property(lambda self: lambda: self.value is not None)
    get = property(lambda self: lambda *_: iter(self.entries) if self.value is None else self.value)

    def update(self, value):
        self.value = value

    def put(self, entries):
        self.entries = entries
        self.most = max(self.most, len(entries))

    def getValue(self, key):
        return dict.get(self, key)

    def updateValue(self, key, value):
        self[key] = value
        self.most = max(self.most, len(self))

    def removeKey(self, key):
        self.pop(key)

    def clear(self):
        super().clear()
        self.value, self.entries = None, []


class FakeHandle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def _state(self, name, *_):
        return self.states.setdefault(name, FakeState())

    getValueState = getListState = getMapState = _state

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def fire(self, processor, key, until):
        """Expired timers in order, as Spark calls them after a micro-batch's rows."""
        out, due = [], sorted(t for t in self.timers if t <= until)
        self.timers -= set(due)
        for at in due:
            info = type("Info", (), {"getExpiryTimeInMs": lambda self, at=at: at})()
            out += [tuple(r) for frame in processor.handleExpiredTimer(key, None, info) for r in frame.itertuples(index=False)]
        return out


class Live:
    """Frames made one by one; the most that were alive at once."""

    def __init__(self, make, n):
        self.refs, self.most, self.make, self.n = [], 0, make, n

    def __iter__(self):
        for i in range(self.n):
            frame = self.make(i)
            self.refs.append(weakref.ref(frame))
            self.most = max(self.most, sum(r() is not None for r in self.refs))
            yield frame
            del frame


def test_topk_state_holds_k_entries():
    p, h = timers._TopK(3, ["start", "rk", "item", "n"]), FakeHandle()
    p.init(h)
    frames = Live(lambda i: pd.DataFrame({"item": [f"i{(i * 7 + j) % 1000:03d}" for j in range(500)],
                                          "n": [(i * 7 + j) % 1000 // 10 for j in range(500)]}), 40)
    assert list(p.handleInputRows((1000,), frames, None)) == []
    assert h.states["top"].most == 3 and frames.most <= 2
    assert h.fire(p, (1000,), 2000) == [(1000, 1, "i770", 77), (1000, 2, "i771", 77), (1000, 3, "i772", 77)]


def test_one_key_with_a_whole_backlog_in_chunks(spark):
    """50,000 payments of one key in one micro-batch: chunk after chunk, small state entries, the batch result."""
    n, tol = 50_000, 1000
    ms = [(i * 7919) % n * 40 for i in range(n)]      # every time once, far out of order
    side = [(m // 40 * 31 % 7) % 2 for m in ms]
    p, h = timers._Payments(tol, "ms bigint, side int, id bigint", ["k", "a", "ams", "b", "bms", "s"]), FakeHandle()
    p.init(h)
    frames = Live(lambda i: pd.DataFrame({"ms": ms[i * 1000:(i + 1) * 1000], "side": side[i * 1000:(i + 1) * 1000],
                                          "id": ms[i * 1000:(i + 1) * 1000]}), n // 1000)
    assert list(p.handleInputRows((5,), frames, None)) == []
    assert frames.most <= 2
    assert max(len(v[0]) for v in h.states["waiting"].values()) <= tol // 40 + 1
    got = h.fire(p, (5,), 10 ** 15)
    assert not h.states["waiting"] and h.states["pending"].value is None
    from test_sequence_skew import keyed_process
    want = keyed_process([(5, m, s, m) for m, s in zip(ms, side)], tol)
    clean = [tuple(None if pd.isna(v) else v for v in r) for r in got]
    assert sorted(clean, key=repr) == want


def test_a_payment_waits_until_its_own_deadline():
    p, h = timers._Payments(5000, "ms bigint, side int, id bigint", ["k", "a", "ams", "b", "bms", "s"]), FakeHandle()
    p.init(h)
    feed = lambda *r: list(p.handleInputRows((1,), [pd.DataFrame(r, columns=["ms", "side", "id"])], None))
    feed((1000, 0, 1))
    assert h.fire(p, (1,), 6000) == []                  # a partner at 6000 is in time
    feed((6000, 1, 2))
    assert h.fire(p, (1,), 6001) == [(1, 1, 1000, 2, 6000, "MATCHED")]
    feed((7000, 1, 3), (20_000, 0, 4))
    assert h.fire(p, (1,), 12_000) == []
    assert h.fire(p, (1,), 12_001) == [(1, None, None, 3, 7000, "MISSING_APP")]
    assert h.fire(p, (1,), 10 ** 9) == [(1, 4, 20_000, None, None, "MISSING_THIRD")]


def test_clock_windows_and_sessions():
    class Now:
        def __init__(self, ms):
            self.getCurrentProcessingTimeInMs = lambda: ms
    frame = lambda *a: [pd.DataFrame({"arrived": pd.array(a, dtype="Int64")})]
    p, h = timers._ClockWindows(10, 5, ["s", "e", "k", "n"]), FakeHandle()
    p.init(h)
    list(p.handleInputRows((1,), frame(None, None, 21), Now(23)))
    list(p.handleInputRows((1,), frame(None), Now(25)))
    assert h.fire(p, (1,), 24) == []
    assert h.fire(p, (1,), 25) == [(15, 25, 1, 3)]
    assert h.fire(p, (1,), 99) == [(20, 30, 1, 4), (25, 35, 1, 1)]
    assert not h.states["open"]
    p, h = timers._ClockSessions(["s", "e", "k", "n"]), FakeHandle()
    p.init(h)
    gaps = lambda gap, *a: [pd.DataFrame({"arrived": pd.array(a, dtype="Int64"), "gap": [gap] * len(a)})]
    list(p.handleInputRows((1,), gaps(10, None, 15), Now(12)))
    list(p.handleInputRows((1,), gaps(10, None), Now(25)))       # one gap after 15: the same session
    assert h.timers == {35}
    assert list(p.handleInputRows((1,), gaps(0, None), Now(26))) == []
    assert h.fire(p, (1,), 35) == [(12, 35, 1, 3)]
    list(p.handleInputRows((1,), gaps(5, 40, 41), Now(41)))
    out = [tuple(r) for f in p.handleInputRows((1,), gaps(5, 60), Now(60)) for r in f.itertuples(index=False)]
    assert out == [(40, 46, 1, 2)] and h.timers == {65}


@pytest.mark.parametrize("kind", ["window", "session"])
def test_a_processing_time_window_closes_without_another_row(spark, kind):
    pdf = pd.read_parquet(f"{SF001}/events.parquet").head(200)
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    folder = write_batches(tempfile.mkdtemp(prefix="cf-pt-"), [pdf])
    s = stream_events(spark, folder)
    out = (st.processing_time_counts(s, "2 seconds", ["user_id"]) if kind == "window"
           else st.processing_time_sessions(s, "2 seconds", ["user_id"]))
    name = f"pt_{kind}"
    q = (out.writeStream.format("memory").queryName(name).outputMode("append").trigger(processingTime="500 milliseconds")
         .option("checkpointLocation", tempfile.mkdtemp(prefix="cf-pt-ck-")).start())
    try:
        until = time.time() + 90
        while time.time() < until and (spark.table(name).agg(F.sum("n")).first()[0] or 0) < len(pdf):
            assert q.exception() is None
            time.sleep(0.5)
    finally:
        q.stop()
    want = sorted((int(k), int(n)) for k, n in pdf.groupby("user_id").size().items())
    assert sorted((r.user_id, r.n) for r in spark.table(name).collect()) == want
    wide = F.unix_millis(f"{kind}_end") - F.unix_millis(f"{kind}_start")
    assert {r[0] for r in spark.table(name).select(wide).collect()} == {2000}


def test_rocksdb_is_asked_for(spark, ended_dir):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            st.processing_time_counts(stream_events(spark, ended_dir), "2 seconds", ["user_id"])
    finally:
        spark.conf.set(name, old)
