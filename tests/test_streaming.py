"""Streaming = batch on event files, late-data drop, and the stateful operators."""
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow import streaming as st
from clickflow.sources import app_side, stream_events, third_side
from clickflow.schemas import DRIVER_EVENTS
from conftest import SF001, rows
from streamutil import run_to_memory, write_batches


@pytest.fixture(scope="module")
def event_dir(spark):
    """sf0.001 events as 4 time-ordered files."""
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values(["ts", "event_id"], ignore_index=True)
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    chunks = [pdf.iloc[i::1].iloc[j * len(pdf) // 4:(j + 1) * len(pdf) // 4] for i in [0] for j in range(4)]
    folder = write_batches(tempfile.mkdtemp(prefix="cf-ev-"), chunks)
    return folder, pdf


@pytest.fixture(scope="module")
def batch_events(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")


def _stream(spark, folder):
    return stream_events(spark, folder, max_files=1)


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def test_sliding_counts_stream_equals_batch(spark, event_dir, batch_events):
    folder, pdf = event_dir
    got = run_to_memory(st.stream_sliding_counts(_stream(spark, folder), "2 hours", "1 hour", ["event_type"],
                                                 "0 seconds"))
    got = _ntz(got, "window_start", "window_end")
    wm = pdf["ts"].max()
    want = op.sliding_counts(batch_events, "2 hours", "1 hour", ["event_type"]).where(
        F.col("window_end") <= F.lit(wm).cast("timestamp_ntz"))
    assert got.count() > 0
    assert rows(got) == rows(want.select(*got.columns))


def test_topn_array_stream_equals_batch(spark, event_dir, batch_events):
    folder, pdf = event_dir
    got = run_to_memory(st.stream_topn_array(_stream(spark, folder), "2 hours", "1 hour", "event_type", 2,
                                             "0 seconds"))
    got = _ntz(got, "window_start", "window_end").select("window_start", op.render_top("top").alias("t"))
    counts = op.sliding_counts(batch_events, "2 hours", "1 hour", ["event_type"])
    want = (op.topn_array(counts, 2, ["window_start", "window_end"], "event_type")
            .where(F.col("window_end") <= F.lit(pdf["ts"].max()).cast("timestamp_ntz"))
            .select("window_start", op.render_top("top").alias("t")))
    assert got.count() > 0
    assert rows(got) == rows(want)


def test_joins_stream_equal_batch(spark, event_dir, batch_events):
    folder, _ = event_dir
    s = _stream(spark, folder)
    a_s, b_s = app_side(s), third_side(s)
    a_b, b_b = app_side(batch_events), third_side(batch_events)
    wj = _ntz(run_to_memory(st.stream_window_join(a_s, b_s, ["user_id"], "1 day", "0 seconds")),
              "window_start", "window_end", "app_ts", "third_ts")
    assert rows(wj) == rows(op.window_join(a_b, b_b, ["user_id"], "1 day").select(*wj.columns))
    ij = _ntz(run_to_memory(st.stream_interval_join(a_s, b_s, ["user_id"], "-1 hour", "2 hours", "0 seconds")),
              "app_ts", "third_ts")
    want = op.interval_join(a_b, b_b, ["user_id"], "-1 hour", "2 hours")
    assert ij.count() > 0
    assert rows(ij) == rows(want.select(*ij.columns))


def test_reconcile_stream_consistent_with_batch(spark, event_dir, batch_events):
    folder, _ = event_dir
    s = _stream(spark, folder)
    got = _ntz(run_to_memory(st.stream_reconcile(app_side(s), third_side(s), ["user_id"], "1 hour")),
               "app_ts", "third_ts")
    want = op.reconcile(app_side(batch_events), third_side(batch_events), ["user_id"], "1 hour").select(*got.columns)
    g, w = rows(got), set(rows(want))
    matched = [r for r in rows(want) if r[-1] == "MATCHED"]
    assert [r for r in g if r[-1] == "MATCHED"] == matched
    assert all(r in w for r in g)          # every alert emitted is a true alert
    assert sum(r[-1] != "MATCHED" for r in g) > 0


def test_cogroup_stream_equals_batch(spark, event_dir, batch_events):
    folder, pdf = event_dir
    s = _stream(spark, folder)
    got = _ntz(run_to_memory(st.stream_window_cogroup(app_side(s), third_side(s), ["user_id"], "1 day", "event_id",
                                                      "0 seconds")), "window_start", "window_end")
    want = op.window_cogroup(app_side(batch_events), third_side(batch_events), ["user_id"], "1 day", "event_id") \
        .where(F.col("window_end") <= F.lit(pdf["ts"].max()).cast("timestamp_ntz"))
    assert got.count() > 0
    assert rows(got) == rows(want.select(*got.columns))


def test_running_count_and_count_windows_state(spark, event_dir, batch_events):
    folder, _ = event_dir
    s = _stream(spark, folder)
    got = run_to_memory(st.running_count_state(s, ["user_id"], ["ts", "event_id"], carry=["event_id"]))
    want = op.running_count(batch_events.select("user_id", "event_id", "ts"), ["user_id"], ["ts", "event_id"])
    assert rows(got, "user_id", "event_id", "n") == rows(want, "user_id", "event_id", "n")
    got2 = run_to_memory(st.count_window_state(s, ["user_id"], ["ts", "event_id"], 2, 1, carry=["event_id"]))
    want2 = op.count_window_sliding(batch_events.select("user_id", "event_id", "ts"), ["user_id"],
                                    ["ts", "event_id"], 2, 1)
    assert rows(got2, "user_id", "event_id", "n") == rows(want2, "user_id", "event_id", "n")
    got3 = run_to_memory(st.count_window_state(s, ["user_id"], ["ts", "event_id"], 10, carry=["ts"]))
    want3 = op.count_window_tumbling(batch_events.select("user_id", "event_id", "ts"), ["user_id"],
                                     ["ts", "event_id"], 10)
    assert rows(_ntz(got3, "ts"), "user_id", "ts", "n") == rows(want3, "user_id", "end_ts", "n")


def _payments_dir(batches):
    frames = [pd.DataFrame(b, columns=["event_id", "ts", "user_id", "event_type", "value", "props"]) for b in batches]
    for f in frames:
        f["ts"] = pd.to_datetime(f["ts"], unit="ms").astype("datetime64[us]")
        f["event_id"] = f["event_id"].astype("int64")
        f["user_id"] = f["user_id"].astype("int64")
        f["value"] = f["value"].astype("float64")
    return write_batches(tempfile.mkdtemp(prefix="cf-pay-"), frames)


def test_reconcile_state_fixture(spark):
    # F3 payments: orders 1,2,3,6 as user ids; app = click, third = purchase.
    batch = [(1, 1000, 1, "click", 0.0, ""), (2, 2000, 2, "click", 0.0, ""), (3, 3000, 3, "click", 0.0, ""),
             (4, 10000, 3, "purchase", 0.0, ""), (5, 3000, 1, "purchase", 0.0, ""),
             (6, 4000, 2, "purchase", 0.0, ""), (7, 5000, 6, "purchase", 0.0, "")]
    sentinel = [(99, 10_000_000, 99, "view", 0.0, "")]   # moves both watermarks far ahead
    folder = _payments_dir([batch, [(98, 10_000_000, 98, "click", 0.0, ""), (97, 10_000_000, 97, "purchase", 0.0, "")],
                            sentinel])
    s = stream_events(spark, folder, max_files=1, schema=DRIVER_EVENTS)
    got = run_to_memory(st.reconcile_state(app_side(s), third_side(s), ["user_id"], "5 seconds"))
    res = sorted((r.user_id, r.status) for r in got.collect() if r.user_id < 90)
    assert res == [(1, "MATCHED"), (2, "MATCHED"), (3, "MISSING_APP"), (3, "MISSING_THIRD"), (6, "MISSING_APP")]


def test_late_row_is_dropped(spark):
    # 10 s / 5 s sliding counts with a 3 s delay; a row for [0,10) arriving two
    # batches after the watermark passed 10 s is dropped.
    t = lambda ms, eid, typ: (eid, ms, 1, typ, 0.0, "")
    folder = _payments_dir([[t(1000, 1, "click"), t(4999, 2, "click"), t(5000, 3, "view")],
                            [t(14000, 4, "view")],
                            [t(15000, 5, "view")],
                            [t(2000, 6, "click")],          # late: window [0,10) closed at watermark 11 s
                            [t(100_000, 7, "error")]])
    s = stream_events(spark, folder, max_files=1)
    got = run_to_memory(st.stream_sliding_counts(s, "10 seconds", "5 seconds", ["event_type"], "3 seconds"))
    got = {(r.window_start.second if r.window_start.minute == 0 else -1, r.event_type): r.n
           for r in _ntz(got, "window_start").collect()}
    assert got[(0, "click")] == 2        # the late click is not counted
    assert got[(0, "view")] == 1 and got[(5, "view")] == 2   # views at 5 s and 14 s


def test_processing_time_windows_and_update_totals(spark, event_dir):
    folder, pdf = event_dir
    s = st.with_processing_time(_stream(spark, folder))
    # Processing-time windows close only when later arrivals move the
    # watermark, so read them in update mode: the last count of each window.
    tumbling = run_to_memory(op.tumbling_counts(s, "5 seconds", ["user_id"], ts="arrival_ts"), mode="update")
    last = tumbling.groupBy("window_start", "user_id").agg(F.max("n").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == len(pdf)   # every row in exactly one arrival window
    totals = run_to_memory(st.stream_user_totals(_stream(spark, folder), ["user_id"]), mode="update")
    final = totals.groupBy("user_id").agg(F.max("n").alias("n"))
    assert dict(rows(final)) == {int(k): int(v) for k, v in pdf.groupby("user_id").size().items()}


def test_stream_reconcile_fixture_equals_batch(spark):
    batch = [(1, 1000, 1, "click", 0.0, ""), (2, 2000, 2, "click", 0.0, ""), (3, 3000, 3, "click", 0.0, ""),
             (4, 10000, 3, "purchase", 0.0, ""), (5, 3000, 1, "purchase", 0.0, ""),
             (6, 4000, 2, "purchase", 0.0, ""), (7, 5000, 6, "purchase", 0.0, "")]
    sentinel = [(98, 10_000_000, 98, "click", 0.0, ""), (97, 10_000_000, 98, "purchase", 0.0, "")]
    folder = _payments_dir([batch, sentinel, [(96, 20_000_000, 96, "view", 0.0, "")]])
    s = stream_events(spark, folder, max_files=1)
    got = run_to_memory(st.stream_reconcile(app_side(s), third_side(s), ["user_id"], "5 seconds"))
    res = sorted(((r.user_id, r.app_event_id or -1, r.third_event_id or -1, r.status) for r in got.collect()
                  if r.user_id < 90))
    assert res == [(1, 1, 5, "MATCHED"), (2, 2, 6, "MATCHED"), (3, -1, 4, "MISSING_APP"),
                   (3, 3, -1, "MISSING_THIRD"), (6, -1, 7, "MISSING_APP")]


def test_event_scan_stream_equals_batch_in_any_time_zone(spark, event_dir, batch_events):
    from clickflow.sources import as_click_events
    folder, _ = event_dir
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        got = run_to_memory(as_click_events(_stream(spark, folder)))
        assert rows(got) == rows(as_click_events(batch_events))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_topn_stream_click_fixture_edges_ties_late(spark):
    """10 s / 5 s windows, 3 s delay, top 2 by count desc then action asc."""
    click, view, buy, count, duck, blah = "点击", "浏览", "买东西", "数数", "数鸭子", "阿巴阿巴"
    e = lambda ms, eid, a: (eid, ms, 1, a, 0.0, "")
    folder = _payments_dir([
        [e(0, 1, click), e(4999, 2, view), e(5000, 3, click), e(9999, 4, view)],
        [e(10000, 5, buy), e(12000, 6, buy), e(13000, 7, count)],
        [e(14000, 8, count), e(50000, 9, duck)],       # spacer, moves the watermark to 47 s
        [e(2000, 10, click)],                          # late for [-5,5) and [0,10): dropped
        [e(100000, 11, blah)],                         # sentinel closes everything up to 97 s
    ])
    s = stream_events(spark, folder, max_files=1)
    got = run_to_memory(st.stream_topn_array(s, "10 seconds", "5 seconds", "event_type", 2, "3 seconds"))
    res = sorted((int(r.window_start.timestamp()) if r.window_start.year >= 1970 else -5, r.t)
                 for r in got.select("window_start", op.render_top("top").alias("t")).collect())
    assert res == [(-5, f"{view}:1,{click}:1"), (0, f"{view}:2,{click}:2"), (5, f"{buy}:2,{count}:2"),
                   (10, f"{buy}:2,{count}:2"), (45, f"{duck}:1"), (50, f"{duck}:1")]


@pytest.mark.parametrize("seed", [11, 12])
def test_out_of_order_within_delay_gives_same_result(spark, batch_events, seed):
    """SURVEY 5(d): rows shuffled inside files and the tail of each file moved
    to the next micro-batch (delay 30 min < watermark delay 1 h): the closed
    windows equal the batch result."""
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values(["ts", "event_id"], ignore_index=True)
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    chunks = [pdf.iloc[j * len(pdf) // 4:(j + 1) * len(pdf) // 4].copy() for j in range(4)]
    for j in range(3):
        tail = chunks[j]["ts"] > chunks[j]["ts"].max() - pd.Timedelta(minutes=30)
        chunks[j + 1] = pd.concat([chunks[j][tail], chunks[j + 1]])
        chunks[j] = chunks[j][~tail]
    chunks = [c.sample(frac=1.0, random_state=seed) for c in chunks]
    folder = write_batches(tempfile.mkdtemp(prefix="cf-ooo-"), chunks)
    got = run_to_memory(st.stream_sliding_counts(_stream(spark, folder), "2 hours", "1 hour", ["user_id"], "1 hour"))
    got = _ntz(got, "window_start", "window_end")
    closed = pdf["ts"].max() - pd.Timedelta(hours=1)
    want = op.sliding_counts(batch_events, "2 hours", "1 hour", ["user_id"]).where(
        F.col("window_end") <= F.lit(closed).cast("timestamp_ntz"))
    assert got.count() > 0
    assert rows(got) == rows(want.select(*got.columns))


def test_count_window_state_sums_a_field(spark, event_dir, batch_events):
    folder, _ = event_dir
    s = _stream(spark, folder).withColumn("value", F.col("value").cast("decimal(18,2)"))
    got = run_to_memory(st.count_window_state(s, ["user_id"], ["ts", "event_id"], 3, 2, carry=["event_id"],
                                              value="value", out="total"))
    b = batch_events.withColumn("value", F.col("value").cast("decimal(18,2)"))
    want = op.count_window_sum(b, ["user_id"], ["ts", "event_id"], "value", 3, 2)
    assert got.count() > 0
    assert rows(got, "user_id", "event_id", "total") == rows(want, "user_id", "event_id", "total")


def test_running_sum_state(spark, event_dir, batch_events):
    folder, _ = event_dir
    s = _stream(spark, folder).withColumn("value", F.col("value").cast("decimal(18,2)"))
    got = run_to_memory(st.running_count_state(s, ["user_id"], ["ts", "event_id"], carry=["event_id"],
                                               out="total", value="value"))
    b = batch_events.withColumn("value", F.col("value").cast("decimal(18,2)"))
    want = op.running_sum(b, ["user_id"], ["ts", "event_id"], "value", "total")
    assert rows(got, "user_id", "event_id", "total") == rows(want, "user_id", "event_id", "total")


@pytest.mark.parametrize("dynamic", [False, True])
def test_session_counts_stream_equals_batch(spark, event_dir, batch_events, dynamic):
    folder, pdf = event_dir
    gap = F.make_interval(secs=F.length("event_type") * 1800) if dynamic else "2 hours"
    got = _ntz(run_to_memory(st.stream_session_counts(_stream(spark, folder), gap, ["user_id"], "0 seconds")),
               "session_start", "session_end")
    batch = (op.dynamic_session_counts(batch_events, gap, ["user_id"], tiebreak=["event_id"]) if dynamic
             else op.session_counts(batch_events, gap, ["user_id"], tiebreak=["event_id"]))
    want = batch.where(F.col("session_end") <= F.lit(pdf["ts"].max()).cast("timestamp_ntz"))
    assert got.count() > 0
    assert rows(got) == rows(want.select(*got.columns))


def test_console_print_with_label(spark, event_dir):
    folder, pdf = event_dir
    q = st.console(_stream(spark, folder).select("user_id", "event_type"), label="main",
                   checkpoint=tempfile.mkdtemp(prefix="cf-con-"), available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(pdf)
