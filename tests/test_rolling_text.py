"""Rolling text parts: each of the three rolls, repeated and lost micro-batches, and a stream end to end."""
import json
import os
import tempfile
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickflow import sinks
from clickflow.sinks import rolling
from clickflow.sources import stream_events
from conftest import SF001
from streamutil import write_batches

B = "bucket=2024-01-01--10"


class Clock:
    now = 1000.0

    def __call__(self):
        return self.now


@pytest.fixture
def folder(tmp_path):
    clock = Clock()
    return rolling.Parts(str(tmp_path / "out"), age=900, idle=300, size=100, clock=clock), clock


def shown(parts):
    return {f"{d}/{n}": open(os.path.join(parts.path, d, n)).read() for d in os.listdir(parts.path) if d != "_rolling"
            for n in os.listdir(os.path.join(parts.path, d))}


def lines(parts):
    return sorted(line for text in shown(parts).values() for line in text.splitlines())


def test_a_part_rolls_by_age(folder):
    parts, clock = folder
    for i in range(5):
        parts.commit(i, parts.stage([(B, f"r{i}")]))
        assert shown(parts) == {}
        clock.now += 200
    parts.commit(5, parts.stage([(B, "late")]))     # 1000 s after the first row
    assert lines(parts) == ["r0", "r1", "r2", "r3", "r4"]
    assert {n.rsplit("-", 1)[0] for n in shown(parts)} == {f"{B}/part-0"}


def test_a_part_rolls_when_idle(folder):
    parts, clock = folder
    parts.commit(0, parts.stage([(B, "a"), ("bucket=x", "b")]))
    clock.now += 299
    parts.roll_due()
    assert shown(parts) == {}
    clock.now += 1
    parts.roll_due()
    assert lines(parts) == ["a", "b"] and len(shown(parts)) == 2
    parts.commit(1, parts.stage([(B, "c")]))
    clock.now += 300
    parts.commit(2, parts.stage([("bucket=x", "d")]))
    assert lines(parts) == ["a", "b", "c"]


def test_a_part_rolls_by_size(folder):
    parts, clock = folder
    parts.commit(0, parts.stage([(B, "x" * 59)]))
    assert shown(parts) == {}
    parts.commit(1, parts.stage([(B, "y" * 39)]))   # 60 + 40 bytes
    assert sorted(shown(parts)) == [f"{B}/part-0-0", f"{B}/part-0-1"]
    parts.commit(2, parts.stage((B, "z" * 9) for _ in range(25)))
    sizes = [len(t) for n, t in shown(parts).items() if "part-0" not in n]
    assert sizes == [100, 100] and max(sizes) <= 100
    parts.close()
    assert len(lines(parts)) == 27


def test_a_repeated_micro_batch_adds_nothing(folder):
    parts, clock = folder
    parts.commit(0, parts.stage([(B, "a")]))
    parts.commit(0, parts.stage([(B, "a")]))
    parts.commit(1, parts.stage([(B, "b")]))
    parts.commit(0, parts.stage([(B, "a")]))
    parts.close()
    assert lines(parts) == ["a", "b"] and os.listdir(parts.staged) == []


def test_a_crash_between_log_and_rename_is_made_good(folder, monkeypatch):
    parts, clock = folder
    parts.commit(0, parts.stage([(B, "x" * 98)]))
    replace, calls = os.replace, []

    def broken(a, b):
        calls.append(a)
        raise OSError("the driver is gone")
    monkeypatch.setattr(rolling.os, "replace", broken)
    with pytest.raises(OSError):
        parts.commit(1, parts.stage([(B, "y")]))
    assert calls and shown(parts) == {}
    monkeypatch.setattr(rolling.os, "replace", replace)
    again = rolling.Parts(parts.path, 900, 300, 100, clock)     # a new driver repeats the micro-batch
    again.commit(1, again.stage([(B, "y")]))
    assert lines(again) == sorted(["x" * 98, "y"]) and os.listdir(parts.staged) == []


def test_files_of_lost_tasks_never_show(folder):
    parts, clock = folder
    parts.stage([(B, "of a task whose executor was lost")])
    kept = parts.stage([(B, "a")])

    def failing():
        yield B, "half"
        raise RuntimeError("task")
    with pytest.raises(RuntimeError):
        parts.stage(failing())
    parts.commit(0, kept)
    parts.close()
    assert lines(parts) == ["a"] and len(os.listdir(parts.staged)) == 1


def test_two_writers_of_the_log(folder, monkeypatch):
    """The listener and a commit at the same time: the one that comes second looks again."""
    parts, clock = folder
    parts.commit(0, parts.stage([(B, "a")]))
    record, raced = parts._record, []

    def slow(version, state):
        if not raced:
            raced.append(1)
            rolling.Parts(parts.path, 900, 300, 100, clock).close()
        return record(version, state)
    monkeypatch.setattr(parts, "_record", slow)
    parts.commit(1, parts.stage([(B, "b")]))
    assert lines(parts) == ["a"]
    parts.close()
    assert lines(parts) == ["a", "b"]
    states = [json.load(open(os.path.join(parts.log, n))) for n in os.listdir(parts.log)]
    assert max(s["batch"] for s in states) == 1


def _stream(spark, n_files=4):
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values("ts")
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    step = -(-len(pdf) // n_files)
    folder = write_batches(tempfile.mkdtemp(prefix="cf-roll-"), [pdf.iloc[i:i + step] for i in range(0, len(pdf), step)])
    text = F.concat(F.lit("("), F.col("event_id").cast("string"), F.lit(",é)"))
    return stream_events(spark, folder, max_files=1).select(text.alias("value")), len(pdf)


def test_stream_in_parts_of_bounded_size(spark):
    df, n = _stream(spark)
    out = tempfile.mkdtemp(prefix="cf-roll-out-")
    q = sinks.stream_rolling_text(df, out, checkpoint=tempfile.mkdtemp(prefix="cf-roll-ck-"), max_bytes=2000,
                                  available_now=True)
    q.awaitTermination(120)
    assert q.exception() is None
    before = spark.read.text(out).count()
    assert 0 < before < n                                   # the open parts are hidden
    sinks.Parts(out, size=2000).close()
    back = spark.read.text(out)
    assert back.count() == n and back.select("value").distinct().count() == n
    assert all(d.startswith("bucket=20") for d in os.listdir(out) if not d.startswith("_"))


def test_an_idle_part_rolls_while_the_stream_waits(spark):
    df, n = _stream(spark, 1)
    out = tempfile.mkdtemp(prefix="cf-idle-out-")
    q = sinks.stream_rolling_text(df, out, checkpoint=tempfile.mkdtemp(prefix="cf-idle-ck-"), trigger="1 second", idle=3)
    try:
        until, seen = time.time() + 90, 0
        while time.time() < until and seen < n:
            assert q.exception() is None
            time.sleep(0.5)
            seen = spark.read.text(out).count() if any(d.startswith("bucket") for d in os.listdir(out)) else 0
    finally:
        q.stop()
    assert seen == n
