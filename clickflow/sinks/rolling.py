"""Rolling text sink: parts per bucket that roll by age, idle time or bytes, each row once.

A part is one or more files ``<bucket>/part-<number>-<file>``.  Rows of an
open part wait in hidden files, as the in-progress files of the reference's
sink do, and become visible when the part rolls: 15 minutes after its first
row, 5 minutes after its last, or at 1 GiB.

Two phases, on Spark's Python Data Source API.  A task writes its rows of a
micro-batch to new hidden files and returns their names: nothing is shared
between tasks or attempts, and what a lost task leaves is never named.  The
driver then records the micro-batch in a log of numbered states (a few lines a
bucket; rows never pass the driver) and renames the files of parts that
rolled.  A repeated micro-batch finds itself in the log, and its files are
deleted.  A crash between log and renames is made good by the next commit.

Micro-batches only come with rows, so an idle part rolls when ``roll_due``
runs; ``RollOnIdle`` calls it whenever the stream has nothing to do.
``path`` is a folder that all machines share.
"""
from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQueryListener

from clickflow.session import checkpoint_subdir
from clickflow.sinks.text import arrival_bucket

NAME = "clickflow_rolling_text"

# The reference's rolling policy.
ROLL_AGE = 15 * 60
ROLL_IDLE = 5 * 60
ROLL_BYTES = 1 << 30


def _local(path: str) -> str:
    return path[len("file:"):].replace("//", "/", 1) if path.startswith("file:") else path


@dataclass
class Staged(WriterCommitMessage):
    """Hidden files of a task: (bucket, name, bytes)."""
    files: list[tuple[str, str, int]]


class Parts:
    """The open parts of a folder: a log of states, and the renames that a state asks for."""

    def __init__(self, path: str, age: float = ROLL_AGE, idle: float = ROLL_IDLE, size: int = ROLL_BYTES,
                 clock: Callable[[], float] = time.time):
        self.path, self.age, self.idle, self.size, self.clock = _local(path), age, idle, size, clock
        self.staged, self.log = (os.path.join(self.path, "_rolling", d) for d in ("staged", "log"))
        os.makedirs(self.staged, exist_ok=True)
        os.makedirs(self.log, exist_ok=True)

    def _state(self) -> tuple[int, dict]:
        versions = sorted(int(n.split(".")[0]) for n in os.listdir(self.log) if n.endswith(".json"))
        if not versions:
            return 0, {"batch": -1, "next": 0, "open": {}, "publish": []}
        with open(os.path.join(self.log, f"{versions[-1]}.json"), encoding="utf-8") as f:
            return versions[-1], json.load(f)

    def _record(self, version: int, state: dict) -> bool:
        """Write a state under its number, whole or not at all; False if another writer took the number."""
        draft = os.path.join(self.log, f".{uuid.uuid4().hex}")
        with open(draft, "w", encoding="utf-8") as f:
            json.dump(state, f)
        try:
            os.link(draft, os.path.join(self.log, f"{version}.json"))
        except FileExistsError:
            return False
        finally:
            os.remove(draft)
        for old in os.listdir(self.log):  # the last states suffice
            if old.endswith(".json") and int(old.split(".")[0]) < version - 10:
                os.remove(os.path.join(self.log, old))
        return True

    def _publish(self, state: dict) -> None:
        for name, target in state["publish"]:
            hidden, shown = os.path.join(self.staged, name), os.path.join(self.path, target)
            if os.path.exists(hidden):
                os.makedirs(os.path.dirname(shown), exist_ok=True)
                os.replace(hidden, shown)

    @staticmethod
    def _close(state: dict, bucket: str) -> None:
        part = state["open"].pop(bucket)
        state["publish"] += [[name, f"{bucket}/part-{part['number']}-{i}"] for i, name in enumerate(part["files"])]

    def _update(self, batch: int | None, files: list[tuple[str, str, int]], everything: bool = False) -> None:
        while True:
            version, state = self._state()
            self._publish(state)
            if batch is not None and batch <= state["batch"]:
                self.discard(files)
                return
            now = self.clock()
            state["publish"] = []
            if batch is not None:
                state["batch"] = batch
            for bucket, part in list(state["open"].items()):
                if everything or now - part["opened"] >= self.age or now - part["written"] >= self.idle:
                    self._close(state, bucket)
            for bucket, name, size in files:
                part = state["open"].get(bucket)
                if part is None:
                    part = state["open"][bucket] = {"number": state["next"], "files": [], "bytes": 0, "opened": now}
                    state["next"] += 1
                part["files"].append(name)
                part["bytes"] += size
                part["written"] = now
                if part["bytes"] >= self.size:
                    self._close(state, bucket)
            if batch is None and not state["publish"]:
                return
            if self._record(version + 1, state):
                self._publish(state)
                return

    def commit(self, batch: int, files: list[tuple[str, str, int]]) -> None:
        """Add the files of a micro-batch to the open parts, once, and roll what is due."""
        self._update(batch, files)

    def roll_due(self) -> None:
        """Roll parts that are old or idle by the clock."""
        self._update(None, [])

    def close(self) -> None:
        """Roll every part: the end of the stream."""
        self._update(None, [], everything=True)

    def discard(self, files: list[tuple[str, str, int]]) -> None:
        for _, name, _ in files:
            if os.path.exists(os.path.join(self.staged, name)):
                os.remove(os.path.join(self.staged, name))

    def stage(self, rows: Iterator[tuple[str, str]]) -> list[tuple[str, str, int]]:
        """Write (bucket, line) rows to new hidden files, none much above the part size."""
        os.makedirs(self.staged, exist_ok=True)
        open_, done = {}, []

        def shut(bucket: str) -> None:
            name, f = open_.pop(bucket)
            done.append((bucket, name, f.tell()))
            f.close()
        try:
            for bucket, line in rows:
                if bucket not in open_:
                    name = uuid.uuid4().hex
                    open_[bucket] = name, open(os.path.join(self.staged, name), "xb")
                f = open_[bucket][1]
                f.write(line.encode("utf-8") + b"\n")
                if f.tell() >= self.size:
                    shut(bucket)
            for bucket in list(open_):
                shut(bucket)
        except BaseException:
            for name, f in open_.values():
                f.close()
                done.append(("", name, 0))
            self.discard(done)
            raise
        return done


class RollingText(DataSource):
    """Options: path, age and idle in seconds, bytes.  Columns: bucket, value."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema, overwrite: bool) -> "RollingWriter":
        o = self.options
        return RollingWriter(o["path"], float(o.get("age", ROLL_AGE)), float(o.get("idle", ROLL_IDLE)),
                             int(o.get("bytes", ROLL_BYTES)))


class RollingWriter(DataSourceStreamWriter):
    def __init__(self, *policy):
        self.policy = policy

    def write(self, iterator) -> Staged:
        return Staged(Parts(*self.policy).stage((r["bucket"], r["value"]) for r in iterator))

    def commit(self, messages, batchId: int) -> None:
        Parts(*self.policy).commit(batchId, [f for m in messages if m is not None for f in m.files])

    def abort(self, messages, batchId: int) -> None:
        Parts(*self.policy).discard([f for m in messages if m is not None for f in m.files])


class RollOnIdle(StreamingQueryListener):
    """Rolls what is due while the stream ``query_id`` (any, if None) waits for rows."""

    def __init__(self, parts: Parts, query_id: str | None = None):
        self.parts, self.query_id = parts, query_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        if self.query_id is None or str(event.id) == self.query_id:
            self.parts.roll_due()

    def onQueryTerminated(self, event) -> None:
        pass


def stream_rolling_text(df: DataFrame, path: str, text_col: str = "value", checkpoint: str | None = None,
                        trigger: str = "1 minute", age: float = ROLL_AGE, idle: float = ROLL_IDLE,
                        max_bytes: int = ROLL_BYTES, available_now: bool = False):
    """Start a stream of text lines into rolling parts, in hourly buckets of arrival; returns the StreamingQuery.

    A null line is an empty line.  Idle parts roll while the query waits, by a
    listener on the session; after the last micro-batch of a bounded stream,
    ``Parts(path).close()`` makes the open parts visible.
    """
    spark = df.sparkSession
    spark.dataSource.register(RollingText)
    rows = df.select(F.concat(F.lit("bucket="), arrival_bucket()).alias("bucket"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("value"))
    ckpt = checkpoint or checkpoint_subdir(spark, "rolling-text-" + path.strip("/").replace("/", "_"))
    w = (rows.writeStream.format(NAME).option("path", path).option("age", str(age)).option("idle", str(idle))
         .option("bytes", str(max_bytes)).option("checkpointLocation", ckpt).outputMode("append"))
    query = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)).start()
    if not available_now:
        spark.streams.addListener(RollOnIdle(Parts(path, age, idle, max_bytes), query.id))
    return query
