"""Skew probe: a copy of ``events`` where one user holds a third of the rows.

Usage: python tools/skew_probe.py SF_DIR SCRATCH_DIR [copies]
Derives the skewed table with Spark (each row repeated ``copies`` times with
fresh ids, every third row moved to user 0), then compares the results of the
sequence operators with plain windows and times both, with the slowest task of
each from Spark's event log (written into SCRATCH_DIR).
"""
from __future__ import annotations

import glob
import json
import os
import sys
import time

import zstandard

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_times(log_dir: str) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for f in glob.glob(f"{log_dir}/*/events_*"):
        with open(f, "rb") as fh:
            text = zstandard.ZstdDecompressor().stream_reader(fh).read().decode()
        for line in text.splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                ti = e["Task Info"]
                out.setdefault(e["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    return out


def main() -> None:
    sf_dir, scratch = sys.argv[1], sys.argv[2]
    copies = int(sys.argv[3]) if len(sys.argv) > 3 else 30
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from clickflow.operators import count_window_sum, running_count, session_counts
    from clickflow.session import build_session
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                                         "spark.driver.memory": os.environ.get("PROBE_MEM", "8g")})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "ts")
    n = ev.count()
    skewed = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
              .select((F.col("event_id") + F.col("copy") * n).alias("event_id"),
                      F.when((F.col("event_id") + F.col("copy")) % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
                      .alias("user_id"),
                      (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("copy").cast("double")))
                      .alias("ts")))
    path = os.path.join(scratch, "events_skewed.parquet")
    skewed.repartition(16).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    total = df.count()
    hot = df.where("user_id = 0").count()
    print(f"rows={total} hot_user_rows={hot} ({hot / total:.0%})")

    def timed(label, build):
        """Run a plan in full."""
        before = set(task_times(log_dir))
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = {k: v for k, v in task_times(log_dir).items() if k not in before}
        worst = max(stages.items(), key=lambda kv: max(kv[1]))
        print(f"{label:10s} wall={wall:6.2f}s  slowest task={max(worst[1]) / 1000:.2f}s "
              f"(its stage: {len(worst[1])} tasks, median {sorted(worst[1])[len(worst[1]) // 2] / 1000:.2f}s)")

    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    valued = df.withColumn("v", F.col("event_id") % 10)
    key, order = ["user_id"], ["ts", "event_id"]
    plain_sessions = df.groupBy(F.session_window("ts", "30 minutes").alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    probes = {
        "running count": (running_count(df, key, order),
                          df.withColumn("n", F.count(F.lit(1)).over(by.rowsBetween(Window.unboundedPreceding, 0)))),
        "window sum": (count_window_sum(valued, key, order, "v", 10, 1),
                       valued.withColumn("total", F.sum("v").over(by.rowsBetween(-9, 0)))),
        "sessions": (session_counts(df, "30 minutes", key, tiebreak=["event_id"]),
                     plain_sessions.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"),
                                           "user_id", "n")),
    }

    def digest(d):
        h = F.xxhash64(*[F.col(c).cast("string") for c in sorted(d.columns)])
        return tuple(d.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())

    for name, (pieces, plain) in probes.items():
        print(f"{name}: results {'equal' if digest(pieces) == digest(plain) else 'DIFFER'}")
        for _ in range(2):
            timed("plain", lambda: plain)
            timed("pieces", lambda: pieces)
    spark.stop()


if __name__ == "__main__":
    main()
