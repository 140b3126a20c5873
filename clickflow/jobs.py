"""The reference's runnable jobs, re-expressed as Spark jobs.

Each function wires sources -> operators -> sink the way one of the
reference's ``main`` programs does, with the durations and keys as
parameters.  Streaming jobs return the started ``StreamingQuery``; batch jobs
return a DataFrame.  Event inputs are folders of parquet files in the driver's
``events`` layout (``sources.stream_events``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow import sinks
from clickflow import streaming as st
from clickflow.functions.text import pair_string
from clickflow.session import checkpoint_subdir
from clickflow.sources import app_side, as_click_events, read_jdbc, read_lines, stream_events, third_side


def batch_word_count(spark: SparkSession, path: str) -> DataFrame:
    """Text file -> (word, n)."""
    return op.word_count(read_lines(spark, path))


# Files a micro-batch may take: bounds the rows of one key that stateful Python sees at once.
MAX_FILES = 1000


def _start(df: DataFrame, name: str, checkpoint: str | None, mode: str = "append", sink: str = "console",
           available_now: bool = False, **options):
    w = (df.writeStream.format(sink).outputMode(mode)
         .option("checkpointLocation", checkpoint or checkpoint_subdir(df.sparkSession, f"job-{name}")))
    for k, v in options.items():
        w = w.option(k, v)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def count_window_to_text(spark: SparkSession, events_dir: str, out_dir: str, size: int = 2, slide: int = 1,
                         checkpoint: str | None = None, available_now: bool = False, max_files: int | None = MAX_FILES):
    """Events -> user pairs -> sliding count window per user -> '(user,n)' lines
    in hour-bucketed rolling text files."""
    ev = stream_events(spark, events_dir, max_files)
    counted = st.count_window_state(ev, ["user_id"], ["ts", "event_id"], size, slide)
    text = counted.select(pair_string(F.col("user_id").cast("string"), "n").alias("value"))
    return sinks.stream_text(text, out_dir, checkpoint=checkpoint, available_now=available_now)


def user_totals_to_jdbc(spark: SparkSession, events_dir: str, url: str, table: str = "usercount",
                        driver: str | None = None, checkpoint: str | None = None, available_now: bool = False,
                        max_files: int | None = MAX_FILES):
    """Events -> running count per user -> insert (username, count) rows over JDBC."""
    ev = stream_events(spark, events_dir, max_files)
    totals = st.running_count_state(ev, ["user_id"], ["ts", "event_id"]).select(
        F.col("user_id").cast("string").alias("username"), F.col("n").alias("count"))
    return sinks.stream_jdbc(totals, url, table, driver, checkpoint=checkpoint, available_now=available_now)


def topn_per_window(spark: SparkSession, events_dir: str, size: str = "10 seconds", slide: str = "5 seconds",
                    k: int = 2, delay: str = "3 seconds", checkpoint: str | None = None,
                    available_now: bool = False, max_files: int | None = MAX_FILES, sink: str = "console", **options):
    """Events -> top-k actions per sliding event-time window (two chained aggregations)."""
    ev = stream_events(spark, events_dir, max_files)
    top = st.stream_topn_array(ev, size, slide, "event_type", k, delay)
    out = top.select("window_start", "window_end", op.render_top("top").alias("top"))
    return _start(out, "topn", checkpoint, sink=sink, available_now=available_now, **options)


def split_stream(spark: SparkSession, events_dir: str, first: str = "click", second: str = "view",
                 checkpoint: str | None = None, available_now: bool = False, max_files: int | None = MAX_FILES,
                 sink: str = "console", **options):
    """Events -> text rows labelled by branch (tag1 / tag2 / main), as side outputs."""
    ev = as_click_events(stream_events(spark, events_dir, max_files))
    routed = op.route(op.event_text(ev), [(F.col("action") == first, "tag1"), (F.col("action") == second, "tag2")])
    return _start(routed.select("route", "value"), "split", checkpoint, sink=sink, available_now=available_now,
                  **options)


def merge_streams(spark: SparkSession, events_dir: str, first: str = "click", second: str = "view",
                  checkpoint: str | None = None, available_now: bool = False, max_files: int | None = MAX_FILES,
                  sink: str = "console", **options):
    """Events -> the two side branches merged with their prefixes; main dropped."""
    ev = op.event_text(as_click_events(stream_events(spark, events_dir, max_files)))
    merged = op.merge_routed(ev, [(F.col("action") == first, op.FIRST_PREFIX),
                                  (F.col("action") == second, op.SECOND_PREFIX)])
    return _start(merged, "merge", checkpoint, sink=sink, available_now=available_now, **options)


def _pay(spark, events_dir, max_files):
    ev = stream_events(spark, events_dir, max_files)
    return app_side(ev), third_side(ev)


def window_join(spark: SparkSession, events_dir: str, size: str = "5 seconds", delay: str = "0 seconds",
                checkpoint: str | None = None, available_now: bool = False, max_files: int | None = MAX_FILES,
                sink: str = "console", **options):
    a, b = _pay(spark, events_dir, max_files)
    return _start(st.stream_window_join(a, b, ["user_id"], size, delay), "window-join", checkpoint, sink=sink,
                  available_now=available_now, **options)


def window_cogroup(spark: SparkSession, events_dir: str, size: str = "10 seconds", delay: str = "0 seconds",
                   checkpoint: str | None = None, available_now: bool = False, max_files: int | None = MAX_FILES,
                   sink: str = "console", **options):
    a, b = _pay(spark, events_dir, max_files)
    cg = st.stream_window_cogroup(a, b, ["user_id"], size, "event_id", delay)
    return _start(cg, "cogroup", checkpoint, sink=sink, available_now=available_now, **options)


def interval_join(spark: SparkSession, events_dir: str, lower: str = "-5 seconds", upper: str = "10 seconds",
                  delay: str = "0 seconds", checkpoint: str | None = None, available_now: bool = False,
                  max_files: int | None = MAX_FILES, sink: str = "console", **options):
    a, b = _pay(spark, events_dir, max_files)
    return _start(st.stream_interval_join(a, b, ["user_id"], lower, upper, delay), "interval-join", checkpoint,
                  sink=sink, available_now=available_now, **options)


def reconcile(spark: SparkSession, events_dir: str, tolerance: str = "5 seconds", delay: str = "0 seconds",
              one_to_one: bool = False, checkpoint: str | None = None, available_now: bool = False,
              max_files: int | None = MAX_FILES, sink: str = "console", **options):
    """App vs third-party payments: MATCHED pairs and MISSING_* alerts once the
    watermark passes a row's time + tolerance.  ``one_to_one`` keeps one
    pending row per side and key, as the reference's co-process function."""
    a, b = _pay(spark, events_dir, max_files)
    out = (st.reconcile_state(a, b, ["user_id"], tolerance, delay) if one_to_one
           else st.stream_reconcile(a, b, ["user_id"], tolerance, delay))
    return _start(out, "reconcile", checkpoint, sink=sink, available_now=available_now, **options)


def jdbc_scan(spark: SparkSession, url: str, table: str = "eventinfo", driver: str | None = None,
              **partitioning) -> DataFrame:
    """The event table read over JDBC (user, action, times)."""
    return read_jdbc(spark, url, table, driver=driver, **partitioning)


STREAM_JOBS = {
    "count-window-text": count_window_to_text,
    "totals-jdbc": user_totals_to_jdbc,
    "topn": topn_per_window,
    "split": split_stream,
    "merge": merge_streams,
    "window-join": window_join,
    "cogroup": window_cogroup,
    "interval-join": interval_join,
    "reconcile": reconcile,
}
