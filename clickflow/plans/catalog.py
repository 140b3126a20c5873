"""The reference's jobs as queries over the driver tables.

Mapping (events): user <- user_id, action <- event_type, times <- ts in ms.
App payments are clicks, third-party payments purchases, keyed by user.
The driver's events are minutes apart, so durations are hours / days where
the reference used seconds; every duration is a parameter below.
Each function takes (spark, sf_dir) and returns a lazy DataFrame over the
whole tables.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow.functions.text import pair_string
from clickflow.functions.time import epoch_millis, ntz_from_millis
from clickflow.sources import app_side, as_click_events, document_lines, read_events, read_table, third_side

# Parameters of the registered queries.
SLIDE_SIZE, SLIDE_STEP = "2 hours", "1 hour"
TUMBLE_SIZE = "5 hours"
SESSION_GAP = "2 hours"
DYNAMIC_GAP_SECONDS_PER_CHAR = 1800
TOP_K = 2
COUNT_SLIDE = (2, 1)
COUNT_SLIDE_WIDE = (10, 5)
COUNT_TUMBLE = 10
INTERVAL_LOWER, INTERVAL_UPPER = "-1 hour", "2 hours"
JOIN_WINDOW = "1 day"
COGROUP_WINDOW = "1 day"
RECONCILE_TOLERANCE = "1 hour"
ROUTE_RULES = (("click", "tag1"), ("view", "tag2"))

USER = ["user_id"]
SEQ_ORDER = ["ts", "event_id"]


def _events(spark, sf_dir, *cols) -> DataFrame:
    ev = read_events(spark, sf_dir)
    return ev.select(*cols) if cols else ev


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.word_count(document_lines(read_table(spark, sf_dir, "documents")))


def event_scan(spark, sf_dir):
    return as_click_events(_events(spark, sf_dir))


def event_unpivot(spark, sf_dir):
    return op.unpivot_event(as_click_events(_events(spark, sf_dir)))


def user_pairs(spark, sf_dir):
    return op.user_pairs(as_click_events(_events(spark, sf_dir)))


def event_text(spark, sf_dir):
    return op.event_text(as_click_events(_events(spark, sf_dir))).select("event_id", "value")


def _routed(spark, sf_dir):
    ev = _events(spark, sf_dir, "event_id", "user_id", "event_type", "ts")
    return op.route(ev, [(F.col("event_type") == t, tag) for t, tag in ROUTE_RULES])


def route_events(spark, sf_dir):
    return _routed(spark, sf_dir).select("event_id", "user_id", "event_type", "route")


def merge_tagged(spark, sf_dir):
    """The two side-output branches (tag1, tag2) merged with their prefixes; main is dropped."""
    texted = op.event_text(as_click_events(_events(spark, sf_dir)))
    prefixes = {"tag1": op.FIRST_PREFIX, "tag2": op.SECOND_PREFIX}
    return op.merge_routed(texted, [(F.col("action") == t, prefixes[tag]) for t, tag in ROUTE_RULES])


def user_totals(spark, sf_dir):
    return _events(spark, sf_dir, "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def running_count(spark, sf_dir):
    return op.running_count(_events(spark, sf_dir, "user_id", "event_id", "ts"), USER, SEQ_ORDER)


def running_value_sum(spark, sf_dir):
    ev = _events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    ev = ev.withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = op.running_sum(ev, USER, SEQ_ORDER, "value", "total")
    return out.select("user_id", "event_id", "ts", F.col("total").cast("decimal(38,2)").alias("total"))


def count_window_sliding(spark, sf_dir):
    size, slide = COUNT_SLIDE
    return op.count_window_sliding(_events(spark, sf_dir, "user_id", "event_id", "ts"), USER, SEQ_ORDER,
                                   size, slide)


def count_window_sliding_10_5(spark, sf_dir):
    size, slide = COUNT_SLIDE_WIDE
    return op.count_window_sliding(_events(spark, sf_dir, "user_id", "event_id", "ts"), USER, SEQ_ORDER,
                                   size, slide)


def running_pair_text(spark, sf_dir):
    size, slide = COUNT_SLIDE
    counted = op.count_window_sliding(_events(spark, sf_dir, "user_id", "event_id", "ts"), USER, SEQ_ORDER,
                                      size, slide)
    return counted.select(pair_string("user_id", "n").alias("value"))


def count_window_sum(spark, sf_dir):
    size, slide = COUNT_SLIDE
    ev = _events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    ev = ev.withColumn("value", F.col("value").cast("decimal(18,2)"))
    out = op.count_window_sum(ev, USER, SEQ_ORDER, "value", size, slide, "total")
    return out.select("user_id", "event_id", "ts", F.col("total").cast("decimal(38,2)").alias("total"))


def count_window_tumbling(spark, sf_dir):
    return op.count_window_tumbling(_events(spark, sf_dir, "user_id", "event_id", "ts"), USER, SEQ_ORDER,
                                    COUNT_TUMBLE)


def tumbling_counts(spark, sf_dir):
    return op.tumbling_counts(_events(spark, sf_dir, "user_id", "ts"), TUMBLE_SIZE, USER)


def sliding_counts(spark, sf_dir):
    return op.sliding_counts(_events(spark, sf_dir, "event_type", "ts"), SLIDE_SIZE, SLIDE_STEP, ["event_type"])


def sliding_user_counts(spark, sf_dir):
    return op.sliding_counts(_events(spark, sf_dir, "user_id", "ts"), SLIDE_SIZE, SLIDE_STEP, USER)


def session_counts(spark, sf_dir):
    return op.session_counts(_events(spark, sf_dir, "user_id", "event_id", "ts"), SESSION_GAP, USER,
                             tiebreak=["event_id"])


def dynamic_session_counts(spark, sf_dir):
    ev = _events(spark, sf_dir, "user_id", "event_id", "event_type", "ts")
    gap = F.make_interval(secs=F.length("event_type") * DYNAMIC_GAP_SECONDS_PER_CHAR)
    return op.dynamic_session_counts(ev, gap, USER, tiebreak=["event_id"])


def topn_sliding(spark, sf_dir):
    counts = sliding_counts(spark, sf_dir)
    return op.topn_rows(counts, TOP_K, ["window_start", "window_end"], ["event_type"])


def topn_array(spark, sf_dir):
    counts = sliding_counts(spark, sf_dir)
    top = op.topn_array(counts, TOP_K, ["window_start", "window_end"], "event_type")
    return top.select("window_start", "window_end", op.render_top("top").alias("top"))


def _pay(spark, sf_dir):
    ev = _events(spark, sf_dir, "user_id", "event_id", "event_type", "ts")
    return app_side(ev), third_side(ev)


def window_join(spark, sf_dir):
    a, b = _pay(spark, sf_dir)
    return op.window_join(a, b, USER, JOIN_WINDOW)


def window_cogroup(spark, sf_dir):
    a, b = _pay(spark, sf_dir)
    return op.window_cogroup_rows(a, b, USER, COGROUP_WINDOW, "event_id")


def interval_join(spark, sf_dir):
    a, b = _pay(spark, sf_dir)
    return op.interval_join(a, b, USER, INTERVAL_LOWER, INTERVAL_UPPER)


def reconcile(spark, sf_dir):
    a, b = _pay(spark, sf_dir)
    return op.reconcile(a, b, USER, RECONCILE_TOLERANCE)


def reconcile_alerts(spark, sf_dir):
    a, b = _pay(spark, sf_dir)
    return op.reconcile_alerts(a, b, USER, RECONCILE_TOLERANCE)


def reconcile_one_to_one(spark, sf_dir):
    a, b = _pay(spark, sf_dir)
    return op.reconcile_one_to_one(a, b, USER, RECONCILE_TOLERANCE)


def event_time(spark, sf_dir):
    """``times`` (epoch ms) as the event-time column, its tumbling window, and back."""
    ev = as_click_events(_events(spark, sf_dir))
    timed = ev.withColumn("ts", ntz_from_millis("times"))
    return timed.select("event_id", "ts", F.window("ts", TUMBLE_SIZE).start.alias("window_start"),
                        epoch_millis("ts").alias("times"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "topn_sliding": topn_sliding,
    "sliding_counts": sliding_counts,
    "topn_array": topn_array,
    "word_count": word_count,
    "user_totals": user_totals,
    "running_count": running_count,
    "running_value_sum": running_value_sum,
    "event_scan": event_scan,
    "event_unpivot": event_unpivot,
    "user_pairs": user_pairs,
    "event_text": event_text,
    "running_pair_text": running_pair_text,
    "route_events": route_events,
    "merge_tagged": merge_tagged,
    "tumbling_counts": tumbling_counts,
    "sliding_user_counts": sliding_user_counts,
    "session_counts": session_counts,
    "dynamic_session_counts": dynamic_session_counts,
    "count_window_tumbling": count_window_tumbling,
    "count_window_sliding": count_window_sliding,
    "count_window_sliding_10_5": count_window_sliding_10_5,
    "count_window_sum": count_window_sum,
    "window_join": window_join,
    "window_cogroup": window_cogroup,
    "interval_join": interval_join,
    "reconcile": reconcile,
    "reconcile_alerts": reconcile_alerts,
    "reconcile_one_to_one": reconcile_one_to_one,
    "event_time": event_time,
}

FLAGSHIP = "topn_sliding"
