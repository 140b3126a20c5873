"""Text and JDBC sinks; JDBC scan.  JDBC runs against Spark's own in-memory
Derby (no server, no port)."""
import glob
import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickflow import sinks
from clickflow import streaming as st
from clickflow.sinks import jdbc
from clickflow.sources import as_click_events, read_jdbc, read_lines, stream_events
from conftest import SF001, rows
from streamutil import write_batches

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_text_sink_roundtrip_and_buckets(spark):
    ev = as_click_events(spark.read.parquet(f"{SF001}/events.parquet"))
    texted = ev.select(F.concat(F.lit("("), "user", F.lit(","), F.col("times").cast("string"), F.lit(")")).alias("value"))
    out = tempfile.mkdtemp(prefix="cf-text-")
    sinks.write_text(texted, out, mode="overwrite", bucket=True, max_records_per_file=100)
    buckets = [d for d in os.listdir(out) if d.startswith("bucket=")]
    assert len(buckets) >= 1
    assert len(glob.glob(f"{out}/bucket=*/part-*")) >= texted.count() // 100
    back = read_lines(spark, out).select("value")
    assert rows(back) == rows(texted)


def test_stream_text_sink(spark):
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values("ts")
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    folder = write_batches(tempfile.mkdtemp(prefix="cf-sev-"), [pdf.iloc[:500], pdf.iloc[500:]])
    s = stream_events(spark, folder, max_files=1)
    counted = st.count_window_state(s, ["user_id"], ["ts", "event_id"], 2, 1)
    text = counted.select(F.concat(F.lit("("), F.col("user_id").cast("string"), F.lit(","),
                                   F.col("n").cast("string"), F.lit(")")).alias("value"))
    out, ckpt = tempfile.mkdtemp(prefix="cf-stext-"), tempfile.mkdtemp(prefix="cf-stext-ck-")
    q = sinks.stream_text(text, out, checkpoint=ckpt, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    assert spark.read.text(out).count() == len(pdf)


def test_jdbc_append_and_partitioned_scan(spark):
    url = "jdbc:derby:memory:cf_scan;create=true"
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    info = as_click_events(ev).select("user", "action", "times")
    sinks.write_jdbc_append(info, url, "eventinfo", DERBY)
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    back = read_jdbc(spark, url, "eventinfo", driver=DERBY, partition_column="times",
                     lower_bound=int(lo.timestamp() * 1000), upper_bound=int(hi.timestamp() * 1000) + 1,
                     num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert rows(back) == rows(info)
    # filters and projections are pushed into the JDBC queries
    plan = back.where(F.col("action") == "click").select("user")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "action" in plan


def test_stream_running_totals_to_jdbc(spark):
    url = "jdbc:derby:memory:cf_sink;create=true"
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values("ts")
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    folder = write_batches(tempfile.mkdtemp(prefix="cf-jev-"), [pdf.iloc[:300], pdf.iloc[300:700], pdf.iloc[700:]])
    s = stream_events(spark, folder, max_files=1)
    totals = st.running_count_state(s, ["user_id"], ["ts", "event_id"]).select(
        F.col("user_id").cast("string").alias("username"), F.col("n").cast("int").alias("count"))
    q = sinks.stream_jdbc(totals, url, "usercount", DERBY, checkpoint=tempfile.mkdtemp(prefix="cf-jck-"),
                          available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    back = read_jdbc(spark, url, "usercount", driver=DERBY)
    assert back.count() == len(pdf)                       # insert only: one row per input row
    final = dict(rows(back.groupBy("username").agg(F.max("count"))))
    want = pdf.groupby("user_id").size()
    assert final == {str(k): int(v) for k, v in want.items()}


def _insert(spark, url, rows_, batch_id, **kw):
    batch = spark.createDataFrame(rows_, "username string, count int").repartition(2)
    sinks.foreach_batch_jdbc(url, "usercount", DERBY, backoff_seconds=0.01, query="q", **kw)(batch, batch_id)


def _held(spark, url, table="usercount"):
    return rows(read_jdbc(spark, url, table, driver=DERBY))


@pytest.mark.parametrize("when", ["before the commit", "after the commit"])
def test_a_retried_batch_is_not_inserted_twice(spark, monkeypatch, when):
    """A failure after the insert: the transaction is undone, or the fence keeps the retry out."""
    url = f"jdbc:derby:memory:cf_fence_{when[0]};create=true"
    _insert(spark, url, [("a", 1), ("b", 1)], 0)
    plain, failures = jdbc.Fence.insert, []

    def failing(self, columns, batch_id):
        if len(failures) < 2:
            failures.append(batch_id)
            if when == "after the commit":
                plain(self, columns, batch_id)
            else:
                with self._transaction() as c:
                    self._run(c, f"INSERT INTO {self.table} SELECT * FROM {self.staging}")
                    raise RuntimeError("the connection is gone")
            raise RuntimeError("the answer is lost")
        plain(self, columns, batch_id)
    monkeypatch.setattr(jdbc.Fence, "insert", failing)
    _insert(spark, url, [("a", 2), ("c", 1)], 1)
    assert len(failures) == (2 if when == "before the commit" else 1)
    want = [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert _held(spark, url) == want
    _insert(spark, url, [("a", 2), ("c", 1)], 1)       # the whole micro-batch once more
    assert _held(spark, url) == want
    _insert(spark, url, [("a", 3)], 2)
    assert _held(spark, url) == sorted([*want, ("a", 3)])
    assert _held(spark, url, "clickflow_fence") == [("q", 2)]


def test_a_stage_that_failed_half_way_is_written_anew(spark, monkeypatch):
    url = "jdbc:derby:memory:cf_stage;create=true"
    plain, tries = jdbc.write_jdbc_append, []

    def half(df, url, table, *a, **kw):
        if "staged" in table and not tries:
            tries.append(1)
            plain(df.limit(1), url, table, *a, **kw)
            raise RuntimeError("a task is lost")
        plain(df, url, table, *a, **kw)
    monkeypatch.setattr(jdbc, "write_jdbc_append", half)
    _insert(spark, url, [("a", 1), ("b", 2), ("c", 3)], 0)
    assert tries and _held(spark, url) == [("a", 1), ("b", 2), ("c", 3)]


def test_unfenced_inserts_and_missing_names(spark):
    url = "jdbc:derby:memory:cf_plain;create=true"
    for _ in range(2):
        _insert(spark, url, [("a", 1)], 0, fence=None)
    assert _held(spark, url) == [("a", 1), ("a", 1)]
    with pytest.raises(ValueError, match="name of its stream"):
        sinks.foreach_batch_jdbc(url, "usercount", DERBY, retries=0)(spark.createDataFrame([("a", 1)], "username string, count int"), 0)


def test_skewed_partition_column_is_read_in_balanced_ranges(spark):
    """90 % of the rows in 1 % of the range, two rows far off, some without a value."""
    url, n = "jdbc:derby:memory:cf_skew;create=true", 20_000
    dense = F.lit(500_000_000) + F.pmod(F.xxhash64("id"), F.lit(10_000_000))
    wide = F.pmod(F.xxhash64("id"), F.lit(1_000_000_000))
    t = spark.range(n).select("id", F.when(F.col("id") == 1, -(10 ** 15)).when(F.col("id") == 2, 10 ** 15)
                              .when(F.col("id") % 997 == 3, F.lit(None)).when(F.col("id") % 10 > 0, dense)
                              .otherwise(wide).alias("times"))
    sinks.write_jdbc_append(t, url, "eventinfo", DERBY)
    back = read_jdbc(spark, url, "eventinfo", driver=DERBY, partition_column="times", num_partitions=8)
    sizes = [r[0] for r in back.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert back.rdd.getNumPartitions() == 8 and len(sizes) == 8
    assert max(sizes) < 2 * n / 8 and rows(back) == rows(t)
    one = spark.range(50).select("id", F.lit(7).cast("long").alias("times"))
    sinks.write_jdbc_append(one, url, "same", DERBY)
    assert rows(read_jdbc(spark, url, "same", driver=DERBY, partition_column="times", num_partitions=4)) == rows(one)
    sinks.write_jdbc_append(one.limit(0), url, "nothing", DERBY)
    assert read_jdbc(spark, url, "nothing", driver=DERBY, partition_column="times", num_partitions=4).count() == 0


def test_routed_branches_written_together(spark):
    from clickflow import operators as op
    ev = as_click_events(spark.read.parquet(f"{SF001}/events.parquet"))
    routed = op.route(op.event_text(ev), [(F.col("action") == "click", "tag1"), (F.col("action") == "view", "tag2")])
    out = tempfile.mkdtemp(prefix="cf-route-")
    sinks.write_text(routed, out, mode="overwrite", partition_by=["route"])
    assert sorted(d for d in os.listdir(out) if d.startswith("route=")) == ["route=main", "route=tag1", "route=tag2"]
    back = spark.read.text(out)
    assert back.where("route = 'tag1'").count() == routed.where("route = 'tag1'").count()
    assert back.count() == ev.count()
