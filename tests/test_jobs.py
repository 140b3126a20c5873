"""The reference's jobs end to end on event files (availableNow, memory / file sinks)."""
import tempfile

import pandas as pd

from clickflow import jobs
from conftest import SF001
from streamutil import write_batches


def _events_dir():
    pdf = pd.read_parquet(f"{SF001}/events.parquet").sort_values("ts")
    pdf["ts"] = pdf["ts"].astype("datetime64[us]")
    return write_batches(tempfile.mkdtemp(prefix="cf-job-"), [pdf.iloc[:400], pdf.iloc[400:]]), pdf


def test_jobs_run_to_completion(spark):
    folder, pdf = _events_dir()
    out = tempfile.mkdtemp(prefix="cf-job-out-")
    q = jobs.count_window_to_text(spark, folder, out, checkpoint=tempfile.mkdtemp(), available_now=True,
                                  max_files=1)
    q.awaitTermination(300)
    assert spark.read.text(out).count() == len(pdf)
    for name, kw in [("topn", dict(size="2 hours", slide="1 hour", delay="0 seconds")),
                     ("merge", {}), ("split", {}), ("window-join", dict(size="1 day")),
                     ("cogroup", dict(size="1 day")), ("interval-join", dict(lower="-1 hour", upper="2 hours")),
                     ("reconcile", dict(tolerance="1 hour")), ("reconcile", dict(tolerance="1 hour", one_to_one=True))]:
        table = "j_" + name.replace("-", "_") + ("_1" if kw.get("one_to_one") else "")
        q = jobs.STREAM_JOBS[name](spark, folder, checkpoint=tempfile.mkdtemp(), available_now=True, max_files=1,
                                   sink="memory", queryName=table, **kw)
        q.awaitTermination(300)
        assert q.exception() is None, name
        assert spark.table(table).count() > 0, name


def test_batch_word_count_job(spark, tmp_path):
    p = tmp_path / "w.txt"
    p.write_text("ni hao\nhao bob\n", encoding="utf-8")
    assert dict(jobs.batch_word_count(spark, str(p)).collect()) == {"ni": 1, "hao": 2, "bob": 1}


def test_totals_to_jdbc_job_and_scan(spark):
    folder, pdf = _events_dir()
    url, driver = "jdbc:derby:memory:cf_job;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    q = jobs.user_totals_to_jdbc(spark, folder, url, "usercount", driver, checkpoint=tempfile.mkdtemp(),
                                 available_now=True, max_files=1)
    q.awaitTermination(300)
    assert q.exception() is None
    back = jobs.jdbc_scan(spark, url, "usercount", driver)
    assert back.count() == len(pdf)
    assert back.groupBy("username").count().count() == pdf["user_id"].nunique()
