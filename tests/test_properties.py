"""Randomised checks against small pure-Python brute force."""
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow.functions.time import ntz_from_millis
from clickflow.operators import sequence as seq


def java_split_space(s: str) -> list[str]:
    """Java's String.split(" ") (limit 0) written out."""
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab ", max_size=8), min_size=1, max_size=12))
def test_tokenize_matches_java_split(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted(r[0] for r in op.tokenize(df).collect())
    want = sorted(t for x in lines for t in java_split_space(x))
    assert got == want


def brute_sessions(rows):
    """rows: (key, ms, id, gap_ms); Spark session rule: join unless ts > latest end."""
    out = []
    by_key = {}
    for k, ms, i, g in rows:
        if g > 0:
            by_key.setdefault(k, []).append((ms, i, g))
    for k, rs in by_key.items():
        rs.sort()
        cur = None
        for ms, i, g in rs:
            if cur is None or ms > cur[1]:
                if cur:
                    out.append((k, cur[0], cur[1], cur[2]))
                cur = [ms, ms + g, 1]
            else:
                cur[1] = max(cur[1], ms + g)
                cur[2] += 1
        out.append((k, cur[0], cur[1], cur[2]))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sessions_random_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        k = rnd.choice([0, 0, 0, 1, 2, 3])               # key 0 is hot
        rows.append((k, rnd.randrange(0, 200_000), i, rnd.choice([0, 1_000, 5_000, 20_000])))
    df = spark.createDataFrame(rows, "k long, ms long, id long, g long").withColumn("ts", ntz_from_millis("ms"))
    gap = F.make_interval(secs=(F.col("g") / 1000).cast("decimal(18,6)"))
    got = seq.sessions(df, ["k"], "ts", gap, ["id"], piece_rows=rnd.choice([3, 20, 10_000]))
    ms = lambda c: F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col(c))  # noqa
    res = sorted(tuple(r) for r in got.select("k", ms("session_start"), ms("session_end"), "n").collect())
    assert res == brute_sessions(rows)


@pytest.mark.parametrize("seed", [5, 6, 7, 8])
def test_bucketed_range_joins_against_naive_join(spark, seed):
    rnd = random.Random(seed)
    lo_s = rnd.choice([-50, -5, 0, 3])
    hi_s = lo_s + rnd.choice([0, 1, 7, 40])
    mk = lambda n, base: [(rnd.choice([1, 1, 1, 2, 3]), base + i, rnd.randrange(0, 300_000)) for i in range(n)]  # noqa
    a = spark.createDataFrame(mk(150, 0), "k long, event_id long, ms long").withColumn("ts", ntz_from_millis("ms"))
    b = spark.createDataFrame(mk(150, 1000), "k long, event_id long, ms long").withColumn("ts", ntz_from_millis("ms"))
    a, b = a.select("k", "event_id", "ts"), b.select("k", "event_id", "ts")
    got = op.interval_join(a, b, ["k"], f"{lo_s} seconds", f"{hi_s} seconds")
    a2 = a.select(F.col("k").alias("ak"), F.col("event_id").alias("app_event_id"), F.col("ts").alias("app_ts"))
    b2 = b.select(F.col("k").alias("bk"), F.col("event_id").alias("third_event_id"), F.col("ts").alias("third_ts"))
    cond = (F.col("ak") == F.col("bk")) & F.col("third_ts").between(
        F.col("app_ts") + F.make_interval(secs=F.lit(lo_s)), F.col("app_ts") + F.make_interval(secs=F.lit(hi_s)))
    want = a2.join(b2, cond).select("app_event_id", "third_event_id")
    assert sorted(tuple(r) for r in got.select("app_event_id", "third_event_id").collect()) == \
        sorted(tuple(r) for r in want.collect())
    # reconcile with tolerance |hi_s| (at least 1 s) against a naive full outer join
    tol = max(abs(hi_s), 1)
    rec = op.reconcile(a, b, ["k"], f"{tol} seconds")
    fcond = (F.col("ak") == F.col("bk")) & F.col("third_ts").between(
        F.col("app_ts") - F.make_interval(secs=F.lit(tol)), F.col("app_ts") + F.make_interval(secs=F.lit(tol)))
    full = a2.join(b2, fcond, "full_outer").select("app_event_id", "third_event_id")
    key = lambda r: (r[0] if r[0] is not None else -1, r[1] if r[1] is not None else -1)
    assert sorted(key(r) for r in rec.select("app_event_id", "third_event_id").collect()) == \
        sorted(key(r) for r in full.collect())
