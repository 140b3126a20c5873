"""Golden rows from the reference's own sample inputs (see FIXTURES.md)."""
import pytest
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow.functions.time import ntz_from_millis
from conftest import rows


def _ts(df, col="ts"):
    return df.withColumn(col, ntz_from_millis(col))


def test_word_count_four_lines(spark):
    lines = spark.createDataFrame([("Hello alice",), ("ni hao",), ("hello bob",), ("hao bob",)], "value string")
    got = dict(rows(op.word_count(lines)))
    assert got == {"Hello": 1, "alice": 1, "ni": 1, "hao": 2, "hello": 1, "bob": 2}


def test_tokenize_java_split_edges(spark):
    lines = spark.createDataFrame([("a  b ",), (" ",), ("",), (" x",)], "value string")
    toks = [r[0] for r in op.tokenize(lines).collect()]
    assert sorted(toks) == sorted(["a", "", "b", "", "", "x"])


@pytest.fixture
def payments(spark):
    app = spark.createDataFrame([("order-1", "app", 1000), ("order-2", "app", 2000), ("order-3", "app", 3000)],
                                "order_id string, channel string, ts long")
    third = spark.createDataFrame([("order-3", "third", "success", 10000), ("order-1", "third", "success", 3000),
                                   ("order-2", "third", "success", 4000), ("order-6", "third", "success", 5000)],
                                  "order_id string, channel string, status string, ts long")
    return _ts(app), _ts(third)


def test_reconcile_five_second_rule(spark, payments):
    app, third = payments
    got = op.reconcile(app.select("order_id", "ts"), third.select("order_id", "ts"), ["order_id"], "5 seconds")
    res = sorted((r.order_id, r.status) for r in got.collect())
    assert res == [("order-1", "MATCHED"), ("order-2", "MATCHED"), ("order-3", "MISSING_APP"),
                   ("order-3", "MISSING_THIRD"), ("order-6", "MISSING_APP")]
    alerts = op.reconcile_alerts(app.select("order_id", "ts"), third.select("order_id", "ts"), ["order_id"],
                                 "5 seconds")
    assert sorted((r.order_id, r.status) for r in alerts.collect()) == [
        ("order-3", "MISSING_APP"), ("order-3", "MISSING_THIRD"), ("order-6", "MISSING_APP")]


@pytest.fixture
def join_payments(spark):
    app = spark.createDataFrame([("order-1", 1000), ("order-2", 2000), ("order-3", 3000)], "order_id string, ts long")
    third = spark.createDataFrame([("order-1", 3000), ("order-2", 4000), ("order-2", 8000), ("order-6", 5000)],
                                  "order_id string, ts long")
    return _ts(app), _ts(third)


def test_window_join_five_seconds(spark, join_payments):
    app, third = join_payments
    got = op.window_join(app.select("order_id", "ts"), third.select("order_id", "ts"), ["order_id"], "5 seconds")
    res = sorted((r.order_id, r.app_ts.second, r.third_ts.second) for r in got.collect())
    assert res == [("order-1", 1, 3), ("order-2", 2, 4)]


def test_window_cogroup_ten_seconds(spark, join_payments):
    app, third = join_payments
    a = app.select("order_id", "ts", (F.second("ts") * 1000).cast("long").alias("v"))
    b = third.select("order_id", "ts", (F.second("ts") * 1000).cast("long").alias("v"))
    got = op.window_cogroup(a, b, ["order_id"], "10 seconds", "v")
    res = sorted((r.order_id, r.app_values, r.third_values) for r in got.collect())
    assert res == [("order-1", [1000], [3000]), ("order-2", [2000], [4000, 8000]),
                   ("order-3", [3000], []), ("order-6", [], [5000])]


def test_interval_join_bounds_inclusive(spark):
    orders = spark.createDataFrame([("Mary", "order-1", 5000), ("Alice", "order-2", 5000), ("Bob", "order-3", 20000),
                                    ("Alice", "order-4", 20000), ("Cary", "order-5", 51000)],
                                   "user string, item string, ts long")
    acts = spark.createDataFrame([("Bob", "读书", 2000), ("Alice", "看报", 3000), ("Alice", "数鸭子", 3500),
                                  ("Bob", "学画画", 2500), ("Alice", "说哈哈哈", 36000), ("Bob", "说额呵呵呵", 30000),
                                  ("Bob", "看电视", 23000), ("Bob", "玩电脑", 33000)],
                                 "user string, item string, ts long")
    got = op.interval_join(_ts(orders), _ts(acts), ["user"], "-5 seconds", "10 seconds",
                           left_prefix="o_", right_prefix="a_")
    res = sorted((r.a_item, r.o_item) for r in got.collect())
    assert res == sorted([("看报", "order-2"), ("数鸭子", "order-2"), ("看电视", "order-3"), ("说额呵呵呵", "order-3")])


def test_route_and_merge(spark):
    ev = spark.createDataFrame([("Ana", "a", 1), ("Ben", "b", 2), ("Cai", "c", 3)],
                               "user string, action string, times long")
    routed = op.route(op.event_text(ev), [(F.col("user") == "Ana", "tag1"), (F.col("user") == "Ben", "tag2")])
    assert sorted(rows(routed, "user", "route")) == sorted([("Cai", "main"), ("Ben", "tag2"), ("Ana", "tag1")])
    merged = [r[0] for r in op.merge_tagged(op.branch(routed, "tag1"), op.branch(routed, "tag2")).collect()]
    assert sorted(merged) == sorted([op.FIRST_PREFIX + "{user='Ana', action='a', times=1}",
                                     op.SECOND_PREFIX + "{user='Ben', action='b', times=2}"])
    one_scan = op.merge_routed(routed, [(F.col("user") == "Ana", op.FIRST_PREFIX),
                                        (F.col("user") == "Ben", op.SECOND_PREFIX)])
    assert sorted(merged) == sorted(r[0] for r in one_scan.collect())


def test_unpivot_and_pairs(spark):
    ev = spark.createDataFrame([(7, "u1", "click", 1234)], "event_id long, user string, action string, times long")
    assert sorted(rows(op.unpivot_event(ev), "key", "value")) == [("action", "click"), ("times", "1234"), ("user", "u1")]
    assert rows(op.user_pairs(ev)) == [("u1", 1)]


def test_cogroup_rows_keep_every_value(spark):
    left = spark.createDataFrame([("k", i * 10, i) for i in range(25)], "order_id string, ts long, v long")
    right = spark.createDataFrame([("k", i * 10, 100 + i) for i in range(7)], "order_id string, ts long, v long")
    got = op.window_cogroup_rows(_ts(left), _ts(right), ["order_id"], "10 seconds", "v")
    assert sorted((r.side, r["rank"], r.v) for r in got.collect()) == (
        [("app", i + 1, i) for i in range(25)] + [("third", i + 1, 100 + i) for i in range(7)])
    lists = op.window_cogroup(_ts(left), _ts(right), ["order_id"], "10 seconds", "v").collect()
    assert [(r.app_values, r.third_values) for r in lists] == [(list(range(25)), list(range(100, 107)))]


def test_word_count_from_text_file(spark, tmp_path):
    from clickflow.sources import read_lines
    p = tmp_path / "lines.txt"
    p.write_text("Hello alice\nni hao\nhello bob\nhao bob\n", encoding="utf-8")
    got = dict(rows(op.word_count(read_lines(spark, str(p)))))
    assert got == {"Hello": 1, "alice": 1, "ni": 1, "hao": 2, "hello": 1, "bob": 2}


def test_topn_rows_ties_and_sparse_windows(spark):
    click, view, buy = "点击", "浏览", "买东西"          # code points: 浏 < 点, 买 < 浏
    ev = _ts(spark.createDataFrame([(0, click), (4999, view), (5000, click), (9999, view), (10000, buy),
                                    (12000, buy), (50000, click)], "ts long, event_type string"))
    counts = op.sliding_counts(ev, "10 seconds", "5 seconds", ["event_type"])
    top = op.topn_rows(counts, 2, ["window_start", "window_end"], ["event_type"])
    start_s = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("window_start"))
    got = sorted(tuple(r) for r in top.select(start_s.alias("s"), "rk", "event_type", "n").collect())
    assert got == [
        (-5, 1, view, 1), (-5, 2, click, 1),      # tie at 1: action ascending
        (0, 1, view, 2), (0, 2, click, 2),        # tie at 2: action ascending
        (5, 1, buy, 2), (5, 2, view, 1),          # click and view tie at 1: view first
        (10, 1, buy, 2),                          # a single action
        (45, 1, click, 1), (50, 1, click, 1),     # single-action windows
    ]
