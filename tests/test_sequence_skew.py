"""Per-key sequence operators on wide, skewed, multi-file input of 120,000 rows,
against plain single-task formulations as brute force.  Every column is
compared, with exchange reuse on and off, and in pieces of several sizes."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow.operators import sequence as seq
from clickflow.operators.windows import _counted
from conftest import rows

N = 120_000
KEY, ORDER = ["k"], ["ts", "id"]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Two thirds of the rows on key 0; bursts, ties in ts, nulls, other columns and six files."""
    path = str(tmp_path_factory.mktemp("skewed") / "t")
    at = F.col("id") * 40_000 + F.pmod(F.xxhash64("id"), F.lit(3_000_000)) + F.when(F.col("id") % 5000 < 50, 0).otherwise(
        F.floor(F.col("id") / 5000) * 7_000_000_000)
    (spark.range(N).withColumn("k", F.when(F.col("id") % 3 < 2, 0).when(F.col("id") % 999 == 0, F.lit(None))
                               .otherwise(F.pmod(F.hash("id"), F.lit(40)) + 1))
     .withColumn("ts", F.timestamp_micros(F.lit(1_700_000_000_000_000) + at).cast("timestamp_ntz"))
     .withColumn("v", F.when(F.col("id") % 7 != 0, (F.col("id") % 1000).cast("decimal(18,2)")))
     .withColumn("d", F.when(F.col("id") == 60_001, F.lit(float("nan"))).when(F.col("id") == 90_001, F.lit(float("inf")))
                 .otherwise((F.col("id") % 64).cast("double")))
     .withColumn("s", F.substring(F.lit("abc"), 1, (F.col("id") % 4).cast("int")))
     .withColumn("other", F.sha2(F.col("id").cast("string"), 256))
     .repartition(6).write.parquet(path))
    return spark.read.parquet(path)


@pytest.fixture(params=["true", "false"], ids=["reuse", "no-reuse"])
def reuse(spark, request):
    old = spark.conf.get("spark.sql.exchange.reuse")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    spark.conf.set("spark.sql.shuffle.partitions", "8" if request.param == "true" else "32")
    yield
    spark.conf.set("spark.sql.exchange.reuse", old)
    spark.conf.set("spark.sql.shuffle.partitions", parts)


def digest(df):
    """Row count and an order-free digest of all columns."""
    h = F.xxhash64(*[F.col(c).cast("string") for c in sorted(df.columns)])
    return tuple(df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first())


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert digest(got) == digest(want)


def by():
    return Window.partitionBy("k").orderBy("ts", "id")


@pytest.mark.parametrize("piece", [500, 200_000])
def test_running_totals(skewed, reuse, piece):
    run = by().rowsBetween(Window.unboundedPreceding, 0)
    same(op.running_count(skewed, KEY, ORDER, piece_rows=piece), skewed.withColumn("n", F.count(F.lit(1)).over(run)))
    same(op.running_sum(skewed, KEY, ORDER, "v", "total", piece_rows=piece), skewed.withColumn("total", F.sum("v").over(run)))
    got = op.running_sum(skewed, KEY, ORDER, "d", "total", piece_rows=piece)
    same(got, skewed.withColumn("total", F.sum("d").over(run)))


@pytest.mark.parametrize("size,slide", [(2, 1), (10, 5), (700, 7)])
def test_count_windows(skewed, reuse, size, slide):
    last = by().rowsBetween(1 - size, 0)
    numbered = skewed.withColumn("pos", F.row_number().over(by()))
    fired = F.col("pos") % slide == 0
    same(op.count_window_sliding(skewed, KEY, ORDER, size, slide, piece_rows=500),
         numbered.withColumn("n", F.count(F.lit(1)).over(last)).where(fired).drop("pos"))
    for value in ("v", "d"):
        same(op.count_window_sum(skewed, KEY, ORDER, value, size, slide, piece_rows=500),
             numbered.withColumn("total", F.sum(value).over(last)).where(fired).drop("pos"))
    win = numbered.withColumn("win", F.floor((F.col("pos") - 1) / size).cast("long"))
    same(op.count_window_tumbling(skewed, KEY, ORDER, size, piece_rows=500),
         win.groupBy("k", "win").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("start_ts"),
                                     F.max("ts").alias("end_ts")).where(F.col("n") == size))


def test_a_nan_stays_in_its_windows(skewed):
    got = op.count_window_sum(skewed, KEY, ORDER, "d", 2, 1, piece_rows=500)
    assert got.where(F.isnan("total")).count() == 2


@pytest.mark.parametrize("dynamic", [False, True])
def test_sessions(skewed, reuse, dynamic):
    gap = F.make_interval(secs=F.length("s") * 40) if dynamic else "30 seconds"
    got = seq.sessions(skewed, KEY, "ts", gap, ["id"], piece_rows=500)
    want = _counted(skewed, F.session_window("ts", gap), KEY, "session", "n")
    same(got, want.select(*got.columns))


def test_cogroup_rows(skewed, reuse, monkeypatch):
    a, b = skewed.where("id % 2 = 0"), skewed.where("id % 2 = 1")
    got = op.window_cogroup_rows(a, b, KEY, "30 days", "id")
    lists = op.window_cogroup(a, b, KEY, "30 days", "id")
    back = got.groupBy("k", "window_start", "window_end").agg(
        *[F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("rank", "id")))), lambda x: x["id"])
          .alias(c) for s, c in (("app", "app_values"), ("third", "third_values"))])
    same(back, lists)


def test_neighbours(skewed):
    got = seq.with_neighbours(skewed.select("k", "ts", "id"), KEY, ORDER, "p", "q", "at", piece_rows=500)
    at = F.struct("ts", "id")
    same(got, skewed.select("k", "ts", "id", F.lag(at).over(by()).alias("p"), F.lead(at).over(by()).alias("q"),
                            F.row_number().over(by()).cast("long").alias("at")))


def test_running_max(skewed):
    got = seq.running_max(skewed.select("k", "ts", "id", "v"), KEY, ORDER, "v", "m", piece_rows=500)
    run = by().rowsBetween(Window.unboundedPreceding, 0)
    same(got, skewed.select("k", "ts", "id", "v", F.max("v").over(run).alias("m")))


def test_pieces_are_part_of_the_plan(skewed):
    plan = seq.keyed_row_number(skewed, KEY, ORDER)._jdf.queryExecution().toString()
    assert "Subquery" in plan or "subquery" in plan  # heavy keys and cut points run with the plan, not before it


@pytest.fixture(scope="module")
def outlying(spark, tmp_path_factory):
    """100,000 rows: two rows far off, a burst of 60,000 rows of one user in 1 % of the span, light users, some nulls."""
    path = str(tmp_path_factory.mktemp("outlying") / "t")
    span = 30 * 86_400_000_000
    at = F.when(F.col("id") < 60_000, span // 2 + F.pmod(F.xxhash64("id"), F.lit(span // 100))).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(span)))
    ts = F.when(F.col("id") == 70_000, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).when(
        F.col("id") == 70_001, F.expr("TIMESTAMP_NTZ'9999-12-31 00:00:00'")).when(
        F.col("id") % 20_011 != 0, F.timestamp_micros(F.lit(1_700_000_000_000_000) + at).cast("timestamp_ntz"))
    (spark.range(100_000).withColumn("k", F.when(F.col("id") <= 70_001, 1).when(F.col("id") < 85_000, 2)
                                     .otherwise(F.col("id") % 300 + 3))
     .withColumn("ts", ts).withColumn("v", (F.col("id") % 1000).cast("decimal(18,2)"))
     .withColumn("s", F.substring(F.lit("abc"), 1, (F.col("id") % 4).cast("int"))).repartition(4).write.parquet(path))
    return spark.read.parquet(path)


def test_outliers_and_bursts_do_not_widen_pieces(outlying):
    sizes = seq.with_pieces(outlying, KEY, ORDER, 1000).groupBy("k", seq._PIECE).count()
    assert sizes.agg(F.max("count")).first()[0] < 4000
    heavy = sizes.where("k = 1").agg(F.count("*"), F.max("count")).first()
    assert heavy[0] > 40 and heavy[1] < 4000
    assert sizes.where(F.col("k") > 2).agg(F.max(seq._PIECE)).first()[0] == seq._LIGHT  # light users are not cut


def test_the_number_of_pieces_is_bounded(outlying, monkeypatch):
    monkeypatch.setattr(seq, "MAX_PIECES", 10)
    sizes = seq.with_pieces(outlying, KEY, ORDER, 100).groupBy("k", seq._PIECE).count().where("k = 1")
    pieces, largest = sizes.agg(F.count("*"), F.max("count")).first()
    assert pieces <= 14 and largest < 40_000


def test_results_with_outliers_and_bursts(outlying):
    run = by().rowsBetween(Window.unboundedPreceding, 0)
    same(op.running_sum(outlying, KEY, ORDER, "v", "total", piece_rows=1000), outlying.withColumn("total", F.sum("v").over(run)))
    same(op.count_window_sum(outlying, KEY, ORDER, "v", 7, 3, piece_rows=1000),
         outlying.withColumns({"total": F.sum("v").over(by().rowsBetween(-6, 0)), "pos": F.row_number().over(by())})
         .where("pos % 3 = 0").drop("pos"))
    for gap in ("30 seconds", F.make_interval(secs=F.length("s") * 40)):
        got = seq.sessions(outlying, KEY, "ts", gap, ["id"], piece_rows=1000)
        want = _counted(outlying, F.session_window("ts", gap), KEY, "session", "n")
        same(got, want.select(*got.columns))


def test_order_by_text_is_one_piece(spark):
    df = spark.createDataFrame([("a", x, i) for i, x in enumerate("qwertyuiop")], "k string, t string, i int")
    assert rows(op.running_count(df, ["k"], ["t"], piece_rows=2), "t", "n") == [(c, i + 1) for i, c in enumerate(sorted("qwertyuiop"))]


def keyed_process(events, tol):
    """The one-pending-row process over (key, ms, side, id), row by row."""
    want, pending = [], {}

    def missing(k, p):
        want.append((k, p[2], p[0], None, None, "MISSING_THIRD") if p[1] == 0 else (k, None, None, p[2], p[0], "MISSING_APP"))
    for k, ms, side, i in sorted(events):
        p = pending.pop(k, None)
        if p and p[1] != side and ms - p[0] <= tol:
            x, y = ((p[2], p[0]), (i, ms)) if side == 1 else ((i, ms), (p[2], p[0]))
            want.append((k, *x, *y, "MATCHED"))
            continue
        if p:
            missing(k, p)
        pending[k] = (ms, side, i)
    for k, p in pending.items():
        missing(k, p)
    return sorted(want, key=repr)


@pytest.mark.parametrize("piece", [300, 200_000])
def test_reconcile_one_to_one_equals_the_keyed_process(skewed, reuse, piece):
    some = skewed.where("k is not null and id < 20000").select("k", "ts", F.col("id").alias("event_id"))
    a, b = some.where("event_id % 2 = 0"), some.where("event_id % 5 = 1")
    ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), "ts")
    events = [(r.k, int(r.ms), s, r.event_id) for d, s in ((a, 0), (b, 1)) for r in d.withColumn("ms", ms).collect()]
    got = op.reconcile_one_to_one(a, b, KEY, "60 milliseconds", piece_rows=piece)
    want = keyed_process(events, 60)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {"MATCHED", "MISSING_THIRD", "MISSING_APP"} == {w[-1] for w in want}


def test_one_long_chain_is_not_one_task(spark, tmp_path):
    """A million rows of one key, alternating sides, each in reach of the one before."""
    rows_, piece = 1_000_000, 20_000
    path = str(tmp_path / "chain")
    spark.range(rows_ + 1).select(F.lit(1).alias("k"), F.timestamp_millis(F.col("id") * 10).alias("ts"),
                                  F.col("id").alias("event_id")).repartition(6).write.parquet(path)
    chain = spark.read.parquet(path)
    a, b = chain.where("event_id % 2 = 0"), chain.where("event_id % 2 = 1")
    got = op.reconcile_one_to_one(a, b, KEY, "10 milliseconds", piece_rows=piece)
    pairs = F.when(F.col("third_event_id") == F.col("app_event_id") + 1, 1)
    assert tuple(got.groupBy().agg(F.count("*"), F.sum(pairs), F.count_if(F.col("status") == "MATCHED"),
                                   F.max(F.when(F.col("status") == "MISSING_THIRD", F.col("app_event_id")))).first()) == (
        rows_ // 2 + 1, rows_ // 2, rows_ // 2, rows_)
    sizes = seq.with_pieces(chain, KEY, ["ts", "event_id"], piece).groupBy("k", seq._PIECE).count()
    assert sizes.agg(F.max("count")).first()[0] < 4 * piece
    plan = got._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "_cf_side" in line]
    assert windows and all("_cf_piece" in line for line in windows)  # no window of rows by key alone
