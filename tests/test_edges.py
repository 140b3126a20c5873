"""Edge inputs: empty tables, null keys spanning range pieces."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickflow import operators as op
from clickflow.functions.time import ntz_from_millis
from clickflow.operators import sequence as seq
from conftest import rows

SCHEMA = "k long, id long, ms long"


def _df(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("ts", ntz_from_millis("ms"))


def test_empty_inputs(spark):
    e = _df(spark, [])
    assert seq.keyed_row_number(e, ["k"], ["ts", "id"]).count() == 0
    assert seq.keyed_row_number(e, ["k"], ["ts", "id"], piece_rows=10).count() == 0
    assert seq.sessions(e, ["k"], "ts", "1 hour", ["id"]).count() == 0
    assert op.count_window_tumbling(e, ["k"], ["ts", "id"], 3).count() == 0
    a = e.select("k", "id", "ts")
    assert op.reconcile(a, a, ["k"], "1 hour").count() == 0
    assert op.interval_join(a, a, ["k"], "-1 hour", "1 hour").count() == 0
    assert op.reconcile_one_to_one(a, a, ["k"], "1 hour", id_col="id").count() == 0
    assert op.window_cogroup(a, a, ["k"], "1 day", "id").count() == 0
    assert op.window_cogroup_rows(a, a, ["k"], "1 day", "id").count() == 0


def test_null_key_numbered_across_pieces(spark):
    data = [(None, i, i * 1000) for i in range(300)] + [(1, 1000 + i, i * 1000) for i in range(50)]
    df = _df(spark, data)
    got = seq.keyed_row_number(df, ["k"], ["ts", "id"], "rn", piece_rows=20)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("ts", "id")).cast("long"))
    assert rows(got, "id", "rn") == rows(want, "id", "rn")
    s = seq.sessions(df, ["k"], "ts", "2 seconds", ["id"], piece_rows=20)
    assert rows(s, "k", "n") == sorted([(None, 300), (1, 50)], key=repr)


def test_null_key_count_window_sum_across_pieces(spark):
    data = [(None, i, i * 1000) for i in range(300)] + [(1, 1000 + i, i * 1000) for i in range(50)]
    df = _df(spark, data).withColumn("v", F.col("id") % 7)
    got = seq.count_window_sum(df, ["k"], ["ts", "id"], "v", 20, 3, piece_rows=20)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = (df.withColumn("rn", F.row_number().over(w)).withColumn("total", F.sum("v").over(w.rowsBetween(-19, 0)))
            .where("rn % 3 = 0"))
    assert rows(got, "id", "total") == rows(want, "id", "total")


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from clickflow.session import ensure_checkpoint_dir, is_single_machine
    assert is_single_machine("local[4]") and is_single_machine("local") and not is_single_machine("local-cluster[2,1,512]")
    unset = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="yarn", getConf=lambda: unset))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


def test_reconcile_reports_rows_without_a_time(spark):
    """As the full outer interval join does: a row without a time, or key, is missing on the other side."""
    a = _df(spark, [(1, 1, 1000), (1, 2, None), (1, 3, None), (None, 4, None), (2, 5, 9000)]).select("k", "id", "ts")
    b = _df(spark, [(1, 11, 2000), (1, 12, None), (2, 13, 90_000), (3, 14, None)]).select("k", "id", "ts")
    got = op.reconcile(a, b, ["k"], "5 seconds").select("k", "app_id", "third_id", "status")
    la, lb = a.toDF("k", "app_id", "a_ts"), b.toDF("k2", "third_id", "b_ts")
    five = F.make_interval(secs=F.lit(5))
    near = F.col("b_ts").between(F.col("a_ts") - five, F.col("a_ts") + five)
    full = la.join(lb, (F.col("k") == F.col("k2")) & near, "full_outer")
    status = (F.when(F.col("third_id").isNull(), "MISSING_THIRD").when(F.col("app_id").isNull(), "MISSING_APP")
              .otherwise("MATCHED"))
    assert rows(got) == rows(full.select(F.coalesce("k", "k2").alias("k"), "app_id", "third_id", status.alias("status")))
    alerts = op.reconcile_alerts(a, b, ["k"], "5 seconds")
    assert sorted((r.id, r.status) for r in alerts.collect()) == \
        [(i, "MISSING_THIRD") for i in (2, 3, 4, 5)] + [(i, "MISSING_APP") for i in (12, 13, 14)]
