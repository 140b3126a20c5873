"""Every registered query against its DuckDB oracle (the driver's gate), plus the entry smoke check."""
import os
import sys

import pytest

from conftest import ROOT, SF001, SF01

sys.path.insert(0, os.path.join(ROOT, "tools"))
import oracle_check  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from clickflow.plans import ORACLE_SQL, QUERIES  # noqa: E402

CORE = list(QUERIES)


def test_every_query_has_an_oracle():
    assert set(CORE) == set(ORACLE_SQL) and set(CORE) <= set(E.queries())


@pytest.mark.parametrize("sf_dir", [SF001, SF01])
def test_queries_match_oracle(spark, sf_dir):
    res = oracle_check.compare(spark, sf_dir, CORE)
    bad = {k: v for k, v in res.items() if not (v.get("cols") and v.get("values"))}
    assert not bad, bad


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "event_type", "n", "rk"]
    assert df.count() > 0


def test_queries_match_oracle_in_a_foreign_session(spark):
    """Results must not depend on the session time zone, partition count or AQE."""
    conf = {"spark.sql.session.timeZone": "America/Los_Angeles", "spark.sql.shuffle.partitions": "37",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        res = oracle_check.compare(spark, SF001, CORE)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    bad = {k: v for k, v in res.items() if not (v.get("cols") and v.get("values"))}
    assert not bad, bad
