"""Session construction and cluster-shared folders.

Library code never creates its own session; callers pass one in.  This helper
is for tests, ``bench.py`` and command-line use.  On a cluster the deploy
configuration wins (see ``build_session``).
"""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# State store with keyed timers, spilling to disk; its jar ships with Spark.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that every plan in this package assumes or benefits from.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Delete reliable-checkpoint files once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # Literal sources under availableNow run batch after batch, the last one without rows, as file sources do.
    "spark.sql.streaming.triggerAvailableNowWrapper.enabled": "true",
}

# The subset that can be changed on a running session (SQL runtime settings).
RUNTIME_DEFAULTS = {k: v for k, v in DEFAULTS.items() if k.startswith("spark.sql.")}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session.

    With ``master`` (local runs, tests, the bench) this helper owns the
    session and applies ``DEFAULTS``.  Without it (a cluster, the command
    line) the deployment configuration decides: only SQL runtime settings the
    session has no value for are filled in, and ``extra`` is applied as given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        conf = dict(DEFAULTS)
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf.update(extra or {})
        for k, v in conf.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    else:
        spark = builder.getOrCreate()
        for k, v in RUNTIME_DEFAULTS.items():
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        if shuffle_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
        for k, v in (extra or {}).items():
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (distributed file system) folder there and we use
    it as is; a cluster without one is an error, because executors could not
    see each other's files.  Only local masters (one machine: tests, the
    bench) fall back to a private scratch folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not is_single_machine(sc.master):
            raise ValueError(f"master {sc.master!r} needs spark.checkpoint.dir set to a folder all executors share")
        path = tempfile.mkdtemp(prefix="clickflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def is_single_machine(master: str) -> bool:
    """True for local masters: ``local``, ``local[n]``, ``local[*, failures]`` (not ``local-cluster[...]``)."""
    return master == "local" or master.startswith("local[")


def checkpoint_subdir(spark: SparkSession, name: str) -> str:
    """A named folder under the shared checkpoint folder (streaming state, staged tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
