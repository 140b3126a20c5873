"""JDBC append sink (insert only: every running total is a new row).

Batch writes go through Spark's JDBC writer, one connection per task and
``batchsize`` rows per JDBC batch.  Streams use ``foreachBatch`` with a retry
loop.  A writer's tasks commit one by one, so a micro-batch that fails half
way and is retried would insert rows twice.  So a micro-batch goes to a staging
table first, which a retry overwrites; then one transaction inserts it into the
table and records its number in a fence table.  A number that the fence holds
already, after a failure between that commit and Spark's own, is not inserted
again.  ``fence=None`` gives the reference's plain inserts, at least once.
"""
from __future__ import annotations

import re
import time
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import checkpoint_subdir

# The reference's sink options.
BATCH_SIZE = 1000
FLUSH_INTERVAL = "200 milliseconds"
MAX_RETRIES = 5

FENCE = "query_name string, batch_id long"
FENCE_NAME = "query_name VARCHAR(128)"  # texts of unbounded length cannot be compared everywhere


def write_jdbc_append(df: DataFrame, url: str, table: str, driver: str | None = None,
                      batchsize: int = BATCH_SIZE, num_partitions: int | None = None,
                      properties: dict | None = None, overwrite: bool = False) -> None:
    """Append ``df`` to a table; with ``overwrite`` its rows take the place of the table's (emptied, not dropped)."""
    w = df.write.format("jdbc").mode("overwrite" if overwrite else "append").option("url", url).option("dbtable", table)
    w = w.option("truncate", "true") if overwrite else w
    w = w.option("batchsize", batchsize)
    if driver:
        w = w.option("driver", driver)
    if num_partitions:
        w = w.option("numPartitions", num_partitions)  # caps concurrent connections
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


class Fence:
    """The last micro-batch of each query that is in its table, recorded by the transaction that inserts it."""

    def __init__(self, spark: SparkSession, url: str, table: str, query: str, fence: str, driver: str | None = None,
                 properties: dict | None = None):
        self.spark, self.url, self.table, self.query, self.fence = spark, url, table, query, fence
        self.driver, self.properties = driver, properties or {}
        self.staging = f"{table}_staged_{re.sub('[^0-9A-Za-z_]', '_', query)}"

    def _quoted(self, name: str) -> str:
        return self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(name)

    @contextmanager
    def _transaction(self):
        """A connection of the driver; what is done on it is committed at the end or, on an error, undone."""
        jvm = self.spark._jvm
        if self.driver:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.driver)
        options = jvm.java.util.Properties()
        for k, v in self.properties.items():
            options.setProperty(k, str(v))
        connection = jvm.java.sql.DriverManager.getConnection(self.url, options)
        try:
            connection.setAutoCommit(False)
            yield connection
            connection.commit()
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    @staticmethod
    def _run(connection, sql: str, *values) -> int:
        statement = connection.prepareStatement(sql)
        try:
            for i, v in enumerate(values, 1):
                statement.setLong(i, v) if isinstance(v, int) else statement.setString(i, v)
            return statement.executeUpdate()
        finally:
            statement.close()

    def prepare(self, batch: DataFrame) -> None:
        """Make the table and the fence if they are not there."""
        for name, rows, more in ((self.table, batch.limit(0), {}),
                                 (self.fence, self.spark.createDataFrame([], FENCE), {"createTableColumnTypes": FENCE_NAME})):
            if not self._exists(name):
                write_jdbc_append(rows, self.url, name, self.driver, properties={**self.properties, **more})

    def _exists(self, table: str) -> bool:
        with self._transaction() as c:
            statement = c.createStatement()
            try:
                statement.executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0").close()
                return True
            except Py4JJavaError:
                return False
            finally:
                statement.close()

    def last(self) -> int | None:
        """The last micro-batch of this query in the table, if any."""
        rows = _read(self.spark, self.url, self.fence, self.driver, self.properties)
        row = rows.where(F.col("query_name") == self.query).agg(F.max("batch_id")).first()
        return row[0]

    def insert(self, columns: list[str], batch_id: int) -> None:
        """Insert the staged rows and record the micro-batch, both or neither."""
        names = ", ".join(map(self._quoted, columns))
        query, number = self._quoted("query_name"), self._quoted("batch_id")
        with self._transaction() as c:
            self._run(c, f"INSERT INTO {self.table} ({names}) SELECT {names} FROM {self.staging}")
            if not self._run(c, f"UPDATE {self.fence} SET {number} = ? WHERE {query} = ?", batch_id, self.query):
                self._run(c, f"INSERT INTO {self.fence} ({query}, {number}) VALUES (?, ?)", self.query, batch_id)


def _read(spark: SparkSession, url: str, table: str, driver: str | None, properties: dict) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if driver:
        reader = reader.option("driver", driver)
    for k, v in properties.items():
        reader = reader.option(k, v)
    return reader.load()


def foreach_batch_jdbc(url: str, table: str, driver: str | None = None, batchsize: int = BATCH_SIZE,
                       retries: int = MAX_RETRIES, backoff_seconds: float = 0.2, fence: str | None = "clickflow_fence",
                       query: str | None = None, properties: dict | None = None):
    """A ``foreachBatch`` function appending each micro-batch, retried up to ``retries`` times.

    With ``fence`` (the name of a table) a micro-batch is in the table once,
    however often it is tried.  Streams into the same table are told apart by
    the streaming query's id, which its checkpoint holds; ``query`` names the
    stream where the function is called outside a streaming query.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        name = query or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if fence is not None and not name:
            raise ValueError("a fenced insert outside a streaming query needs the name of its stream")
        for attempt in range(retries + 1):
            try:
                if fence is None:
                    write_jdbc_append(batch, url, table, driver, batchsize, properties=properties)
                    return
                guard = Fence(batch.sparkSession, url, table, name, fence, driver, properties)
                guard.prepare(batch)
                last = guard.last()
                if last is None or last < batch_id:
                    write_jdbc_append(batch, url, guard.staging, driver, batchsize, properties=properties, overwrite=True)
                    guard.insert(batch.columns, batch_id)
                return
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(backoff_seconds * (2 ** attempt))
    return write


def stream_jdbc(df: DataFrame, url: str, table: str, driver: str | None = None, checkpoint: str | None = None,
                trigger: str = FLUSH_INTERVAL, available_now: bool = False, **kw):
    """Start a streaming JDBC append; returns the StreamingQuery."""
    ckpt = checkpoint or checkpoint_subdir(df.sparkSession, f"jdbc-sink-{table}")
    w = (df.writeStream.foreachBatch(foreach_batch_jdbc(url, table, driver, **kw))
         .option("checkpointLocation", ckpt).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
