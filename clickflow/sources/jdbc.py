"""JDBC scan (the reference reads ``eventinfo`` with a plain SELECT *).

With a numeric partition column the read is split into ``num_partitions``
range queries that run in parallel; filters and column selection applied
afterwards are pushed into those queries by Spark.  The ranges hold about
equal numbers of rows: their borders come from counts that the database makes
(``balanced_ranges``).  With ``lower_bound`` and ``upper_bound`` given they are
strides of equal width, which need no count.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BUCKETS = 1000     # of a count query
FINE = 16          # buckets with more than a FINE-th of a partition are counted more finely


def _reader(spark: SparkSession, url: str, driver: str | None, fetch_size: int, properties: dict | None):
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    if driver:
        reader = reader.option("driver", driver)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader


def balanced_ranges(spark: SparkSession, url: str, table: str, column: str, num_partitions: int, *,
                    driver: str | None = None, properties: dict | None = None) -> list[int]:
    """Borders that part the column's values in ``num_partitions`` ranges of about equal numbers of rows.

    The database counts rows in ``BUCKETS`` buckets of equal width; buckets
    that hold much are counted again in as many parts, down to single values
    if need be.  Every answer is at most ``BUCKETS`` rows, and each query
    reads only the ranges it refines.  A single value is never parted.
    """
    def ask(query: str):
        return _reader(spark, url, driver, BUCKETS, properties).option("query", query).load().collect()
    quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)
    low, high, total = ask(f"SELECT MIN({quoted}) AS lo, MAX({quoted}) AS hi, COUNT({quoted}) AS n FROM {table}")[0]
    if not total:
        return []
    share = total / num_partitions

    def counted(start: int, stop: int) -> list[tuple[int, int, int]]:
        """(first value, value after the last, rows) of the non-empty buckets of [start, stop), in order."""
        width = max(1, -(-(stop - start) // BUCKETS))
        bucket = f"FLOOR(({quoted} - {start}) / {width})"
        rows = ask(f"SELECT b, COUNT(*) AS n FROM (SELECT {bucket} AS b FROM {table} "
                   f"WHERE {quoted} >= {start} AND {quoted} < {stop}) counted GROUP BY b")
        found = []
        for b, n in sorted((int(b), int(n)) for b, n in rows):
            first, after = start + b * width, min(stop, start + (b + 1) * width)
            found += counted(first, after) if n > share / FINE and after - first > 1 else [(first, after, n)]
        return found
    borders, held = [], 0
    for first, _, n in counted(int(low), int(high) + 1):
        # A border before the bucket if the range is nearer to its share without it.
        if held and len(borders) < num_partitions - 1 and held + n / 2 >= share:
            borders.append(first)
            held = 0
        held += n
    return borders


def read_jdbc(spark: SparkSession, url: str, table: str, *, driver: str | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetch_size: int = 10_000, properties: dict | None = None) -> DataFrame:
    """A table, in one query or in ``num_partitions`` ranges of ``partition_column`` (an integer column).

    Every row is in one range, rows without a value in the first.
    """
    reader = _reader(spark, url, driver, fetch_size, properties)
    if not partition_column:
        return reader.option("dbtable", table).load()
    if not num_partitions:
        raise ValueError("a partitioned JDBC read needs num_partitions")
    if lower_bound is not None and upper_bound is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
        return reader.option("dbtable", table).load()
    borders = balanced_ranges(spark, url, table, partition_column, num_partitions, driver=driver, properties=properties)
    name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(partition_column)
    if not borders:
        return reader.option("dbtable", table).load()
    ranges = [f"{name} < {borders[0]} OR {name} IS NULL",
              *[f"{name} >= {a} AND {name} < {b}" for a, b in zip(borders, borders[1:])], f"{name} >= {borders[-1]}"]
    options = {"fetchsize": str(fetch_size), **({"driver": driver} if driver else {}), **(properties or {})}
    return spark.read.jdbc(url, table, predicates=ranges, properties=options)
