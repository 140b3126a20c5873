"""Literal bounded streams, and the end of a bounded stream.

A source that ends closes every window: its watermark goes to the end of time.
Spark's does not, and leaves the last windows in state.  So the last row of a
bounded source here is an end row: ``END`` in the time column, and whole
numbers and texts that no other row holds, so that it meets no partner (a null
would be filtered out before a join, and the watermark would not see it).  It
moves the watermark past all real rows and is never in a windowed or joined
result itself, as its own window, interval or deadline never closes.  Other
operators pass it on; ``without_end`` drops it.

``stream_literal`` is a replayable source of given rows through Spark's Python
Data Source API.  ``end_folder`` adds end rows to a folder of parquet files
that a stream reads.
"""
from __future__ import annotations

import base64
import datetime as dt
import pickle
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

UTC = dt.timezone.utc
END = dt.datetime(9000, 7, 1, tzinfo=UTC)  # its year is the same in every time zone
NAME = "clickflow_literal"


def _value(value, kind: T.DataType):
    """Numbers in a time column are epoch milliseconds; times without a zone are UTC."""
    if value is None or not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return value
    if isinstance(value, (int, float)):
        value = dt.datetime(1970, 1, 1, tzinfo=UTC) + dt.timedelta(milliseconds=value)
    if isinstance(kind, T.TimestampNTZType):
        return value.replace(tzinfo=None)
    return value if value.tzinfo else value.replace(tzinfo=UTC)


def _end_row(schema: T.StructType, ts: str, given: dict) -> tuple:
    own = uuid.uuid4().int
    lowest = {T.LongType: -2 ** 63, T.IntegerType: -2 ** 31, T.ShortType: -2 ** 15, T.ByteType: -2 ** 7}

    def value(f: T.StructField):
        if f.name == ts:
            return _value(END, f.dataType)
        if f.name in given:
            return given[f.name]
        if isinstance(f.dataType, T.StringType):
            return f"\uffff{own:x}"
        low = lowest.get(type(f.dataType))
        return None if low is None else low + own % (-low // 2)
    return tuple(value(f) for f in schema)


class LiteralRows(DataSource):
    """Rows from the options: the same ones for every reader and every restart."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(_unpacked(self.options["schema"]))

    def streamReader(self, schema: T.StructType) -> "LiteralReader":
        return LiteralReader(_unpacked(self.options["rows"]))


class LiteralReader(DataSourceStreamReader):
    """The offset is the number of rows; a micro-batch is what lies between two."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        return {"rows": len(self.rows)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [InputPartition((start["rows"], end["rows"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        first, last = partition.value
        yield from self.rows[first:last]


def _packed(value) -> str:
    return base64.b64encode(pickle.dumps(value)).decode()


def _unpacked(text: str):
    return pickle.loads(base64.b64decode(text))


def stream_literal(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str,
                   ts: str | None = "ts") -> DataFrame:
    """A bounded stream of ``rows`` in their order, ended by an end row in ``ts`` (none if ``ts`` is None).

    Rows travel as an option of the source, so they are meant to be few, as
    the elements written in a program are.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    given = [tuple(_value(v, f.dataType) for v, f in zip(row, schema)) for row in rows]
    if ts is not None:
        given.append(_end_row(schema, ts, {}))
    open_schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    spark.dataSource.register(LiteralRows)
    return (spark.readStream.format(NAME).option("schema", _packed(open_schema.jsonValue()))
            .option("rows", _packed(given)).load())


def end_folder(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts",
               rows: Sequence[dict] = ({},)) -> None:
    """Add a file of end rows to a folder of parquet files that a stream reads.

    One end row per source that is made from the folder: ``rows`` gives the
    values that its filter asks for (``{"event_type": "click"}``).
    """
    given = [_end_row(schema, ts, row) for row in rows]
    open_schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    spark.createDataFrame(given, open_schema).coalesce(1).write.mode("append").parquet(path)


def is_end(ts: str | Column = "ts") -> Column:
    """Whether a row is an end row (``ts`` may be a TIMESTAMP or a TIMESTAMP_NTZ)."""
    at = F.col(ts) if isinstance(ts, str) else ts
    return F.coalesce(F.year(at) >= END.year, F.lit(False))


def without_end(df: DataFrame, ts: str = "ts") -> DataFrame:
    """``df`` without end rows, for operators that keep no state."""
    return df.where(~is_end(ts))
