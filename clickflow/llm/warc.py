"""WARC archives and their capture index, built by external merge.

1. Writing.  One record per row, as gzip-compressed WARC/1.1 files.  Spark's
   own text writer does it: a record ends with two line ends, so those are
   the line separator and each row is one record.  Files are committed by
   Spark; a lost executor's tasks simply run again.
2. Reading.  A gzip file is read by one task in order.  Lines are joined to
   records again by Content-Length, one record at a time, whatever the
   payload holds.
3. Runs.  Each reading task sorts its index entries by (URL key, time, id) in
   runs of ``RUN_ROWS`` and cuts each run at global splitters.
4. Merge.  One task per key range merges the slices of all runs with a loser
   tree.  Splitters are whole sort keys, so one URL with a third of all
   captures is spread over many ranges.

Payload digests are SHA-1 in base32, as WARC uses.  Of records with equal
payloads the one with the smallest id is the response, the others are
revisits without payload; their headers carry the payload's length.
"""
from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import scratch_path

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
CAPTURE_EPOCH = "2024-01-01T00:00:00Z"
RUN_ROWS = 20_000     # entries a reading task sorts at once
RANGE_ROWS = 20_000   # entries a merge task gets, on average
SPLIT_KEYS = 8        # sampled keys per range (20,000 keys at least); they only balance the ranges
ENTRY = ("url_key string, captured string, record_id string, url string, record_type string, "
         "payload_digest string, payload_bytes bigint, refers_to string")
ENTRY_NAMES = [f.split()[0] for f in ENTRY.split(", ")]


def base32(hex40: Column) -> Column:
    """40 hex digits as bare upper-case base32 (RFC 4648): 40 bits are 8 digits of 5."""
    digits = [F.lpad(F.conv(F.substring(hex40, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _clean(c: Column) -> Column:
    """A header value: line ends would end the header, so they are percent-coded."""
    return F.replace(F.replace(c, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
            captured: str | None = None, min_bytes: int = 0) -> DataFrame:
    """One row per row of ``pages`` with its headers' values and payload, revisits decided.

    Null payloads are empty.  Equal payloads of at least ``min_bytes`` bytes
    share one response, the row with the smallest key; rows that repeat that
    key are responses too; null keys never refer or are referred to unless all
    are null.  Only (digest, smallest key) of payloads that occur more than
    once travel to the join; the join's big side may be split when a payload
    is very common.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    when = F.coalesce(F.date_format(F.to_utc_timestamp(F.col(captured), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                      F.lit(CAPTURE_EPOCH)) if captured else F.lit(CAPTURE_EPOCH)
    rows = pages.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), when.alias("captured"),
                        F.octet_length(body).cast("long").alias("payload_bytes"),
                        F.upper(F.sha1(body)).alias("sha1"), body.alias("body"))
    first = (rows.where(F.col("payload_bytes") >= min_bytes)
             .groupBy(F.col("sha1").alias("f_sha1"), F.col("payload_bytes").alias("f_bytes"))
             .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = rows.join(first, (F.col("sha1") == F.col("f_sha1")) & (F.col("payload_bytes") == F.col("f_bytes")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.select("id", "url", "captured", "payload_bytes", base32(F.col("sha1")).alias("digest"), "body",
                         F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, path: str) -> None:
    """Write ``records()`` rows as gzip WARC files in folder ``path``."""
    revisit = F.col("refers_to").isNotNull()
    head = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:row:"), F.col("id").cast("string"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), _clean(F.col("url"))),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:row:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, "0").otherwise(F.col("payload_bytes").cast("string"))),
    ]
    record = F.concat(F.concat_ws(CRLF, *head), F.lit(RECORD_END), F.when(revisit, "").otherwise(F.col("body")))
    (rows.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip").text(path))


def parse_records(lines: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record from (file, line) pairs; lines are what stood between RECORD_ENDs.

    The bytes of the file are put together again and cut by Content-Length,
    because a payload may hold or touch a separator.
    """
    sep = RECORD_END.encode()
    source, held = None, bytearray()
    headers: dict[str, str] | None = None
    need = 0  # bytes that must be held before there is anything to do

    def closed() -> None:
        if headers is not None or held.strip(b"\r\n"):
            raise ValueError(f"{source}: the archive ends inside a record")

    for file, line in lines:
        if file != source:
            closed()
            source, need = file, 0
            held.clear()
        held += line
        held += sep
        while len(held) >= need:
            if headers is None:
                end = held.find(sep)
                if end < 0 or not held.startswith(b"WARC/"):
                    break
                headers = dict(x.split(": ", 1) for x in held[:end].decode("utf-8").split(CRLF)[1:])
                del held[:end + len(sep)]
                need = int(headers["Content-Length"]) + len(sep)
                continue
            payload = bytes(held[:need - len(sep)])
            if held[need - len(sep):need] != sep:
                raise ValueError(f"{source}: a record does not end where its Content-Length says")
            yield headers, payload
            del held[:need]
            headers, need = None, 0
    closed()


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then path and query; scheme, port 80/443 and fragment left out."""
    rest = url.partition("://")[2] or url
    rest = rest.partition("#")[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host = rest[:cut].lower()
    for port in (":80", ":443"):
        host = host.removesuffix(port)
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:]


def _row_of(urn: str | None) -> str | None:
    return urn[len("<urn:row:"):-1] if urn is not None else None


def read_archives(spark, path: str) -> DataFrame:
    """Index entries (``ENTRY``) of all records in ``path``; digests are taken anew from the payloads.

    A response whose payload does not have the digest its header names is an
    error.  Memory is one record at a time.
    """
    lines = (spark.read.option("lineSep", RECORD_END).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line")))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs():
            for b in batches:
                yield from zip(b.column("file").to_pylist(), b.column("line").to_pylist())
        rows: list[tuple] = []
        for head, payload in parse_records(pairs()):
            digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
            size = int(head["X-Payload-Length"])
            if head["WARC-Type"] == "response":
                own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if (own, len(payload)) != (digest, size):
                    raise ValueError(f"record {head.get('WARC-Record-ID')}: payload and digest differ")
            url = head.get("WARC-Target-URI")
            rows.append((url_key(url) if url is not None else "", head["WARC-Date"], _row_of(head.get("WARC-Record-ID")),
                         url, head["WARC-Type"], digest, size, _row_of(head.get("WARC-Refers-To"))))
            if len(rows) == 2000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return lines.mapInArrow(entries, ENTRY)


def _batch(rows: list[tuple], extra: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    kinds = [pa.int64() if n == "payload_bytes" else pa.string() for n in ENTRY_NAMES]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays([*(extra or {}).values(), *arrays], names=[*(extra or {}), *ENTRY_NAMES])


def sort_key(entry: tuple) -> tuple:
    """(URL key, time, id as a number where it is one, the rest to break ties)."""
    rid = entry[2]
    number = int(rid) if rid is not None and rid.lstrip("-").isdigit() else -1
    return entry[0], entry[1], rid is not None, number, rid or "", entry[3] or "", entry[5]


class LoserTree:
    """Merges sorted lists: inner nodes keep the losers, so each step replays one leaf-to-root path."""

    def __init__(self, runs: list[list[tuple[tuple, tuple]]]):
        self.runs = [r for r in runs if r]
        self.at = [0] * len(self.runs)
        k = self.k = len(self.runs)
        self.tree = [-1] * max(k, 1)  # tree[0] is the winner
        for leaf in range(k):
            self._replay(leaf, building=True)

    def _key(self, run: int):
        return self.runs[run][self.at[run]][0] if self.at[run] < len(self.runs[run]) else None

    def _beats(self, a: int, b: int) -> bool:
        ka, kb = self._key(a), self._key(b)
        if ka is None or kb is None:
            return kb is None and ka is not None
        return (ka, a) < (kb, b)

    def _replay(self, leaf: int, building: bool = False) -> None:
        node, winner = (leaf + self.k) // 2, leaf
        while node > 0:
            held = self.tree[node]
            if building and held < 0:  # wait here for the sibling
                self.tree[node] = winner
                return
            if held >= 0 and self._beats(held, winner):
                self.tree[node], winner = winner, held
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self._key(w := self.tree[0]) is not None:
            yield self.runs[w][self.at[w]][1]
            self.at[w] += 1
            self._replay(w)


def merge_index(entries: DataFrame, range_rows: int = RANGE_ROWS, run_rows: int = RUN_ROWS) -> DataFrame:
    """Globally ordered capture histories: ``range_no``, ``position`` in the range, and the entry.

    Reading (range_no, position) in order gives all captures by URL key, time
    and id.  ``entries`` must be cheap to read twice (a written table).
    """
    n = entries.count()
    ranges = max(1, -(-n // range_rows))
    cuts = _splitters(entries, n, ranges)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[tuple, tuple]] = []

        def flush():
            held.sort(key=itemgetter(0))
            keys = [k for k, _ in held]
            edges = [0, *(bisect_left(keys, c) for c in cuts), len(held)]
            for r, (a, b) in enumerate(zip(edges, edges[1:])):
                if a < b:
                    part = [e for _, e in held[a:b]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r], pa.int64()), pa.array([_pack(part)], pa.binary())], names=["range_no", "run"])
            held.clear()

        for b in batches:
            for e in zip(*(c.to_pylist() for c in b.columns)):
                held.append((sort_key(e), e))
                if len(held) == run_rows:
                    yield from flush()
        yield from flush()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        slices = []
        for blob in table.column("run").to_pylist():
            part = _unpack(blob)
            slices.append([(sort_key(e), e) for e in part])
        out = list(LoserTree(slices))
        first = {"range_no": pa.array([key[0].as_py()] * len(out), pa.int64()),
                 "position": pa.array(range(len(out)), pa.int64())}
        return pa.Table.from_batches([_batch(out, first)])

    slim = entries.select(*ENTRY_NAMES)
    sliced = slim.mapInArrow(runs, "range_no bigint, run binary")
    return sliced.groupBy("range_no").applyInArrow(merge, f"range_no bigint, position bigint, {ENTRY}")


def _pack(part: list[tuple]) -> bytes:
    batch = _batch(part)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> list[tuple]:
    with pa.ipc.open_stream(blob) as r:
        return [e for b in r for e in zip(*(c.to_pylist() for c in b.columns))]


def _splitters(entries: DataFrame, n: int, ranges: int) -> list[tuple]:
    """``ranges - 1`` sort keys that cut the entries about evenly (from a sample of bounded size)."""
    if ranges == 1:
        return []
    keep = max(1, n // max(20_000, ranges * SPLIT_KEYS))
    picked = entries.where(F.pmod(F.xxhash64("record_id", "url", "captured"), F.lit(keep)) == 0).select(*ENTRY_NAMES)
    keys = sorted(sort_key(tuple(r)) for r in picked.toLocalIterator())
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


def archive_index(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                  captured: str | None = None, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` as WARC files, read them back, and return the merged index.

    Columns: those of ``ENTRY`` with ``record_id`` and ``refers_to`` in the key
    column's type, and (range_no, position).  Empty tables give no rows;
    repeated rows give one record each; other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(records(pages, key, url, payload, captured, min_bytes), path)
    index = scratch_path(spark, "warc-entries")
    read_archives(spark, path).write.parquet(index)
    merged = merge_index(spark.read.schema(ENTRY).parquet(index))
    kind = dict(pages.dtypes)[key]
    return merged.withColumns({c: F.col(c).cast(kind) for c in ("record_id", "refers_to")})
