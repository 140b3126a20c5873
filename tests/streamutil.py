"""Drive a streaming query over a folder of parquet files, one file per micro-batch."""
import os
import tempfile
import time
import uuid

import pyarrow as pa
import pyarrow.parquet as pq


def write_batches(folder, frames):
    """Write each pandas frame as its own parquet file with increasing mtimes."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 10_000
    for i, pdf in enumerate(frames):
        path = os.path.join(folder, f"part-{i:05d}.parquet")
        pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), path)
        os.utime(path, (base + i, base + i))
    return folder


def run_to_memory(df, mode="append"):
    """Run a streaming DataFrame with availableNow into a memory table; return its rows as a DataFrame."""
    spark = df.sparkSession
    name = "m" + uuid.uuid4().hex[:12]
    ckpt = tempfile.mkdtemp(prefix="cf-stream-ckpt-")
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(300)
    if q.exception():
        raise q.exception()
    return spark.table(name)
