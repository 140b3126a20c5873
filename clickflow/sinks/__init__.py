"""Sinks: rolling text files and JDBC append (batch and streaming)."""
from clickflow.sinks.text import write_text, stream_text, arrival_bucket
from clickflow.sinks.rolling import Parts, RollOnIdle, stream_rolling_text
from clickflow.sinks.jdbc import write_jdbc_append, foreach_batch_jdbc, stream_jdbc

__all__ = ["write_text", "stream_text", "arrival_bucket", "Parts", "RollOnIdle", "stream_rolling_text", "write_jdbc_append", "foreach_batch_jdbc", "stream_jdbc"]
