"""Scans: parquet tables, event files as a stream, text lines, JDBC."""
from clickflow.sources.tables import read_table, read_events, as_click_events, app_side, third_side
from clickflow.sources.text import read_lines, document_lines
from clickflow.sources.streams import stream_table, stream_events
from clickflow.sources.literal import stream_literal, end_folder, without_end
from clickflow.sources.jdbc import read_jdbc

__all__ = [
    "read_table", "read_events", "as_click_events", "app_side", "third_side",
    "read_lines", "document_lines", "stream_table", "stream_events",
    "stream_literal", "end_folder", "without_end", "read_jdbc",
]
