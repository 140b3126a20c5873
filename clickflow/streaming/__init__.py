"""Structured Streaming forms of the operators.

Watermarked twins of the windowed / joined operators (append mode), and the
stateful operators that need per-key state between micro-batches
(``applyInPandasWithState``), or state with timers (``transformWithState``).
"""
from clickflow.streaming.twins import (
    with_event_time, with_processing_time, console, stream_sliding_counts, stream_topn_array, stream_window_join, stream_window_cogroup,
    stream_interval_join, stream_reconcile, stream_session_counts, stream_user_totals,
)
from clickflow.streaming.stateful import running_count_state, count_window_state
from clickflow.streaming.timers import (
    reconcile_state, stream_topn_state, stream_window_cogroup_rows, processing_time_counts, processing_time_sessions,
)

__all__ = [
    "with_event_time", "with_processing_time", "console", "stream_sliding_counts", "stream_topn_array", "stream_window_join",
    "stream_window_cogroup", "stream_interval_join", "stream_reconcile", "stream_session_counts",
    "stream_user_totals", "running_count_state", "count_window_state", "reconcile_state",
    "stream_topn_state", "stream_window_cogroup_rows", "processing_time_counts", "processing_time_sessions",
]
