"""DataFrame -> DataFrame operators (batch and, where Spark allows, streaming)."""
from clickflow.operators.transforms import (
    tokenize, word_count, unpivot_event, user_pairs, event_text, route, branch, merge_tagged,
    merge_routed, FIRST_PREFIX, SECOND_PREFIX,
)
from clickflow.operators.sequence import (
    keyed_row_number, keyed_prefix_sums, running_count, running_sum,
    count_window_sliding, count_window_tumbling, count_window_sum,
)
from clickflow.operators.windows import (
    tumbling_counts, sliding_counts, session_counts, dynamic_session_counts,
)
from clickflow.operators.topn import topn_rows, topn_array, topn_array_stream, render_top
from clickflow.operators.joins import (
    interval_join, reconcile, reconcile_alerts, reconcile_one_to_one, window_join, window_cogroup, window_cogroup_rows,
)

__all__ = [
    "tokenize", "word_count", "unpivot_event", "user_pairs", "event_text", "route", "branch", "merge_tagged",
    "merge_routed", "FIRST_PREFIX", "SECOND_PREFIX",
    "keyed_row_number", "keyed_prefix_sums", "running_count", "running_sum",
    "count_window_sliding", "count_window_tumbling", "count_window_sum",
    "tumbling_counts", "sliding_counts", "session_counts", "dynamic_session_counts",
    "topn_rows", "topn_array", "topn_array_stream", "render_top",
    "interval_join", "reconcile", "reconcile_alerts", "reconcile_one_to_one", "window_join", "window_cogroup",
    "window_cogroup_rows",
]
