"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""
from clickflow.functions.time import epoch_micros, epoch_millis, event_time, ntz_from_millis, seconds, to_micros
from clickflow.functions.text import java_space_split, event_string, pair_string, split_lines

__all__ = [
    "epoch_micros", "epoch_millis", "event_time", "ntz_from_millis", "seconds", "to_micros",
    "java_space_split", "event_string", "pair_string", "split_lines",
]
