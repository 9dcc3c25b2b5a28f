from .runner import FlowStream, stream_window_stats, write_window_batch, write_window_updates
from .stateful import stream_distinct, stream_join_in_windows

__all__ = ["FlowStream", "stream_distinct", "stream_join_in_windows", "stream_window_stats", "write_window_batch",
           "write_window_updates"]
