"""Sessions and log counts over streams, with the results of their batch forms."""

from loomframe.streaming.logs import access_events, counts_so_far, windowed_counts
from loomframe.streaming.sessions import stream_sessions
from loomframe.streaming.sinks import drained, follow_files

__all__ = [
    "access_events",
    "counts_so_far",
    "drained",
    "follow_files",
    "stream_sessions",
    "windowed_counts",
]
