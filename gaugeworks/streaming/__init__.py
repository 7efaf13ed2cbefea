from gaugeworks.streaming.counters import stream_counter_deltas
from gaugeworks.streaming.events import (
    event_stream,
    stream_deadlocks,
    stream_facts,
    stream_tables,
    stream_unreadable,
    stream_workload,
)

__all__ = [
    "event_stream",
    "stream_counter_deltas",
    "stream_deadlocks",
    "stream_facts",
    "stream_tables",
    "stream_unreadable",
    "stream_workload",
]
