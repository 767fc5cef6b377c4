"""Structured Streaming: file streams, event-time windows, joins, dedup and custom state."""

from larkspan.streaming.run import drain
from larkspan.streaming.state import running_counts, running_totals
from larkspan.streaming.streams import event_stream, interval_joined, sessions, sliding, tumbling, unique_events

__all__ = ["drain", "event_stream", "interval_joined", "running_counts", "running_totals", "sessions", "sliding", "tumbling", "unique_events"]
