"""Streaming forms of the operators that need more than the batch function."""

from .archives import closing_archives, follow_closed_archives
from .merge import follow_merged, read_waiting
from .publish import publish_stream
from .rates import follow_heatmap, follow_samples, read_heatmap, read_rate
from .replay import follow_archives
from .series_state import follow_rates, read_hit_rate, read_late, read_percent, read_rates
from .state import compact_state, follow_state, follow_state_store, read_state, read_state_store

__all__ = [
    "closing_archives",
    "compact_state",
    "follow_archives",
    "follow_closed_archives",
    "follow_heatmap",
    "follow_merged",
    "follow_rates",
    "follow_samples",
    "follow_state",
    "follow_state_store",
    "publish_stream",
    "read_heatmap",
    "read_hit_rate",
    "read_late",
    "read_percent",
    "read_rate",
    "read_rates",
    "read_state",
    "read_state_store",
    "read_waiting",
]
