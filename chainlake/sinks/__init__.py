"""Sinks: Kafka, any transport that acknowledges, archives, parts, snapshots, nothing, several at once."""

from .acknowledged import acknowledged, done_blocks
from .fanout import fan_out
from .files import archives, append_batch, snapshots
from .kafka import KafkaConfig, kafka, kafka_columns, kafka_options
from .null import noop, noop_count
from .objects import committed_parts, drop_uncommitted, parts, read_parts

__all__ = [
    "KafkaConfig",
    "acknowledged",
    "append_batch",
    "archives",
    "committed_parts",
    "done_blocks",
    "drop_uncommitted",
    "fan_out",
    "kafka",
    "kafka_columns",
    "kafka_options",
    "noop",
    "noop_count",
    "parts",
    "read_parts",
    "snapshots",
]
