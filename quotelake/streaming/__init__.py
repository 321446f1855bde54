"""Streaming form of the incremental ingest."""

from quotelake.streaming import ingest
from quotelake.streaming.ingest import (
    append_batch,
    committed_batches,
    compact,
    read_committed,
    stream_csv_to_raw,
    stream_partitions,
)

__all__ = [
    "append_batch",
    "committed_batches",
    "compact",
    "ingest",
    "read_committed",
    "stream_csv_to_raw",
    "stream_partitions",
]
