"""Structured Streaming entry points."""

from .landed import epoch_batch_id, ingest_batch, ingest_landed, stream_id

__all__ = ["epoch_batch_id", "ingest_batch", "ingest_landed", "stream_id"]
