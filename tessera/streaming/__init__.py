"""Streaming form of the raw -> clean landing (file-source stream + foreachBatch)."""

from tessera.streaming.landing import landing_stream, read_landed, start_landing

__all__ = ["landing_stream", "start_landing", "read_landed"]
