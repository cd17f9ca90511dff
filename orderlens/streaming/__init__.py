"""JSON message codec, stream source, checkpointed append sink."""

from orderlens.streaming.codec import decode, encode, publish, rejects
from orderlens.streaming.ingest import read_stream, run_append, run_rejects

__all__ = ["decode", "encode", "publish", "read_stream", "rejects", "run_append", "run_rejects"]
