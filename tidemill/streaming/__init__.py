from .loads import stream_dedup, stream_incremental, stream_newest, stream_quality_gate, stream_source

__all__ = ["stream_dedup", "stream_incremental", "stream_newest", "stream_quality_gate", "stream_source"]
