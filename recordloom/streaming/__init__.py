"""Structured Streaming forms of the incremental merge."""

from recordloom.streaming.merge import late_rows, stream_merge, trailing_stream, window_dedupe

__all__ = ["late_rows", "stream_merge", "trailing_stream", "window_dedupe"]
