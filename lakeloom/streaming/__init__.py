"""Structured Streaming form of the raw incremental load (ST1)."""

from lakeloom.streaming.file_stream import start_landing_stream

__all__ = ["start_landing_stream"]
