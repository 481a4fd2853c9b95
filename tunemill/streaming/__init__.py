"""Structured Streaming operators."""

from .history_stream import history_stream, run_history_stream

__all__ = ["history_stream", "run_history_stream"]
