"""Streaming form of the request scorer."""

from .scoring import fallback_row, request_stream, score_stream, start_scoring

__all__ = ["request_stream", "score_stream", "fallback_row", "start_scoring"]
