"""Scoring over Structured Streaming."""

from .scoring import read_requests, write_scores

__all__ = ["read_requests", "write_scores"]
