"""Structured Streaming jobs."""

from ringwise.streaming.monitor import alerts_for, monitor_new_claims, watchlist

__all__ = ["alerts_for", "monitor_new_claims", "watchlist"]
