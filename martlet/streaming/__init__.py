"""Structured Streaming front ends."""

from martlet.streaming.landing import start_landing_stream, state_path

__all__ = ["start_landing_stream", "state_path"]
