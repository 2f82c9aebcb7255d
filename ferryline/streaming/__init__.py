"""Structured Streaming helpers: fan-out handler and query runner."""

from ferryline.streaming.fanout import fan_out, single_sink
from ferryline.streaming.runner import run_available, start_stream

__all__ = ["fan_out", "run_available", "single_sink", "start_stream"]
