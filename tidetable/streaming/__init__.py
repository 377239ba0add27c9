"""Loading from streams."""

from tidetable.streaming.load import stream_load

__all__ = ["stream_load"]
