"""The refresh as a stream of landed files."""

from tidemark.streaming.refresh import stream_refresh

__all__ = ["stream_refresh"]
