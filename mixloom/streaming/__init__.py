"""Jobs that run as streams."""

from mixloom.streaming.observed import DELIVERIES, read_observed, stream_observed

__all__ = ["DELIVERIES", "read_observed", "stream_observed"]
