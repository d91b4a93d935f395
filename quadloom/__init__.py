"""Graph and triple analytics as Spark DataFrame jobs."""

from quadloom.session import configure, local_session

__all__ = ["configure", "local_session"]
