"""traceframe: ingest, filter, decode and validate trace events with PySpark."""

from traceframe.operators.manifest import Manifest
from traceframe.plans.trace import Trace, preset

__all__ = ["Manifest", "Trace", "preset"]
