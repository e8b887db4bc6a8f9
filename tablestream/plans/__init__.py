"""The registered queries and their SQL counterparts."""

from tablestream.plans import (
    alerts,
    changes,
    quality,
    sales,
    service,
    state,
    storage,
    streams,
    tables,
    weather,
)
from tablestream.plans.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "alerts", "changes", "quality", "sales", "service", "state", "storage",
    "streams", "tables", "weather",
]
