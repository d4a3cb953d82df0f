"""All registered queries; importing the modules fills the registry."""

from eventlens.plans import (  # noqa: F401
    aggregate_queries,
    change_queries,
    event_queries,
    redaction_queries,
    stream_queries,
)
from eventlens.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
