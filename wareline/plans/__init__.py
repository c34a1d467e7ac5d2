"""Jobs assembled from the operators, and the registered queries."""

from wareline.plans.registry import ORACLES, QUERIES
from wareline.plans import (  # noqa: F401
    catalog_queries,
    event_queries,
    job_queries,
    model_queries,
    text_queries,
)

__all__ = ["ORACLES", "QUERIES"]
