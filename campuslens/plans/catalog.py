"""All registered queries."""

from campuslens.plans import (  # noqa: F401
    alert_queries,
    analysis_queries,
    document_queries,
    identity_queries,
    model_queries,
    reconciliation_queries,
    register_queries,
    source_queries,
    text_queries,
)
from campuslens.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
