"""All registered queries; importing this module fills the registry."""

from jobmeld.queries import enrich_q, extract_q, flow_q, golden_q, identity_q, scalar_q, storage_q  # noqa: F401
from jobmeld.queries.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
