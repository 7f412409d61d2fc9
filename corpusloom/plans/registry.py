"""All queries of the library, by name, and their SQL."""

from __future__ import annotations

from ..streaming import ingest
from . import audit, candidates, classify, contracts, coverage, disclosure, gates, lines, passages, records

_MODULES = (audit, classify, lines, coverage, candidates, gates, records, contracts, disclosure, passages, ingest)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
FLAGSHIP = "audit_summary"
