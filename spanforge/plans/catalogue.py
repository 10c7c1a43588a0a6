"""Registered queries and the SQL that states the same results."""

from __future__ import annotations

from spanforge.plans import documents, entities, matching

QUERIES = {**documents.QUERIES, **entities.QUERIES, **matching.QUERIES}
ORACLES = {**documents.ORACLES, **entities.ORACLES, **matching.ORACLES}
