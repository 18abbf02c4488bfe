"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from parcelstar.demo import history, history_oracles, oracles, queries

QUERIES = queries.QUERIES | history.QUERIES
ORACLES = oracles.ORACLES | history_oracles.ORACLES
