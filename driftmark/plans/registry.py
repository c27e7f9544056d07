"""Every query outside the subpackage for training text."""

from __future__ import annotations

from driftmark.plans import data_queries, index_queries

QUERIES = {**data_queries.QUERIES, **index_queries.QUERIES}
ORACLES = {**data_queries.ORACLES, **index_queries.ORACLES}
