"""All queries of the library and their SQL."""

from __future__ import annotations

from cladeforge.plans import asof_queries, cluster_queries, lookup_queries, predict_queries, region_queries, release_queries, residue_queries, search_queries, source_queries, tree_queries  # noqa: F401
from cladeforge.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
