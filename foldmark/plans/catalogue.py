"""All queries of the engine by name."""

from __future__ import annotations

from foldmark.plans import audits, consensus, contexts, gates, joining, levels, market, measures, names, replies, rules, series, signals, stages, storage, texts, views  # noqa: F401  they name their queries
from foldmark.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
