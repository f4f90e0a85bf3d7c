"""Every operator as a named query over the test tables, with its SQL counterpart."""

from __future__ import annotations

from scoreloom.suite import ensembles, features, ledgers, models, ordered, profiles, tables
from scoreloom.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "ensembles", "features", "ledgers", "models", "ordered", "profiles", "tables"]
