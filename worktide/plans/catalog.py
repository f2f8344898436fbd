"""All registered queries."""

from __future__ import annotations

from worktide.plans import access, jobs, metrics, streams  # noqa: F401 - importing a module registers its queries
from worktide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
