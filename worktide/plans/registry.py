"""The catalogue of queries: a name, a function of (session, folder), and its oracle SQL if it has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from worktide.plans.views import EVENTS_AS_OF, JOBS_AS_OF, Views, with_views
from worktide.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

JOBS_NOW = f"TIMESTAMP '{JOBS_AS_OF}'"
EVENTS_NOW = f"TIMESTAMP '{EVENTS_AS_OF}'"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), ctes: str = ""):
    """Register a query over ``Views``. ``sql`` is its oracle; ``views`` and ``ctes`` go before it."""
    def register(build: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Views(prepare(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            head = with_views(*views) if views else ""
            if ctes:
                head = f"{head},\n{ctes.strip()}" if head else f"WITH RECURSIVE {ctes.strip()}"
            ORACLES[name] = f"{head}\n{sql.strip()}".strip()
        return build
    return register
