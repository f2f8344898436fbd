"""Grouped totals that are kept up to date from change sets, without reading their tables again.

A view is a table of sums by some columns. A change set knows the rows it replaces, as they were, and as they will be: the
view's change is the sum over the new rows less the sum over the old ones. Sums and counts can be taken back in this way, maxima
cannot. A view row whose sums are all zero goes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.changes import ChangeSet


@dataclass(frozen=True)
class View:
    """Sums of ``measures``, SQL expressions over one row of ``table``, by the columns ``by``; null measures count as zero."""

    table: str
    by: Sequence[str]
    measures: Mapping[str, str]

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*self.by, *[(F.coalesce(F.expr(m).cast("bigint"), F.lit(0)) * sign).alias(n) for n, m in self.measures.items()])

    def _summed(self, rows: DataFrame) -> DataFrame:
        sums = rows.groupBy(*self.by).agg(*[F.sum(n).cast("bigint").alias(n) for n in self.measures])
        return sums.filter(reduce(lambda a, b: a | b, [F.col(n) != 0 for n in self.measures]))

    def full(self, rows: DataFrame) -> DataFrame:
        """The view over a whole table."""
        return self._summed(self._signed(rows, 1))

    def delta(self, before: DataFrame | None, after: DataFrame | None) -> DataFrame:
        """What replacing ``before`` by ``after`` adds; None for rows that come or go for good."""
        parts = [self._signed(rows, sign) for rows, sign in ((before, -1), (after, 1)) if rows is not None]
        if not parts:
            raise ValueError("a delta needs rows before or after")
        return self._summed(reduce(DataFrame.unionByName, parts))

    def advanced(self, current: DataFrame, delta: DataFrame) -> DataFrame:
        return self._summed(current.unionByName(delta))

    def follow(self, current: DataFrame, change: ChangeSet, row: str = "job") -> DataFrame:
        """The view after a change set, whose decisions hold the rows of ``table`` as they were in the struct ``row``.

        Tables that the change set only adds to, such as events, have no rows as they were: give an empty ``row``.
        """
        if self.table not in change.tables:
            return current
        before = change.decisions.select(f"{row}.*") if row else None
        return self.advanced(current, self.delta(before, change._table(self.table)))


#: Jobs by tenant and status.
STATUS_COUNTS = View("jobs", ("tenant_id", "status"), {"jobs": "1"})
#: Unpublished events by tenant.
BACKLOG = View("events", ("tenant_id",), {"backlog": "IF(published_at IS NULL, 1, 0)"})
#: Failed attempts by tenant and instant, so that those of the last hours can be summed at any time.
FAILURES = View("attempts", ("tenant_id", "failed_at"), {"failures": f"IF(status = '{S.FAILED}' AND failed_at IS NOT NULL, 1, 0)"})


def board(status_counts: DataFrame, backlog: DataFrame, failures: DataFrame, as_of: R.Instant, hours: int = 24) -> DataFrame:
    """The tenants' dashboard from the views: jobs by status, unpublished events, failures of the last hours."""
    since = R.add_seconds(R.instant_like(as_of, failures, "failed_at"), -3600 * hours)
    counts = status_counts.groupBy("tenant_id").agg(F.map_from_entries(F.collect_list(F.struct("status", "jobs"))).alias("status_counts"),
                                                    F.sum("jobs").alias("total_jobs"))
    recent = failures.filter(F.col("failed_at") >= since).groupBy("tenant_id").agg(F.sum("failures").alias("failures"))
    joined = counts.join(backlog, "tenant_id", "full").join(recent, "tenant_id", "full")
    return joined.fillna(0, ["total_jobs", "backlog", "failures"]).select(
        "tenant_id", "status_counts", "total_jobs", F.col("backlog").alias("outbox_backlog"), F.col("failures").alias("failures_last_hours"))
