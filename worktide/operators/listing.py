"""Filtered, ordered pages of jobs and dead letters, and the history of jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.sources.tables import scope

_SORTS = ("created_at", "run_at", "priority")


def page_number(page: int) -> int:
    return max(1, page)


#: Rows a page may have. ``matching_jobs`` gives all of them.
LARGEST_PAGE = 100


def page_size(size: int) -> int:
    if not 1 <= size <= LARGEST_PAGE:
        raise ValueError(f"a page has 1 to {LARGEST_PAGE} rows")
    return size


@dataclass(frozen=True)
class JobFilter:
    """What to list. Fields left empty do not filter; unsupported values are refused."""

    tenant_id: object
    status: str = ""
    job_type: str = ""
    created_after: R.Instant | None = None
    created_before: R.Instant | None = None
    sort: str = "created_at"
    order: str = "desc"
    page: int = 1
    size: int = 20

    def __post_init__(self) -> None:
        if self.status and self.status not in S.STATUSES:
            raise ValueError("unsupported status filter")
        if self.job_type and self.job_type not in S.JOB_TYPES:
            raise ValueError("unsupported job_type filter")
        if self.sort not in _SORTS:
            raise ValueError("unsupported sort")
        if self.order not in ("asc", "desc"):
            raise ValueError("unsupported order")
        after, before = self.created_after, self.created_before
        given = after is not None and before is not None and not isinstance(after, Column) and not isinstance(before, Column)
        if given and R.moment(after) > R.moment(before):
            raise ValueError("created_after must not be after created_before")


def matching_jobs(jobs: DataFrame, wanted: JobFilter) -> DataFrame:
    """The rows a filter selects; every predicate given reaches the scan."""
    rows = scope(jobs, wanted.tenant_id)
    if wanted.status:
        rows = rows.filter(F.col("status") == wanted.status)
    if wanted.job_type:
        rows = rows.filter(F.col("job_type") == wanted.job_type)
    if wanted.created_after is not None:
        rows = rows.filter(F.col("created_at") >= R.instant_like(wanted.created_after, jobs, "created_at"))
    if wanted.created_before is not None:
        rows = rows.filter(F.col("created_at") <= R.instant_like(wanted.created_before, jobs, "created_at"))
    return rows


def _directed(name: str, order: str) -> Column:
    return F.asc(name) if order == "asc" else F.desc(name)


def list_jobs(jobs: DataFrame, wanted: JobFilter) -> DataFrame:
    """One page, with the id as tie-breaker in the same direction."""
    size = page_size(wanted.size)
    skip = (page_number(wanted.page) - 1) * size
    ordered = matching_jobs(jobs, wanted).orderBy(
        _directed(wanted.sort, wanted.order), _directed("job_id", wanted.order)
    )
    return ordered.offset(skip).limit(size) if skip else ordered.limit(size)


def list_jobs_total(jobs: DataFrame, wanted: JobFilter) -> DataFrame:
    return matching_jobs(jobs, wanted).agg(F.count(F.lit(1)).alias("total"))


def list_jobs_after(jobs: DataFrame, wanted: JobFilter, last_value: object, last_id: object) -> DataFrame:
    """The page after a known last row. Costs the same for every page, unlike an offset."""
    value = R.instant_like(last_value, jobs, wanted.sort) if wanted.sort != "priority" else F.lit(last_value)
    column, ident = F.col(wanted.sort), F.col("job_id")
    if wanted.order == "asc":
        beyond = (column > value) | ((column == value) & (ident > F.lit(last_id)))
    else:
        beyond = (column < value) | ((column == value) & (ident < F.lit(last_id)))
    return matching_jobs(jobs, wanted).filter(beyond).orderBy(
        _directed(wanted.sort, wanted.order), _directed("job_id", wanted.order)
    ).limit(page_size(wanted.size))


def list_dead_letters(dead_letters: DataFrame, tenant_id: object, page: int = 1, size: int = 20) -> DataFrame:
    """A tenant's dead letters, newest first."""
    limit = page_size(size)
    newest = "created_at" if "created_at" in dead_letters.columns else "failed_at"
    rows = scope(dead_letters, tenant_id).orderBy(F.desc(newest), F.desc("dead_letter_id"))
    skip = (page_number(page) - 1) * limit
    return rows.offset(skip).limit(limit) if skip else rows.limit(limit)


def job_detail(jobs: DataFrame, attempts: DataFrame, events: DataFrame, tenant_id: object,
               job_id: object) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One job with its attempts in attempt order and its events in time order."""
    def own(df: DataFrame) -> DataFrame:
        rows = df.filter(F.col("job_id") == F.lit(job_id))
        return scope(rows, tenant_id) if "tenant_id" in df.columns else rows

    return own(jobs), own(attempts).orderBy("attempt_number", "attempt_id"), own(events).orderBy("created_at", "event_id")


def job_history(jobs: DataFrame, attempts: DataFrame, events: DataFrame) -> DataFrame:
    """Every job with a summary of its attempts and events.

    Each child is aggregated by job before the join, so there is no fan-out and no row grows with the
    number of children.
    """
    tried = attempts.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == S.FAILED).alias("failed_attempts"),
        F.max("attempt_number").alias("last_attempt_number"),
        F.max_by("status", F.struct("attempt_number", "attempt_id")).alias("last_attempt_status"),
    )
    said = events.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min_by("event_type", F.struct("created_at", "event_id")).alias("first_event"),
        F.max_by("event_type", F.struct("created_at", "event_id")).alias("last_event"),
        F.max("created_at").alias("last_event_at"),
    )
    return jobs.select("job_id", "tenant_id", "job_type", "status").join(tried, "job_id", "left").join(
        said, "job_id", "left"
    ).fillna(0, ["attempts", "failed_attempts", "events"])


def job_timeline(jobs: DataFrame, attempts: DataFrame, events: DataFrame) -> DataFrame:
    """The same history as rows: job_id, section ('attempt' or 'event'), at, item_id, label.

    A long form, because a list column per job would have to hold all rows of a hot job at once.
    """
    known = jobs.select("job_id")
    tried = attempts.select("job_id", F.lit("attempt").alias("section"), F.col("started_at").alias("at"),
                            F.col("attempt_id").alias("item_id"), F.col("status").alias("label"))
    said = events.select("job_id", F.lit("event").alias("section"), F.col("created_at").alias("at"),
                         F.col("event_id").alias("item_id"), F.col("event_type").alias("label"))
    return tried.unionByName(said).join(known, "job_id", "left_semi")
