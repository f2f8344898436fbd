"""The execution path in bulk: rank due work, start it, finish it, recover what was lost."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.changes import (
    ChangeSet, event_rows, first_per, guarded_join, payload_text, revise,
)
from worktide.operators.ranks import with_positions

DUE_ORDER = (F.desc, "priority"), (F.asc, "run_at"), (F.asc, "created_at"), (F.asc, "job_id")


def _due_order() -> list[Column]:
    return [direction(name) for direction, name in DUE_ORDER]


def due_top_k(jobs: DataFrame, as_of: R.Instant, k: int) -> DataFrame:
    """The ``k`` due jobs that would be taken first. Plans as a per-task top-k, not a full sort."""
    now = R.instant_like(as_of, jobs, "run_at")
    return jobs.filter(R.is_due(now)).orderBy(*_due_order()).limit(k)


def batch_plan(jobs: DataFrame, as_of: R.Instant, workers: Sequence[str], size: int) -> DataFrame:
    """Disjoint batches of ``size`` jobs, one per worker, in the order consecutive claims would take them.

    The un-partitioned window ranks only the ``len(workers) * size`` rows the limit let through.
    """
    if size < 1 or not workers:
        raise ValueError("a batch plan needs at least one worker and a positive size")
    top = due_top_k(jobs, as_of, len(workers) * size).select("job_id", "priority", "run_at", "created_at")
    ranked = top.withColumn("position", F.row_number().over(Window.orderBy(*_due_order())))
    batch = F.floor((F.col("position") - 1) / F.lit(size)).cast("int")
    names = F.array(*[F.lit(name) for name in workers])
    return ranked.withColumn("batch", batch).withColumn("worker_id", names[F.col("batch")])


def batch_plan_all(jobs: DataFrame, as_of: R.Instant, workers: Sequence[str], size: int) -> DataFrame:
    """Batches of ``size`` over all due jobs, dealt to the workers in turn, in the order consecutive claims would take them.

    Positions come from ranges of the order and their counts, so that no task sees all due jobs.
    """
    if size < 1 or not workers:
        raise ValueError("a batch plan needs at least one worker and a positive size")
    now = R.instant_like(as_of, jobs, "run_at")
    due = jobs.filter(R.is_due(now)).select("job_id", "priority", "run_at", "created_at")
    ranked = with_positions(due, _due_order())
    batch = F.floor((F.col("position") - 1) / F.lit(size)).cast("bigint")
    names = F.array(*[F.lit(name) for name in workers])
    return ranked.withColumn("batch", batch).withColumn("worker_id", F.get(names, F.pmod("batch", F.lit(len(workers))).cast("int")))


def start_due(jobs: DataFrame, plan: DataFrame, as_of: R.Instant, ttl_seconds: int) -> ChangeSet:
    """Lease the planned jobs: mark them RUNNING, open an attempt, emit job.started.

    ``plan`` names (job_id, worker_id); a job that is no longer due is rejected.
    """
    now = R.instant_like(as_of, jobs, "run_at")
    wanted = first_per(plan.select("job_id", "worker_id"), ["job_id"], ["worker_id"])
    due = jobs.filter(R.is_due(now)).select(F.col("job_id").alias("__id"), F.struct(*jobs.columns).alias("job"))
    decisions = wanted.join(due, F.col("job_id") == F.col("__id")).drop("__id").select(
        F.col("worker_id"), "job",
        (F.col("job.retry_count") + 1).cast("int").alias("attempt_number"), now.alias("now"),
    ).withColumn("attempt_id", R.derived_id("job.job_id", "attempt_number", F.lit("attempt"), "now"))
    rejects = plan.join(decisions.select(F.col("job.job_id").alias("job_id"), "worker_id"),
                        ["job_id", "worker_id"], "left_anti").withColumn("reason", F.lit("CONFLICT"))
    return ChangeSet(
        decisions,
        {
            "jobs": lambda d: revise(
                d, "job", status=F.lit(S.RUNNING), locked_by=F.col("worker_id"),
                locked_until=R.add_seconds(F.col("now"), ttl_seconds), updated_at=F.col("now"),
            ),
            "attempts": lambda d: d.select(
                "attempt_id", "job.job_id", "job.tenant_id", "worker_id", "attempt_number",
                F.lit(S.RUNNING).alias("status"), F.col("now").alias("started_at"),
                F.col("now").alias("created_at"),
            ),
            "events": lambda d: event_rows(
                d,
                [(F.lit("job.started"), None,
                  payload_text(worker_id=F.col("worker_id"), attempt_number=F.col("attempt_number")))],
                "worker", F.col("now"), F.col("job.job_id"), F.col("job.tenant_id"), F.col("attempt_id"),
            ),
        },
        rejects,
    )


def webhook_outcomes(outcomes: DataFrame) -> DataFrame:
    """Turn recorded responses (http_status, retry_after) into classified outcomes."""
    return outcomes.withColumn(
        "__result", R.http_outcome(F.col("http_status"), F.col("retry_after"))
    ).select(*outcomes.columns, "__result.*")


def execution_outcomes(reports: DataFrame) -> DataFrame:
    """Turn reports of executions into what ``finish`` takes.

    ``reports`` has outcome_id, job_id, attempt_id, worker_id, duration_ms, http_status, retry_after, body, and for executions that
    brought no whole response error_kind (see ``states.ERROR_KINDS``) and error_message. What is kept of the response is in ``result``.
    """
    kind = F.col("error_kind")
    outcome = R.execution_outcome(kind, F.col("http_status"), F.col("retry_after"), F.col("error_message"))
    result = F.when(kind.isNull(), R.attempt_result(F.col("http_status"), F.col("duration_ms"), F.col("body")))
    return reports.withColumns({"__outcome": outcome, "result": result}).select(
        "outcome_id", "job_id", "attempt_id", "worker_id", "duration_ms", "__outcome.*", "result")


def _open_attempts(attempts: DataFrame) -> DataFrame:
    """One open attempt per (job, worker): the newest, should a released claim have left an older one open."""
    running = attempts.filter(F.col("status") == S.RUNNING)
    newest = running.groupBy("job_id", "worker_id").agg(
        F.max_by("attempt_id", F.struct("started_at", "attempt_id")).alias("attempt_id")
    )
    return newest.select(F.col("job_id").alias("__job"), F.col("worker_id").alias("__worker"), "attempt_id")


def finish(jobs: DataFrame, attempts: DataFrame, outcomes: DataFrame, as_of: R.Instant,
           guard: bool = True) -> ChangeSet:
    """Settle reported outcomes: success, retry or dead letter.

    ``outcomes`` has outcome_id, job_id, worker_id, duration_ms, succeeded, error_code, retryable,
    message, retry_after_seconds, and may have attempt_id and result. A report counts only when its worker still owns the
    RUNNING job and the attempt it names is an open one of the job - without attempt_id, when the worker has an open attempt, the
    newest; the first such report per job wins. ``guard=False`` overrides by job id alone.
    """
    now = R.instant_like(as_of, jobs, "run_at")
    # An outcome that does not say it succeeded has failed.
    outcomes = outcomes.withColumn("succeeded", F.coalesce("succeeded", F.lit(False)))
    if guard:
        owned = jobs.filter((F.col("status") == S.RUNNING) & F.col("locked_by").isNotNull())
        keys = {"job_id": "job_id", "worker_id": "locked_by"}
        if "attempt_id" in outcomes.columns:
            # Reports of attempts that are not open are out before the first one per job is taken.
            opened = attempts.filter(F.col("status") == S.RUNNING).select(
                F.col("attempt_id").alias("__attempt"), F.col("job_id").alias("__job"))
            named = outcomes.join(opened, (F.col("attempt_id") == F.col("__attempt")) & (F.col("job_id") == F.col("__job")))
            applied, _ = guarded_join(named.drop("__attempt", "__job"), owned, keys, "outcome_id", base_alias="job")
        else:
            applied, _ = guarded_join(outcomes, owned, keys, "outcome_id", base_alias="job")
            opened = _open_attempts(attempts)
            applied = applied.join(
                opened, (F.col("job_id") == F.col("__job")) & (F.col("worker_id") == F.col("__worker"))
            ).drop("__job", "__worker")
    else:
        applied, _ = guarded_join(outcomes.drop("attempt_id"), jobs, {"job_id": "job_id"}, "outcome_id", base_alias="job")
        latest = attempts.filter(F.col("status") == S.RUNNING).groupBy("job_id").agg(
            F.max_by("attempt_id", F.struct("started_at", "attempt_id")).alias("attempt_id")
        )
        applied = applied.join(latest, "job_id", "left")
    rejects = outcomes.join(applied.select("outcome_id"), "outcome_id", "left_anti").withColumn(
        "reason", F.lit("CONFLICT")
    )
    numbers = {name: F.col(f"job.{name}") for name in ("retry_count", "max_retries", "retry_backoff_seconds")}
    decided = applied.drop("job_id").withColumns(numbers).withColumn("now", now).withColumn(
        "failure",
        F.when(~F.col("succeeded"), R.decide_failure(F.col("now"), F.col("retryable"), F.col("retry_after_seconds"))),
    ).drop(*numbers)
    return ChangeSet(
        decided,
        {"jobs": _finished_jobs, "attempts": lambda d: _finished_attempts(d, attempts),
         "dead_letters": _failed_dead_letters, "events": _finished_events},
        rejects,
    )


def complete(jobs: DataFrame, attempts: DataFrame, outcomes: DataFrame, as_of: R.Instant,
             guard: bool = True) -> ChangeSet:
    """Settle the successes of a batch."""
    return _only(finish(jobs, attempts, outcomes, as_of, guard), F.col("succeeded"))


def fail(jobs: DataFrame, attempts: DataFrame, outcomes: DataFrame, as_of: R.Instant,
         guard: bool = True) -> ChangeSet:
    """Settle the failures of a batch."""
    return _only(finish(jobs, attempts, outcomes, as_of, guard), ~F.col("succeeded"))


def _only(change: ChangeSet, which: Column) -> ChangeSet:
    return ChangeSet(change.decisions.filter(which), change.tables, change.rejects.filter(which))


def _finished_jobs(d: DataFrame) -> DataFrame:
    names = d.schema["job"].dataType.names
    before = {n: F.col(f"job.{n}") if n in names else F.lit(None).cast(kind)
              for n, kind in (("last_error", "string"), ("completed_at", d.schema["now"].dataType),
                              ("failed_at", d.schema["now"].dataType))}
    ok = F.col("succeeded")
    return revise(
        d, "job",
        status=F.when(ok, S.SUCCEEDED).otherwise(F.col("failure.status")),
        retry_count=F.when(ok, F.col("job.retry_count")).otherwise(F.col("failure.retry_count")),
        run_at=F.coalesce(F.col("failure.run_at"), F.col("job.run_at")),
        locked_by=F.lit(None).cast("string"),
        locked_until=F.lit(None).cast(d.schema["now"].dataType),
        last_error=F.when(ok, before["last_error"]).otherwise(F.col("message")),
        completed_at=F.when(ok, F.col("now")).otherwise(before["completed_at"]),
        failed_at=F.when(ok, before["failed_at"]).otherwise(F.col("now")),
        updated_at=F.col("now"),
    )


def _finished_attempts(d: DataFrame, attempts: DataFrame) -> DataFrame:
    ok = F.col("__change.succeeded")
    change = d.filter(F.col("attempt_id").isNotNull()).select(
        F.col("attempt_id").alias("__attempt"),
        F.struct("succeeded", "duration_ms", "message", "error_code", "retryable", "now").alias("__change"),
        (F.col("result") if "result" in d.columns else F.lit(None).cast("string")).alias("__result"),
    )
    rows = attempts.select(F.struct(*attempts.columns).alias("row")).join(
        change, F.col("row.attempt_id") == F.col("__attempt")
    )
    return revise(
        rows, "row",
        status=F.when(ok, S.SUCCEEDED).otherwise(S.FAILED),
        completed_at=F.when(ok, F.col("__change.now")),
        failed_at=F.when(~ok, F.col("__change.now")),
        error_message=F.col("__change.message"),
        error_code=F.col("__change.error_code"),
        retryable=F.col("__change.retryable"),
        execution_duration_ms=F.col("__change.duration_ms"),
        result=R.empty_to_null(F.col("__result")),
    )


def _dead_letter_rows(d: DataFrame, error: Column) -> DataFrame:
    payload = F.col("job.payload") if "payload" in d.schema["job"].dataType.names else F.lit(None).cast("string")
    return d.filter(F.col("failure.status") == S.DEAD_LETTERED).select(
        R.derived_id("job.job_id", "failure.retry_count", F.lit("dead-letter"), "now").alias("dead_letter_id"),
        F.col("job.job_id").alias("original_job_id"), "job.tenant_id", "job.name", "job.job_type",
        payload.alias("payload"), error.alias("final_error"),
        F.col("failure.retry_count").alias("retry_count"), F.col("now").alias("failed_at"),
        F.col("now").alias("created_at"),
        F.lit(None).cast(d.schema["now"].dataType).alias("requeued_at"),
        F.lit(None).cast("string").alias("requeued_job_id"),
    )


def _failed_dead_letters(d: DataFrame) -> DataFrame:
    return _dead_letter_rows(d.filter(~F.col("succeeded")), F.col("message"))


def _finished_events(d: DataFrame) -> DataFrame:
    ok = F.col("succeeded")
    dead = F.col("failure.status") == S.DEAD_LETTERED
    number = F.col("job.retry_count") + 1
    return event_rows(
        d,
        [
            (F.lit("job.completed"), ok,
             payload_text(worker_id=F.col("worker_id"), execution_duration_ms=F.col("duration_ms"))),
            (F.lit("job.failed"), ~ok,
             payload_text(worker_id=F.col("worker_id"), attempt_number=number, error=F.col("message"),
                          error_code=F.col("error_code"), retryable=F.col("retryable"))),
            (F.lit("job.dead_lettered"), ~ok & dead,
             payload_text(retry_count=F.col("failure.retry_count"), final_error=F.col("message"))),
            (F.lit("job.retry_scheduled"), ~ok & ~dead,
             payload_text(retry_count=F.col("failure.retry_count"), next_run_at=F.col("failure.run_at"))),
        ],
        "worker", F.col("now"), F.col("job.job_id"), F.col("job.tenant_id"), number,
    )


def recover_expired(jobs: DataFrame, attempts: DataFrame, as_of: R.Instant, reason: str) -> ChangeSet:
    """Fail the open attempts of jobs whose lease ran out, then retry or dead-letter the jobs."""
    now = R.instant_like(as_of, jobs, "run_at")
    expired = jobs.filter(R.is_expired(now))
    decisions = expired.select(
        F.struct(*jobs.columns).alias("job"), now.alias("now"), R.decide_failure(now).alias("failure"),
        F.lit(reason).alias("reason"),
    )
    dead = F.col("failure.status") == S.DEAD_LETTERED
    count = F.col("failure.retry_count")

    def failed_attempts(d: DataFrame) -> DataFrame:
        lost = d.select(F.col("job.job_id").alias("__job"), "now", "reason")
        open_ones = attempts.filter(F.col("status") == S.RUNNING)
        rows = open_ones.select(F.struct(*attempts.columns).alias("row")).join(
            lost, F.col("row.job_id") == F.col("__job")
        )
        return revise(
            rows, "row", status=F.lit(S.FAILED), failed_at=F.col("now"), error_message=F.col("reason"),
            error_code=F.lit("LEASE_EXPIRED"), retryable=F.lit(True),
        )

    return ChangeSet(
        decisions,
        {
            "jobs": lambda d: revise(
                d, "job", status=F.col("failure.status"), retry_count=count,
                run_at=F.coalesce(F.col("failure.run_at"), F.col("job.run_at")),
                locked_by=F.lit(None).cast("string"),
                locked_until=F.lit(None).cast(d.schema["now"].dataType),
                last_error=F.col("reason"), failed_at=F.col("now"), updated_at=F.col("now"),
            ),
            "attempts": failed_attempts,
            "dead_letters": lambda d: _dead_letter_rows(d, F.col("reason")),
            "events": lambda d: event_rows(
                d,
                [
                    (F.lit("job.dead_lettered"), dead, payload_text(reason=F.col("reason"), retry_count=count)),
                    (F.lit("job.retry_scheduled"), ~dead,
                     payload_text(reason=F.col("reason"), retry_count=count, next_run_at=F.col("failure.run_at"))),
                ],
                "recovery", F.col("now"), F.col("job.job_id"), F.col("job.tenant_id"), count,
            ),
        },
    )


def extend_leases(jobs: DataFrame, renewals: DataFrame, ttl_seconds: int) -> ChangeSet:
    """Push the lease end to the last renewal plus the TTL, never back; only the owner of a RUNNING job may.

    ``renewals`` has renewal_id, job_id, worker_id, ts.
    """
    last = renewals.groupBy("job_id", "worker_id").agg(F.max("ts").alias("ts"))
    owned = jobs.filter((F.col("status") == S.RUNNING) & F.col("locked_by").isNotNull()).select(
        F.struct(*jobs.columns).alias("job")
    )
    decisions = last.join(
        owned, (F.col("job_id") == F.col("job.job_id")) & (F.col("worker_id") == F.col("job.locked_by"))
    ).drop("job_id")
    rejects = renewals.join(
        decisions.select(F.col("job.job_id").alias("job_id"), "worker_id"), ["job_id", "worker_id"], "left_anti"
    ).withColumn("reason", F.lit("CONFLICT"))
    return ChangeSet(
        decisions,
        {"jobs": lambda d: revise(d, "job", locked_until=F.greatest("job.locked_until", R.add_seconds(F.col("ts"), ttl_seconds)),
                                  updated_at=F.greatest("job.updated_at", "ts") if "updated_at" in jobs.columns else F.col("ts"))},
        rejects,
    )


def release(jobs: DataFrame, releases: DataFrame, as_of: R.Instant,
            status: str = S.RETRY_SCHEDULED) -> ChangeSet:
    """Give claims back: the job returns to ``status`` without an owner; its attempt stays open.

    ``releases`` has release_id, job_id, worker_id.
    """
    if status not in S.CLAIMABLE:
        raise ValueError(f"{status} is not a claimable status")
    now = R.instant_like(as_of, jobs, "run_at")
    owned = jobs.filter((F.col("status") == S.RUNNING) & F.col("locked_by").isNotNull())
    applied, rejects = guarded_join(
        releases, owned, {"job_id": "job_id", "worker_id": "locked_by"}, "release_id", base_alias="job"
    )
    decisions = applied.select("job", now.alias("now"))
    return ChangeSet(
        decisions,
        {"jobs": lambda d: revise(
            d, "job", status=F.lit(status), locked_by=F.lit(None).cast("string"),
            locked_until=F.lit(None).cast(d.schema["now"].dataType), updated_at=F.col("now"))},
        rejects,
    )
