"""Queries about jobs: due work, execution, recovery, commands, submission, dead letters."""

from __future__ import annotations

from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.operators import changes, commands, deadletters, execution, listing, maintained, pages, reports, submit
from worktide.plans.registry import JOBS_NOW, query
from worktide.plans.views import JOBS_AS_OF
from worktide.session import scratch_path

NOW = JOBS_AS_OF
REASON = "worker lease expired before completion"
TTL = 360
WORKERS = [f"worker-{i}" for i in range(5)]
SIZE = 10

_DELAY = "(CASE WHEN retry_backoff_seconds <= 0 THEN 30 ELSE retry_backoff_seconds END) * pow(2, retry_count)"
_JOB_TAIL = "created_at, CAST(retry_count AS BIGINT) AS retry_count, max_retries, retry_backoff_seconds, timeout_seconds"
_UNLOCKED = "CAST(NULL AS VARCHAR) AS locked_by, CAST(NULL AS TIMESTAMP) AS locked_until"


def _after(seconds: str) -> str:
    return f"{JOBS_NOW} + INTERVAL '1' SECOND * CAST({seconds} AS INT)"


# --- counts and lists ---------------------------------------------------------------------


@query("status_counts", "SELECT tenant_id, status, count(*) AS jobs FROM v_jobs GROUP BY tenant_id, status", ("v_jobs",))
def _(v):
    return reports.status_counts(v.jobs)


@query("status_rollup", "SELECT tenant_id, status, count(*) AS jobs FROM v_jobs GROUP BY ROLLUP (tenant_id, status)", ("v_jobs",))
def _(v):
    return reports.status_rollup(v.jobs)


_LISTED = """FROM v_jobs WHERE tenant_id = 3 AND job_type = 'CALL_WEBHOOK'
  AND created_at >= TIMESTAMP '1993-01-01 00:00:00' AND created_at <= TIMESTAMP '1998-01-01 00:00:00'"""


def _filter(**more):
    return listing.JobFilter(tenant_id=3, job_type="CALL_WEBHOOK", created_after="1993-01-01 00:00:00",
                             created_before="1998-01-01 00:00:00", **more)


@query("list_jobs_page", f"SELECT * {_LISTED} ORDER BY run_at DESC, job_id DESC LIMIT 10 OFFSET 10", ("v_jobs",))
def _(v):
    return listing.list_jobs(v.jobs, _filter(sort="run_at", page=2, size=10))


@query("list_jobs_far_page", """
SELECT job_id, priority, run_at, status FROM v_jobs ORDER BY run_at DESC, job_id DESC LIMIT 100 OFFSET 400""", ("v_jobs",))
def _(v):
    """A page through the directory of the sorted table."""
    kept = v.jobs.select("job_id", "priority", "run_at", "status")
    directory = pages.build_directory(kept, [("run_at", False), ("job_id", False)], scratch_path(v._spark, "pages"), ranges=16)
    return directory.page(5, 100)


@query("list_jobs_by_priority", f"SELECT * {_LISTED} AND status = 'RUNNING' ORDER BY priority, job_id LIMIT 20", ("v_jobs",))
def _(v):
    return listing.list_jobs(v.jobs, _filter(sort="priority", order="asc", status="RUNNING"))


@query("list_jobs_total", f"SELECT count(*) AS total {_LISTED}", ("v_jobs",))
def _(v):
    return listing.list_jobs_total(v.jobs, _filter())


@query("list_jobs_after", f"""SELECT * {_LISTED} AND (created_at, job_id) < (TIMESTAMP '1996-01-01 00:00:00', 0)
ORDER BY created_at DESC, job_id DESC LIMIT 20""", ("v_jobs",))
def _(v):
    return listing.list_jobs_after(v.jobs, _filter(), "1996-01-01 00:00:00", 0)


# --- due work -----------------------------------------------------------------------------

_DUE = f"""status IN ('PENDING', 'SCHEDULED', 'RETRY_SCHEDULED') AND run_at <= {JOBS_NOW}
  AND (locked_until IS NULL OR locked_until < {JOBS_NOW})"""
_DUE_ORDER = "priority DESC, run_at, created_at, job_id"


@query("due_top_k", f"SELECT * FROM v_jobs WHERE {_DUE} ORDER BY {_DUE_ORDER} LIMIT 100", ("v_jobs",))
def _(v):
    return execution.due_top_k(v.jobs, NOW, 100)


_PLAN = f"""plan AS (
  SELECT *, CAST(floor((position - 1) / {SIZE}.0) AS INT) AS batch FROM (
    SELECT job_id, priority, run_at, created_at,
           CAST(row_number() OVER (ORDER BY {_DUE_ORDER}) AS INT) AS position
    FROM v_jobs WHERE {_DUE}) ranked
  WHERE position <= {SIZE * len(WORKERS)})"""


def _plan(v):
    return execution.batch_plan(v.jobs, NOW, WORKERS, SIZE)


@query("batch_plan", "SELECT *, concat('worker-', batch) AS worker_id FROM plan", ("v_jobs",), _PLAN)
def _(v):
    return _plan(v)


@query("start_due_jobs", f"""
SELECT j.job_id, tenant_id, name, job_type, 'RUNNING' AS status, j.priority, j.run_at, j.created_at, retry_count,
       max_retries, retry_backoff_seconds, timeout_seconds, concat('worker-', batch) AS locked_by,
       {_after(str(TTL))} AS locked_until, {JOBS_NOW} AS updated_at
FROM v_jobs j JOIN plan p ON j.job_id = p.job_id""", ("v_jobs",), _PLAN)
def _(v):
    return execution.start_due(v.jobs, _plan(v), NOW, TTL).jobs


@query("start_due_attempts", f"""
SELECT j.job_id, tenant_id, concat('worker-', batch) AS worker_id, CAST(retry_count + 1 AS INT) AS attempt_number,
       'RUNNING' AS status, {JOBS_NOW} AS started_at
FROM v_jobs j JOIN plan p ON j.job_id = p.job_id""", ("v_jobs",), _PLAN)
def _(v):
    return execution.start_due(v.jobs, _plan(v), NOW, TTL).attempts.drop("attempt_id", "created_at")


@query("start_due_events", f"""
SELECT j.job_id, tenant_id, 'job.started' AS event_type, 'worker' AS source, {JOBS_NOW} AS created_at,
       concat('{{"worker_id":"worker-', batch, '","attempt_number":', retry_count + 1, '}}') AS payload
FROM v_jobs j JOIN plan p ON j.job_id = p.job_id""", ("v_jobs",), _PLAN)
def _(v):
    return _told(execution.start_due(v.jobs, _plan(v), NOW, TTL).events, "payload")


def _told(events, *more):
    return events.select("job_id", "tenant_id", "event_type", "source", "created_at", *more)


# --- failure rules and recovery -----------------------------------------------------------


@query("expired_leases", f"""SELECT job_id, locked_by, locked_until FROM v_jobs
WHERE status = 'RUNNING' AND locked_until < {JOBS_NOW}""", ("v_jobs",))
def _(v):
    return v.jobs.filter(R.is_expired(R.instant(NOW))).select("job_id", "locked_by", "locked_until")


@query("failure_decision", f"""
SELECT job_id, CASE WHEN retry_count + 1 > max_retries THEN 'DEAD_LETTERED' ELSE 'RETRY_SCHEDULED' END AS status,
       retry_count + 1 AS retry_count,
       CASE WHEN retry_count + 1 <= max_retries THEN {_after(_DELAY)} END AS run_at
FROM v_jobs""", ("v_jobs",))
def _(v):
    return v.jobs.select("job_id", R.decide_failure(R.instant(NOW)).alias("d")).select("job_id", "d.*")


@query("backoff", """
SELECT job_id, CAST(least((CASE WHEN retry_backoff_seconds <= 0 THEN 30 ELSE retry_backoff_seconds END)
         * pow(2.0, greatest(job_id % 70, 1) - 1), 9223372036.0) AS BIGINT) AS delay_seconds,
       retry_count >= max_retries AS budget_spent
FROM v_jobs""", ("v_jobs",))
def _(v):
    return v.jobs.select(
        "job_id", R.backoff_seconds(F.col("retry_backoff_seconds"), F.col("job_id") % 70).alias("delay_seconds"),
        R.budget_spent(F.col("retry_count"), F.col("max_retries")).alias("budget_spent"),
    )


_LOST = f"""lost AS (
  SELECT *, retry_count + 1 > max_retries AS dead FROM v_jobs
  WHERE status = 'RUNNING' AND locked_until < {JOBS_NOW})"""


def _recovered(v):
    return execution.recover_expired(v.jobs, v.open_attempts, NOW, REASON)


@query("recover_expired_jobs", f"""
SELECT job_id, tenant_id, name, job_type, CASE WHEN dead THEN 'DEAD_LETTERED' ELSE 'RETRY_SCHEDULED' END AS status,
       priority, CASE WHEN dead THEN run_at ELSE {_after(_DELAY)} END AS run_at, created_at,
       retry_count + 1 AS retry_count, max_retries, retry_backoff_seconds, timeout_seconds, {_UNLOCKED},
       '{REASON}' AS last_error, {JOBS_NOW} AS failed_at, {JOBS_NOW} AS updated_at
FROM lost""", ("v_jobs",), _LOST)
def _(v):
    return _recovered(v).jobs


@query("recover_expired_attempts", f"""
SELECT a.attempt_id, a.job_id, a.tenant_id, a.worker_id, a.attempt_number, 'FAILED' AS status, a.started_at,
       {JOBS_NOW} AS failed_at, '{REASON}' AS error_message, 'LEASE_EXPIRED' AS error_code, true AS retryable
FROM v_open_attempts a JOIN lost l ON a.job_id = l.job_id""", ("v_jobs", "v_open_attempts"), _LOST)
def _(v):
    return _recovered(v).attempts


@query("recover_expired_dead_letters", f"""
SELECT job_id AS original_job_id, tenant_id, name, job_type, '{REASON}' AS final_error, retry_count + 1 AS retry_count,
       {JOBS_NOW} AS failed_at
FROM lost WHERE dead""", ("v_jobs",), _LOST)
def _(v):
    return _recovered(v).dead_letters.select(*_LETTER)


_LETTER = ("original_job_id", "tenant_id", "name", "job_type", "final_error", "retry_count", "failed_at")


@query("recover_expired_events", f"""
SELECT job_id, tenant_id, CASE WHEN dead THEN 'job.dead_lettered' ELSE 'job.retry_scheduled' END AS event_type,
       'recovery' AS source, {JOBS_NOW} AS created_at
FROM lost""", ("v_jobs",), _LOST)
def _(v):
    return _told(_recovered(v).events)


# --- outcomes -----------------------------------------------------------------------------

_JUDGED = """judged AS (
  SELECT *, http_status BETWEEN 200 AND 299 AS ok,
         http_status IN (408, 429) OR http_status >= 500 AS again,
         greatest(0, least(900, coalesce(TRY_CAST(trim(retry_after) AS INT), 0))) AS wait_s
  FROM v_outcomes),
settled AS (
  SELECT j.*, o.ok, o.again, o.wait_s, o.http_status, o.worker_id, o.duration_ms,
         NOT o.ok AND (NOT o.again OR j.retry_count + 1 > j.max_retries) AS dead,
         concat('webhook returned HTTP ', o.http_status) AS message
  FROM judged o JOIN v_jobs j ON o.job_id = j.job_id AND o.worker_id = j.locked_by AND j.status = 'RUNNING')"""
_OUTCOMES = ("v_jobs", "v_outcomes")


def _outcomes(v):
    return execution.webhook_outcomes(v.outcomes.withColumn("outcome_id", F.col("job_id")))


def _finished(v, guard=True):
    return execution.finish(v.jobs, v.open_attempts, _outcomes(v), NOW, guard)


@query("complete_jobs", f"""
SELECT job_id, tenant_id, name, job_type, 'SUCCEEDED' AS status, priority, run_at, {_JOB_TAIL}, {_UNLOCKED},
       {JOBS_NOW} AS completed_at, {JOBS_NOW} AS updated_at
FROM settled WHERE ok""", _OUTCOMES, _JUDGED)
def _(v):
    return execution.complete(v.jobs, v.open_attempts, _outcomes(v), NOW).jobs.drop("last_error", "failed_at")


@query("fail_jobs", f"""
SELECT job_id, tenant_id, name, job_type, CASE WHEN dead THEN 'DEAD_LETTERED' ELSE 'RETRY_SCHEDULED' END AS status,
       priority, CASE WHEN dead THEN run_at WHEN wait_s > 0 THEN {_after("wait_s")} ELSE {_after(_DELAY)} END AS run_at,
       created_at, retry_count + 1 AS retry_count, max_retries, retry_backoff_seconds, timeout_seconds, {_UNLOCKED},
       message AS last_error, {JOBS_NOW} AS failed_at, {JOBS_NOW} AS updated_at
FROM settled WHERE NOT ok""", _OUTCOMES, _JUDGED)
def _(v):
    return execution.fail(v.jobs, v.open_attempts, _outcomes(v), NOW).jobs.drop("completed_at")


@query("fail_dead_letters", f"""
SELECT job_id AS original_job_id, tenant_id, name, job_type, message AS final_error, retry_count + 1 AS retry_count,
       {JOBS_NOW} AS failed_at
FROM settled WHERE dead""", _OUTCOMES, _JUDGED)
def _(v):
    return execution.fail(v.jobs, v.open_attempts, _outcomes(v), NOW).dead_letters.select(*_LETTER)


@query("finish_attempts", f"""
SELECT job_id AS attempt_id, job_id, tenant_id, worker_id, CAST(retry_count + 1 AS INT) AS attempt_number,
       CASE WHEN ok THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, run_at AS started_at,
       CASE WHEN ok THEN {JOBS_NOW} END AS completed_at, CASE WHEN NOT ok THEN {JOBS_NOW} END AS failed_at,
       CASE WHEN NOT ok THEN message END AS error_message,
       CASE WHEN NOT ok THEN 'WEBHOOK_HTTP_ERROR' END AS error_code, CASE WHEN NOT ok THEN again END AS retryable,
       duration_ms AS execution_duration_ms
FROM settled""", _OUTCOMES, _JUDGED)
def _(v):
    return _finished(v).attempts.drop("result")


@query("finish_events", f"""
SELECT job_id, tenant_id, 'job.completed' AS event_type, 'worker' AS source, {JOBS_NOW} AS created_at FROM settled WHERE ok
UNION ALL
SELECT job_id, tenant_id, 'job.failed', 'worker', {JOBS_NOW} FROM settled WHERE NOT ok
UNION ALL
SELECT job_id, tenant_id, CASE WHEN dead THEN 'job.dead_lettered' ELSE 'job.retry_scheduled' END, 'worker', {JOBS_NOW}
FROM settled WHERE NOT ok""", _OUTCOMES, _JUDGED)
def _(v):
    return _told(_finished(v).events)


@query("outcome_rejects", """
SELECT o.job_id, o.worker_id, o.http_status, 'CONFLICT' AS reason
FROM v_outcomes o WHERE NOT EXISTS (SELECT 1 FROM settled s WHERE s.job_id = o.job_id)""", _OUTCOMES, _JUDGED)
def _(v):
    return _finished(v).rejects.select("job_id", "worker_id", "http_status", "reason")


# Reports that name their attempt, with what is kept of the response.
_REPORTED = f"""valid AS (
  SELECT j.*, r.outcome_id, r.attempt_id, r.duration_ms, r.http_status, r.error_kind, r.error_message, r.body, a.attempt_number, a.started_at,
         a.worker_id, trim(r.retry_after) AS header, row_number() OVER (PARTITION BY j.job_id ORDER BY r.outcome_id) AS turn
  FROM v_reports r JOIN v_jobs j ON r.job_id = j.job_id AND r.worker_id = j.locked_by AND j.status = 'RUNNING'
  JOIN v_all_open_attempts a ON r.attempt_id = a.attempt_id AND r.job_id = a.job_id),
named AS (
  SELECT *, error_kind IS NULL AND http_status IS NOT NULL AND http_status BETWEEN 200 AND 299 AS ok,
    CASE WHEN error_kind IS NOT NULL THEN error_message WHEN http_status IS NULL THEN 'webhook gave no response'
         WHEN http_status NOT BETWEEN 200 AND 299 THEN concat('webhook returned HTTP ', http_status) END AS message,
    CASE WHEN error_kind = 'timeout' THEN 'TIMEOUT' WHEN error_kind = 'cancelled' THEN 'CANCELLED' WHEN error_kind = 'build' THEN 'REQUEST_BUILD_FAILED'
         WHEN error_kind = 'read' THEN 'WEBHOOK_READ_ERROR' WHEN error_kind IS NOT NULL THEN 'HANDLER_ERROR'
         WHEN http_status IS NULL THEN 'WEBHOOK_NETWORK_ERROR' WHEN http_status NOT BETWEEN 200 AND 299 THEN 'WEBHOOK_HTTP_ERROR' END AS error_code,
    CASE WHEN error_kind IS NOT NULL THEN error_kind <> 'build' WHEN http_status IS NULL THEN true
         WHEN http_status NOT BETWEEN 200 AND 299 THEN http_status IN (408, 429) OR http_status >= 500 END AS retryable,
    CASE WHEN error_kind IS NULL THEN greatest(0, least(900, coalesce(TRY_CAST(header AS INT), 0))) ELSE 0 END AS wait_s,
    CASE WHEN error_kind IS NULL AND http_status IS NOT NULL THEN concat('{{"duration_ms":', duration_ms, ',"response_excerpt":',
      to_json(left(coalesce(body, ''), 4096)), ',"response_truncated":', length(coalesce(body, '')) > 4096, ',"status_code":', http_status, '}}') END AS result
  FROM valid WHERE turn = 1),
finished AS (SELECT *, NOT ok AND (NOT retryable OR retry_count + 1 > max_retries) AS dead FROM named)"""
_REPORTS = ("v_jobs", "v_reports", "v_all_open_attempts")


def _settled(v):
    return execution.finish(v.jobs, v.all_open_attempts, execution.execution_outcomes(v.reports), NOW)


@query("settle_jobs", f"""
SELECT job_id, tenant_id, name, job_type, CASE WHEN ok THEN 'SUCCEEDED' WHEN dead THEN 'DEAD_LETTERED' ELSE 'RETRY_SCHEDULED' END AS status,
       priority, CASE WHEN ok OR dead THEN run_at WHEN wait_s > 0 THEN {_after("wait_s")} ELSE {_after(_DELAY)} END AS run_at,
       created_at, CAST(CASE WHEN ok THEN retry_count ELSE retry_count + 1 END AS BIGINT) AS retry_count, max_retries, retry_backoff_seconds,
       timeout_seconds, {_UNLOCKED}, CASE WHEN NOT ok THEN message END AS last_error, CASE WHEN ok THEN {JOBS_NOW} END AS completed_at,
       CASE WHEN NOT ok THEN {JOBS_NOW} END AS failed_at, {JOBS_NOW} AS updated_at
FROM finished""", _REPORTS, _REPORTED)
def _(v):
    """Jobs after the reports that name their attempt, all columns."""
    return _settled(v).jobs


@query("settle_attempts", f"""
SELECT attempt_id, job_id, tenant_id, worker_id, attempt_number, CASE WHEN ok THEN 'SUCCEEDED' ELSE 'FAILED' END AS status, started_at,
       CASE WHEN ok THEN {JOBS_NOW} END AS completed_at, CASE WHEN NOT ok THEN {JOBS_NOW} END AS failed_at,
       CASE WHEN NOT ok THEN message END AS error_message, error_code, CASE WHEN NOT ok THEN retryable END AS retryable,
       duration_ms AS execution_duration_ms, result
FROM finished""", _REPORTS, _REPORTED)
def _(v):
    """The attempts settled, with what is kept of the response."""
    return _settled(v).attempts


@query("settle_dead_letters", f"""
SELECT job_id AS original_job_id, tenant_id, name, job_type, message AS final_error, CAST(retry_count + 1 AS BIGINT) AS retry_count,
       {JOBS_NOW} AS failed_at FROM finished WHERE dead""", _REPORTS, _REPORTED)
def _(v):
    return _settled(v).dead_letters.select(*_LETTER).withColumn("retry_count", F.col("retry_count").cast("long"))


@query("settle_rejects", """
SELECT r.outcome_id, r.job_id, r.attempt_id, r.worker_id, 'CONFLICT' AS reason
FROM v_reports r WHERE r.outcome_id NOT IN (SELECT outcome_id FROM finished)""", _REPORTS, _REPORTED)
def _(v):
    """Reports that came late, twice, or from a worker that does not own the job."""
    return _settled(v).rejects.select("outcome_id", "job_id", "attempt_id", "worker_id", "reason")


@query("maintained_counts", f"""
, after AS (SELECT j.tenant_id, j.locked_until, j.retry_count, j.max_retries, f.job_id IS NULL AS untouched,
       CASE WHEN f.job_id IS NULL THEN j.status WHEN f.ok THEN 'SUCCEEDED' WHEN f.dead THEN 'DEAD_LETTERED' ELSE 'RETRY_SCHEDULED' END AS status
  FROM v_jobs j LEFT JOIN finished f ON j.job_id = f.job_id)
SELECT tenant_id, CASE WHEN untouched AND status = 'RUNNING' AND locked_until < {JOBS_NOW}
         THEN CASE WHEN retry_count + 1 > max_retries THEN 'DEAD_LETTERED' ELSE 'RETRY_SCHEDULED' END ELSE status END AS status, count(*) AS jobs
FROM after GROUP BY 1, 2""", _REPORTS, _REPORTED)
def _(v):
    """Jobs per tenant and status, counted once and then kept up by the changes of reports and of recovery."""
    counts = maintained.STATUS_COUNTS.full(v.jobs)
    settled = _settled(v).materialize()
    after = changes.apply_changes(v.jobs, settled.jobs, "job_id")
    recovered = execution.recover_expired(after, v.all_open_attempts, NOW, REASON)
    for change in (settled, recovered):
        counts = maintained.STATUS_COUNTS.follow(counts, change)
    return counts


@query("batch_plan_all", f"""
SELECT job_id, priority, run_at, created_at, position, (position - 1) // {SIZE} AS batch, concat('worker-', ((position - 1) // {SIZE}) % {len(WORKERS)}) AS worker_id
FROM (SELECT *, row_number() OVER (ORDER BY priority DESC, run_at, created_at, job_id) AS position FROM v_jobs
      WHERE status IN ('PENDING', 'SCHEDULED', 'RETRY_SCHEDULED') AND run_at <= {JOBS_NOW} AND (locked_until IS NULL OR locked_until < {JOBS_NOW})) d""", ("v_jobs",))
def _(v):
    """All due jobs in batches."""
    return execution.batch_plan_all(v.jobs, NOW, WORKERS, SIZE)


@query("compat_updates", f"""
SELECT j.job_id, CASE WHEN o.ok THEN 'SUCCEEDED' WHEN NOT o.again OR j.retry_count + 1 > j.max_retries THEN 'DEAD_LETTERED'
            ELSE 'RETRY_SCHEDULED' END AS status,
       CASE WHEN o.ok THEN j.retry_count ELSE j.retry_count + 1 END AS retry_count, {_UNLOCKED}
FROM judged o JOIN v_jobs j ON o.job_id = j.job_id""", _OUTCOMES, _JUDGED)
def _(v):
    return _finished(v, guard=False).jobs.select("job_id", "status", "retry_count", "locked_by", "locked_until")


@query("finish_snapshot", """
SELECT status, count(*) AS jobs FROM (
  SELECT j.job_id, CASE WHEN s.job_id IS NULL THEN j.status WHEN s.ok THEN 'SUCCEEDED' WHEN s.dead THEN 'DEAD_LETTERED'
              ELSE 'RETRY_SCHEDULED' END AS status
  FROM v_jobs j LEFT JOIN settled s ON j.job_id = s.job_id) after
GROUP BY status""", _OUTCOMES, _JUDGED)
def _(v):
    after = changes.apply_changes(v.jobs, _finished(v).jobs, "job_id")
    return after.groupBy("status").agg(F.count(F.lit(1)).alias("jobs"))


@query("http_outcome", """
SELECT attempt_id, http_status BETWEEN 200 AND 299 AS succeeded,
       CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN http_status IN (408, 429) OR http_status >= 500 END AS retryable,
       CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN 'WEBHOOK_HTTP_ERROR' END AS error_code,
       CASE WHEN http_status NOT BETWEEN 200 AND 299 THEN concat('webhook returned HTTP ', http_status) END AS message
FROM v_attempts""", ("v_attempts",))
def _(v):
    outcome = R.http_outcome(F.col("http_status"), F.lit(None).cast("string"))
    return v.attempts.select("attempt_id", outcome.alias("o")).select(
        "attempt_id", "o.succeeded", "o.retryable", "o.error_code", "o.message"
    )


# --- leases -------------------------------------------------------------------------------


@query("release_jobs", f"""
SELECT j.job_id, 'RETRY_SCHEDULED' AS status, {_UNLOCKED}, {JOBS_NOW} AS updated_at
FROM v_outcomes o JOIN v_jobs j ON o.job_id = j.job_id AND o.worker_id = j.locked_by AND j.status = 'RUNNING'""", _OUTCOMES)
def _(v):
    releases = v.outcomes.select(F.col("job_id").alias("release_id"), "job_id", "worker_id")
    return execution.release(v.jobs, releases, NOW).jobs.select("job_id", "status", "locked_by", "locked_until", "updated_at")


_RENEWED = f"""renewed AS (
  SELECT job_id, worker_id, {JOBS_NOW} + INTERVAL '1' SECOND * CAST(duration_ms AS INT) AS ts FROM v_outcomes
  UNION ALL
  SELECT job_id, worker_id, {JOBS_NOW} + INTERVAL '1' SECOND * CAST(1000 - duration_ms AS INT) FROM v_outcomes)"""


def _renewals(v):
    base = v.outcomes.select("job_id", "worker_id", F.explode(F.array(
        F.col("duration_ms"), 1000 - F.col("duration_ms"))).alias("s"))
    return base.select("job_id", "worker_id", R.add_seconds(R.instant(NOW), F.col("s")).alias("ts"))


@query("extend_leases", f"""
SELECT j.job_id, j.locked_by, greatest(any_value(j.locked_until), max(r.ts) + INTERVAL '1' SECOND * {TTL}) AS locked_until
FROM renewed r JOIN v_jobs j ON r.job_id = j.job_id AND r.worker_id = j.locked_by AND j.status = 'RUNNING'
GROUP BY j.job_id, j.locked_by""", _OUTCOMES, _RENEWED)
def _(v):
    return execution.extend_leases(v.jobs, _renewals(v), TTL).jobs.select("job_id", "locked_by", "locked_until")


# --- commands -----------------------------------------------------------------------------

_ALLOWED = """(command = 'cancel' AND status IN ('PENDING', 'SCHEDULED', 'RETRY_SCHEDULED', 'RUNNING'))
  OR (command = 'pause' AND status IN ('PENDING', 'SCHEDULED')) OR (command = 'resume' AND status = 'PAUSED')
  OR (command = 'retry' AND status = 'FAILED')"""
_TARGET = """CASE command WHEN 'cancel' THEN 'CANCELLED' WHEN 'pause' THEN 'PAUSED' WHEN 'resume' THEN 'SCHEDULED'
  WHEN 'retry' THEN 'RETRY_SCHEDULED' END"""
_COMMANDED = f"""commanded AS (
  SELECT c.command_id, c.command, c.issued_at, j.*, {_TARGET} AS target, coalesce({_ALLOWED}, false) AS ok
  FROM v_commands c LEFT JOIN v_jobs j ON c.job_id = j.job_id)"""


def _commanded(v, single=True):
    return commands.apply_commands(v.jobs, v.open_attempts, v.commands, NOW, single=single)


@query("apply_commands", f"""
SELECT job_id, tenant_id, name, job_type, target AS status, priority, run_at, {_JOB_TAIL}, {_UNLOCKED},
       CASE WHEN target = 'CANCELLED' THEN {JOBS_NOW} END AS cancelled_at, {JOBS_NOW} AS updated_at
FROM commanded WHERE ok""", ("v_jobs", "v_commands"), _COMMANDED)
def _(v):
    return _commanded(v).jobs


@query("command_attempts", f"""
SELECT a.attempt_id, 'CANCELLED' AS status, {JOBS_NOW} AS failed_at, 'cancelled by operator' AS error_message,
       'CANCELLED' AS error_code, false AS retryable
FROM v_open_attempts a JOIN commanded c ON a.job_id = c.job_id AND c.ok AND c.target = 'CANCELLED'""",
       ("v_jobs", "v_commands", "v_open_attempts"), _COMMANDED)
def _(v):
    return _commanded(v).attempts.select("attempt_id", "status", "failed_at", "error_message", "error_code", "retryable")


@query("command_events", f"""
SELECT job_id, tenant_id, concat('job.', lower(target)) AS event_type, 'scheduler-api' AS source, {JOBS_NOW} AS created_at,
       concat('{{"status":"', target, '"}}') AS payload
FROM commanded WHERE ok""", ("v_jobs", "v_commands"), _COMMANDED)
def _(v):
    return _told(_commanded(v).events, "payload")


@query("command_rejects", """
SELECT command_id, command, CASE WHEN status IS NULL THEN 'NOT_FOUND'
       ELSE concat('cannot transition ', status, ' to ', target) END AS reason
FROM commanded WHERE NOT ok""", ("v_jobs", "v_commands"), _COMMANDED)
def _(v):
    return _commanded(v).rejects.select("command_id", "command", "reason")


_SERIES = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY issued_at, command_id) AS n FROM v_command_series),
walked AS (
  SELECT c.command_id, c.job_id, c.command, c.n, j.status AS status, {_TARGET} AS target,
         coalesce({_ALLOWED}, false) AS ok
  FROM numbered c LEFT JOIN v_jobs j ON c.job_id = j.job_id WHERE n = 1
  UNION ALL
  SELECT command_id, job_id, command, n, status, {_TARGET} AS target, coalesce({_ALLOWED}, false) AS ok
  FROM (SELECT c.command_id, c.job_id, c.command, c.n, CASE WHEN w.ok THEN w.target ELSE w.status END AS status
        FROM walked w JOIN numbered c ON c.job_id = w.job_id AND c.n = w.n + 1) stepped)"""


@query("command_series", """
SELECT command_id, job_id, command, status AS status_before, CASE WHEN ok THEN target END AS status_after FROM walked""",
       ("v_jobs", "v_command_series"), _SERIES)
def _(v):
    judged = commands.judge_commands(v.jobs, v.command_series)
    return judged.select("command_id", "job_id", "command", "status_before", "status_after")


# --- submission ---------------------------------------------------------------------------

_SUBMITTED = """filled AS (
  SELECT seq, tenant_id, nullif(trim(idempotency_key), '') AS idempotency_key, name, job_type, payload, run_at,
         CASE WHEN priority = 0 THEN 5 ELSE priority END AS priority,
         CASE WHEN max_retries = 0 THEN 3 ELSE max_retries END AS max_retries
  FROM v_submissions),
checked AS (
  SELECT *, CASE WHEN strlen(idempotency_key) > 255 THEN 'Idempotency-Key exceeds 255 characters'
                 WHEN trim(name) = '' THEN 'name is required'
                 WHEN job_type <> 'CALL_WEBHOOK' THEN 'unsupported job type'
                 WHEN NOT json_valid(payload) OR trim(payload) = 'null' THEN 'payload must be valid JSON'
                 WHEN run_at IS NULL THEN 'run_at is required'
                 WHEN priority NOT BETWEEN 0 AND 10 THEN 'priority must be between 0 and 10' END AS error,
         concat_ws('|', name, job_type, payload, run_at, priority, max_retries) AS fingerprint
  FROM filled),
owners AS (
  SELECT tenant_id, idempotency_key, min(seq) AS owner_seq, arg_min(fingerprint, seq) AS owner_print
  FROM checked WHERE error IS NULL AND idempotency_key IS NOT NULL GROUP BY tenant_id, idempotency_key),
decided AS (
  SELECT c.seq, c.tenant_id, c.idempotency_key, c.error, CASE WHEN c.error IS NULL THEN o.owner_seq END AS owner_seq,
         CASE WHEN c.error IS NOT NULL THEN 'INVALID'
              WHEN o.owner_seq IS NULL OR o.owner_seq = c.seq THEN 'CREATED'
              WHEN o.owner_print = c.fingerprint THEN 'REPLAYED' ELSE 'CONFLICT' END AS outcome
  FROM checked c LEFT JOIN owners o ON c.tenant_id = o.tenant_id AND c.idempotency_key = o.idempotency_key)"""


@query("counters_with_replays", """
SELECT coalesce(c.job_type, r.job_type) AS job_type, coalesce(c.created, 0) + coalesce(r.replays, 0) AS created, coalesce(c.claimed, 0) AS claimed
FROM (SELECT j.job_type, count(*) FILTER (WHERE event_type = 'job.created') AS created, count(*) FILTER (WHERE event_type = 'job.started') AS claimed
      FROM v_outbox o JOIN v_jobs j ON o.job_id = j.job_id GROUP BY j.job_type) c
FULL JOIN (SELECT k.job_type, count(*) AS replays FROM decided d JOIN checked k ON d.seq = k.seq WHERE d.outcome = 'REPLAYED' GROUP BY k.job_type) r
  ON c.job_type = r.job_type""",
       ("v_jobs", "v_outbox", "v_submissions"), _SUBMITTED)
def _(v):
    """Created and claimed per job type, with repeats that were answered with the job they had made."""
    judged = submit.judge_requests(v.submissions, None, NOW)
    return reports.lifecycle_counters(v.outbox, v.jobs, judged).select("job_type", "created", "claimed")


@query("list_dead_letters", """
SELECT dead_letter_id, tenant_id, failed_at FROM v_dead_letters WHERE tenant_id = 3 ORDER BY failed_at DESC, dead_letter_id DESC LIMIT 5 OFFSET 5""",
       ("v_jobs", "v_dead_letters"))
def _(v):
    return listing.list_dead_letters(v.dead_letters, 3, page=2, size=5).select("dead_letter_id", "tenant_id", "failed_at")


@query("submit_validation", "SELECT seq, error FROM checked", ("v_submissions",), _SUBMITTED)
def _(v):
    return R.with_defaults(v.submissions).select("seq", R.validation_error().alias("error"))


@query("submit_result", """
SELECT seq, tenant_id, idempotency_key, outcome, error, owner_seq,
       CASE WHEN outcome IN ('CREATED', 'REPLAYED') THEN 'PENDING' END AS status
FROM decided""", ("v_submissions",), _SUBMITTED)
def _(v):
    return submit.judge_requests(v.submissions, None, NOW).select(
        "seq", "tenant_id", "idempotency_key", "outcome", "error", "owner_seq", "status"
    )


@query("submit_jobs", f"""
SELECT d.tenant_id, d.idempotency_key, 'PENDING' AS status, 5 AS priority, 0 AS retry_count, 3 AS max_retries,
       30 AS retry_backoff_seconds, 300 AS timeout_seconds, {JOBS_NOW} AS created_at, count(*) AS jobs
FROM decided d WHERE outcome = 'CREATED' GROUP BY ALL""", ("v_submissions",), _SUBMITTED)
def _(v):
    made = submit.submit(v.submissions, None, NOW).jobs
    return made.groupBy("tenant_id", "idempotency_key", "status", "priority", "retry_count", "max_retries",
                        "retry_backoff_seconds", "timeout_seconds", "created_at").agg(
        F.count_distinct("job_id").alias("jobs"))


@query("resubmit_result", """
SELECT seq, CASE WHEN outcome = 'CREATED' AND idempotency_key IS NOT NULL THEN 'REPLAYED' ELSE outcome END AS outcome
FROM decided""", ("v_submissions",), _SUBMITTED)
def _(v):
    stored = submit.submit(v.submissions, None, NOW).jobs
    return submit.judge_requests(v.submissions, stored, NOW).select("seq", "outcome")


@query("submit_events", f"""
SELECT tenant_id, 'job.created' AS event_type, 'scheduler-api' AS source, {JOBS_NOW} AS created_at, count(*) AS events
FROM decided WHERE outcome = 'CREATED' GROUP BY tenant_id""", ("v_submissions",), _SUBMITTED)
def _(v):
    told = submit.submit(v.submissions, None, NOW).events
    return told.groupBy("tenant_id", "event_type", "source", "created_at").agg(F.count_distinct("event_id").alias("events"))


# --- dead letters -------------------------------------------------------------------------


@query("list_dead_letters", """SELECT * FROM v_dead_letters WHERE tenant_id = 3
ORDER BY failed_at DESC, dead_letter_id DESC LIMIT 20""", ("v_dead_letters",))
def _(v):
    return listing.list_dead_letters(v.dead_letters, 3)


def _requeued(v):
    return deadletters.requeue(v.dead_letters, v.dead_letters, NOW)


@query("requeue_jobs", f"""
SELECT tenant_id, name, job_type, 'PENDING' AS status, 5 AS priority, {JOBS_NOW} AS run_at, 0 AS retry_count,
       3 AS max_retries, 30 AS retry_backoff_seconds, 300 AS timeout_seconds, dead_letter_id AS source_dead_letter_id
FROM v_dead_letters WHERE requeued_at IS NULL""", ("v_dead_letters",))
def _(v):
    return _requeued(v).jobs.drop("job_id", "payload", "created_at", "updated_at")


@query("requeue_dead_letters", f"""
SELECT dead_letter_id, original_job_id, tenant_id, retry_count, {JOBS_NOW} AS requeued_at
FROM v_dead_letters WHERE requeued_at IS NULL""", ("v_dead_letters",))
def _(v):
    return _requeued(v).dead_letters.select("dead_letter_id", "original_job_id", "tenant_id", "retry_count", "requeued_at")


@query("requeue_rejects", """SELECT tenant_id, dead_letter_id, 'NOT_FOUND' AS reason
FROM v_dead_letters WHERE requeued_at IS NOT NULL""", ("v_dead_letters",))
def _(v):
    return _requeued(v).rejects
