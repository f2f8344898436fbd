"""Queries about the outbox, the dashboard, metrics and consistency."""

from __future__ import annotations

from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators import audit, listing, outbox, quantiles, reconcile, reports
from worktide.plans.registry import EVENTS_NOW, query
from worktide.plans.views import EVENTS_AS_OF
from worktide.sources.outlet import envelope

NOW = EVENTS_AS_OF
TTL = 3600

UNCLAIMED = "published_at IS NULL AND next_publish_at <= {0} AND (claimed_until IS NULL OR claimed_until < {0})".format(EVENTS_NOW)


# --- outbox -------------------------------------------------------------------------------


@query("publishable", f"SELECT * FROM v_outbox WHERE {UNCLAIMED} ORDER BY created_at, event_id LIMIT 100", ("v_outbox",))
def _(v):
    return outbox.publishable(v.outbox, NOW, 100)


@query("claim_publishable", f"""
SELECT event_id, 'relay-a' AS claimed_by, {EVENTS_NOW} + INTERVAL '30' SECOND AS claimed_until FROM v_outbox
WHERE {UNCLAIMED} ORDER BY created_at, event_id LIMIT 100""", ("v_outbox",))
def _(v):
    return outbox.claim_publishable(v.outbox, NOW, "relay-a", 100).select("event_id", "claimed_by", "claimed_until")


# Every unpublished event is held by one of three relays; a third of the reports come from the wrong one.
_HELD = """held AS (
  SELECT *, CASE WHEN published_at IS NULL THEN concat('relay-', event_id % 3) END AS claimed_by FROM v_outbox),
results AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN concat('relay-', event_id % 3) ELSE 'relay-0' END AS relay_id,
         publish_attempts <> 3 AS delivered FROM held WHERE published_at IS NULL)"""


def _held(v):
    relay = F.concat(F.lit("relay-"), (F.col("event_id") % 3).cast("string"))
    return v.outbox.withColumn("claimed_by", F.when(F.col("published_at").isNull(), relay))


def _results(v):
    reporter = F.when(F.col("event_id") % 2 == 0, F.col("claimed_by")).otherwise("relay-0")
    return _held(v).filter(F.col("published_at").isNull()).select(
        F.col("event_id").alias("result_id"), "event_id", reporter.alias("relay_id"),
        (F.col("publish_attempts") != 3).alias("delivered"), F.lit("broker refused the record").alias("error"),
    )


@query("publish_results", f"""
SELECT h.event_id, CASE WHEN delivered THEN {EVENTS_NOW} END AS published_at, publish_attempts + 1 AS publish_attempts,
       CASE WHEN NOT delivered THEN 'broker refused the record' END AS last_publish_error,
       CASE WHEN delivered THEN next_publish_at
            ELSE {EVENTS_NOW} + INTERVAL '1' SECOND * CAST(least(300, pow(2, publish_attempts)) AS INT) END AS next_publish_at,
       CAST(NULL AS VARCHAR) AS claimed_by, CAST(NULL AS TIMESTAMP) AS claimed_until
FROM held h JOIN results r ON h.event_id = r.event_id AND h.claimed_by = r.relay_id""", ("v_outbox",), _HELD)
def _(v):
    return outbox.apply_publish_results(_held(v), _results(v), NOW).events.select(
        "event_id", "published_at", "publish_attempts", "last_publish_error", "next_publish_at", "claimed_by", "claimed_until"
    )


@query("publish_rejects", """
SELECT r.event_id, r.relay_id, 'LEASE_LOST' AS reason FROM results r JOIN held h ON h.event_id = r.event_id
WHERE h.claimed_by <> r.relay_id""", ("v_outbox",), _HELD)
def _(v):
    return outbox.apply_publish_results(_held(v), _results(v), NOW).rejects.select("event_id", "relay_id", "reason")


@query("hold_back", """
SELECT r.event_id, r.delivered FROM results r JOIN held h ON h.event_id = r.event_id
WHERE NOT EXISTS (SELECT 1 FROM results x JOIN held y ON x.event_id = y.event_id
                  WHERE y.job_id = h.job_id AND NOT x.delivered AND (y.created_at, y.event_id) < (h.created_at, h.event_id))""",
       ("v_outbox",), _HELD)
def _(v):
    return outbox.hold_back(_results(v), v.outbox).select("event_id", "delivered")


@query("publish_backoff", """
SELECT event_id, CAST(least(300, pow(2, event_id % 12)) AS BIGINT) AS delay_seconds FROM v_outbox""", ("v_outbox",))
def _(v):
    return v.outbox.select("event_id", R.publish_delay_seconds(F.col("event_id") % 12).alias("delay_seconds"))


@query("replay_events", f"""
SELECT event_id, tenant_id, CAST(NULL AS TIMESTAMP) AS published_at, {EVENTS_NOW} AS next_publish_at, publish_attempts,
       CAST(NULL AS TIMESTAMP) AS claimed_until
FROM v_outbox WHERE published_at IS NOT NULL""", ("v_outbox",))
def _(v):
    wanted = v.outbox.filter(F.col("published_at").isNotNull())
    return outbox.replay(v.outbox, wanted, NOW).events.select(
        "event_id", "tenant_id", "published_at", "next_publish_at", "publish_attempts", "claimed_until")


ENVELOPE_SQL = """
SELECT CAST(job_id AS VARCHAR) AS key, concat(
  '{"event_id":"', event_id, '","schema_version":1,"tenant_id":"', tenant_id, '","event_type":"', event_type,
  '","source":"', source, '","entity_type":"job","entity_id":"', job_id, '","occurred_at":"',
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ'), '","payload":', replace(payload, ': ', ':'), '}') AS value
FROM v_outbox"""


@query("envelope", ENVELOPE_SQL, ("v_outbox",))
def _(v):
    return envelope(v.outbox).select("key", "value")


@query("outbox_backlog", "SELECT tenant_id, count(*) FILTER (WHERE published_at IS NULL) AS backlog FROM v_outbox GROUP BY tenant_id", ("v_outbox",))
def _(v):
    return reports.outbox_backlog(v.outbox, ["tenant_id"])


@query("outbox_backlog_total", "SELECT count(*) AS backlog FROM v_outbox WHERE published_at IS NULL", ("v_outbox",))
def _(v):
    return reports.outbox_backlog(v.outbox)


# --- dashboard ----------------------------------------------------------------------------

_ENDED = """ended AS (
  SELECT a.*, j.tenant_id, j.job_type,
         CASE WHEN a.status = 'FAILED' THEN started_at + INTERVAL '1' MILLISECOND * CAST(duration_ms AS INT) END AS failed_at
  FROM v_attempts a JOIN v_jobs j ON a.job_id = j.job_id)"""


def _ended(v):
    end = F.timestamp_add("MILLISECOND", F.col("duration_ms"), F.col("started_at"))
    return v.attempts.withColumn("failed_at", F.when(F.col("status") == S.FAILED, end)).join(
        v.jobs.select("job_id", "tenant_id", "job_type"), "job_id"
    )


@query("recent_failures", f"""SELECT tenant_id, count(*) AS failures FROM ended
WHERE status = 'FAILED' AND failed_at >= {EVENTS_NOW} - INTERVAL '24' HOUR GROUP BY tenant_id""", ("v_jobs", "v_attempts"), _ENDED)
def _(v):
    return reports.recent_failures(_ended(v), NOW, ["tenant_id"])


_LIVE = f"""live AS (
  SELECT worker_id, max(ts) AS last_heartbeat, 'active' AS status FROM v_heartbeats WHERE ts <= {EVENTS_NOW}
  GROUP BY worker_id HAVING max(ts) + INTERVAL '1' SECOND * {TTL} > {EVENTS_NOW})"""


@query("active_workers", "SELECT * FROM live", ("v_heartbeats",), _LIVE)
def _(v):
    return reports.active_workers(v.heartbeats, NOW, TTL)


_PER_STATUS = ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s.lower()}" for s in S.STATUSES)


@query("dashboard", f"""
SELECT j.*, (SELECT count(*) FROM live) AS active_workers, coalesce(o.backlog, 0) AS outbox_backlog,
       coalesce(f.failures, 0) AS failures_last_24_hours
FROM (SELECT tenant_id, count(*) AS total_jobs, {_PER_STATUS} FROM v_jobs GROUP BY tenant_id) j
LEFT JOIN (SELECT tenant_id, count(*) AS backlog FROM v_outbox WHERE published_at IS NULL GROUP BY tenant_id) o ON o.tenant_id = j.tenant_id
LEFT JOIN (SELECT tenant_id, count(*) AS failures FROM ended WHERE status = 'FAILED'
           AND failed_at >= {EVENTS_NOW} - INTERVAL '24' HOUR GROUP BY tenant_id) f ON f.tenant_id = j.tenant_id""",
       ("v_jobs", "v_attempts", "v_outbox", "v_heartbeats"), f"{_ENDED},\n{_LIVE}")
def _(v):
    board = reports.dashboard(v.jobs, _ended(v), v.outbox, v.heartbeats, NOW, TTL)
    counts = [F.coalesce(F.try_element_at("status_counts", F.lit(s)), F.lit(0)).alias(s.lower()) for s in S.STATUSES]
    return board.select(F.col("tenant_id").cast("int").alias("tenant_id"), "total_jobs", "active_workers", "outbox_backlog", "failures_last_24_hours", *counts)


# --- counters, histograms, quantiles ------------------------------------------------------


@query("lifecycle_counters", """
SELECT j.job_type, count(*) FILTER (WHERE event_type = 'job.created') AS created,
       count(*) FILTER (WHERE event_type = 'job.started') AS claimed,
       count(*) FILTER (WHERE event_type = 'job.completed') AS completed,
       count(*) FILTER (WHERE event_type = 'job.failed') AS failed,
       count(*) FILTER (WHERE event_type = 'job.dead_lettered' AND source <> 'recovery') AS dead_lettered
FROM v_outbox o JOIN v_jobs j ON o.job_id = j.job_id GROUP BY j.job_type""", ("v_jobs", "v_outbox"))
def _(v):
    return reports.lifecycle_counters(v.outbox, v.jobs)


_BUCKETS = "buckets AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{b:g}', {b}::DOUBLE)" for b in S.DURATION_BUCKETS) + ", ('+Inf', 'Infinity'::DOUBLE)) t(le, bound))"


def _histogram_sql(source: str, by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""
SELECT {keys}le, count(*) FILTER (WHERE v <= bound) AS bucket_count, count(*) AS total_count, round(sum(v), 3) AS total_sum
FROM ({source}) m CROSS JOIN buckets GROUP BY {keys}le"""


def _rounded(df):
    return df.withColumn("total_sum", F.round("total_sum", 3))


@query("duration_histogram", _histogram_sql(
    "SELECT job_type, duration_ms / 1000.0::DOUBLE AS v FROM ended WHERE status = 'SUCCEEDED'", "job_type"),
       ("v_jobs", "v_attempts"), f"{_ENDED},\n{_BUCKETS}")
def _(v):
    return _rounded(reports.duration_histogram(v.attempts, v.jobs))


_METHOD = "CASE required_role WHEN 'operator' THEN 'POST' WHEN 'admin' THEN 'DELETE' ELSE 'GET' END"


def _http(v):
    role = F.col("required_role")
    return v.requests.withColumn("method", F.when(role == "operator", "POST").when(role == "admin", "DELETE").otherwise("GET"))


@query("http_counts", f"""SELECT {_METHOD} AS method, route, http_status AS status, count(*) AS requests
FROM v_requests GROUP BY ALL""", ("v_requests",))
def _(v):
    return reports.http_counts(_http(v))


@query("http_latency", _histogram_sql(f"SELECT {_METHOD} AS method, route, duration_s AS v FROM v_requests", "method, route"),
       ("v_requests",), _BUCKETS)
def _(v):
    return _rounded(reports.http_latency(_http(v)))


@query("publish_counters", """
SELECT tenant_id, count(published_at) AS published,
       CAST(sum(greatest(publish_attempts - CASE WHEN published_at IS NULL THEN 0 ELSE 1 END, 0)) AS BIGINT) AS publish_failures
FROM v_outbox GROUP BY tenant_id""", ("v_outbox",))
def _(v):
    return reports.publish_counters(v.outbox, ["tenant_id"])


@query("publish_latency", _histogram_sql(
    "SELECT tenant_id, floor((epoch_us(published_at) - epoch_us(created_at)) / 1000) / 1000.0::DOUBLE AS v FROM v_outbox WHERE published_at IS NOT NULL",
    "tenant_id"), ("v_outbox",), _BUCKETS)
def _(v):
    return _rounded(reports.publish_latency(v.outbox, ["tenant_id"]))


def _quantile_sql(value: str, source: str, by: str) -> str:
    return f"""
SELECT {by}, round(quantile_cont({value}, 0.5), 4) AS p50, round(quantile_cont({value}, 0.95), 4) AS p95,
       max({value}) AS max, count(*) AS rows
FROM {source} GROUP BY {by}"""


def _quantiles(df, value, by):
    return reports.latency_quantiles(df, value, by).withColumns({"p50": F.round("p50", 4), "p95": F.round("p95", 4)})


@query("execution_quantiles", _quantile_sql("duration_ms", "ended", "job_type"), ("v_jobs", "v_attempts"), _ENDED)
def _(v):
    return _quantiles(_ended(v), F.col("duration_ms"), ["job_type"])


@query("latency_quantiles_us", """
SELECT tenant_id, count(*) AS rows, round(quantile_cont(us::DOUBLE, 0.5), 3) AS p50, round(quantile_cont(us::DOUBLE, 0.95), 3) AS p95,
       round(quantile_cont(us::DOUBLE, 0.999), 3) AS p999
FROM (SELECT CASE WHEN job_id % 3 = 0 THEN 0 ELSE tenant_id END AS tenant_id, epoch_us(published_at) - epoch_us(created_at) + event_id % 1000 AS us
      FROM v_outbox WHERE published_at IS NOT NULL) lag GROUP BY tenant_id""", ("v_outbox",))
def _(v):
    """Quantiles of microseconds by selection, with one hot group."""
    us = F.unix_micros(F.col("published_at").cast("timestamp")) - F.unix_micros(F.col("created_at").cast("timestamp")) + F.col("event_id") % 1000
    rows = v.outbox.withColumn("tenant_id", F.when(F.col("job_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("tenant_id")))
    found = quantiles.exact_quantiles(rows, us, (0.5, 0.95, 0.999), ["tenant_id"])
    return found.select("tenant_id", "rows", *[F.round(F.col("quantiles")[i], 3).alias(n) for i, n in enumerate(("p50", "p95", "p999"))])


@query("reconcile_status", """
, s AS (SELECT job_id, arg_max(event_type, (created_at, event_id)) AS last, max(created_at) AS since FROM v_outbox GROUP BY job_id)
SELECT job_id, 'left_only' AS kind, last AS left_last, NULL AS right_last FROM s WHERE job_id % 89 = 0
UNION ALL SELECT -job_id - 1, 'right_only', NULL, last FROM s WHERE job_id % 83 = 0
UNION ALL SELECT job_id, 'differs', last, 'job.lost' FROM s WHERE job_id % 97 = 0 AND job_id % 89 <> 0""", ("v_outbox",), "none AS (SELECT 1)")
def _(v):
    """Each job's last event against a copy in which some are missing, added or altered."""
    own = v.outbox.groupBy("job_id").agg(F.max_by("event_type", F.struct("created_at", "event_id")).alias("last"), F.max("created_at").alias("since"))
    copy = own.filter("job_id % 89 <> 0").withColumn("last", F.when(F.col("job_id") % 97 == 0, "job.lost").otherwise(F.col("last")))
    copy = copy.unionByName(own.filter("job_id % 83 = 0").withColumn("job_id", -F.col("job_id") - 1))
    found = reconcile.differences(own, copy, "job_id", ["last", "since"])
    return found.select("job_id", "kind", F.col("left.last").alias("left_last"), F.col("right.last").alias("right_last"))


@query("publication_quantiles", _quantile_sql("ms", """(
  SELECT tenant_id, CAST(floor((epoch_us(published_at) - epoch_us(created_at)) / 1000) AS BIGINT) AS ms
  FROM v_outbox WHERE published_at IS NOT NULL) lag""", "tenant_id"), ("v_outbox",))
def _(v):
    done = v.outbox.filter(F.col("published_at").isNotNull())
    return _quantiles(done, reports.lag_ms("published_at", "created_at"), ["tenant_id"])


@query("throughput", """
SELECT job_type, count(*) AS rows, (epoch_us(max(started_at)) - epoch_us(min(started_at))) / 1000000.0 AS seconds,
       round(count(*) / ((epoch_us(max(started_at)) - epoch_us(min(started_at))) / 1000000.0), 9) AS per_second
FROM ended GROUP BY job_type""", ("v_jobs", "v_attempts"), _ENDED)
def _(v):
    return reports.throughput(_ended(v), "started_at", ["job_type"]).withColumn("per_second", F.round("per_second", 9))


# --- consistency --------------------------------------------------------------------------

_SEQUENCE = """numbers AS (
  SELECT job_id, attempt_number, count(*) AS n, count(*) FILTER (WHERE status = 'RUNNING') AS running,
         count(*) FILTER (WHERE status = 'SUCCEEDED') AS won
  FROM tried GROUP BY job_id, attempt_number),
sequence AS (
  SELECT job_id, CAST(sum(n) AS BIGINT) AS attempts, max(attempt_number) AS last_number,
         CAST(max(attempt_number) - count(*) AS BIGINT) AS missing_numbers,
         count(*) FILTER (WHERE n > 1) AS repeated_numbers, CAST(sum(running) AS BIGINT) AS open_attempts,
         CAST(sum(won) AS BIGINT) AS successes
  FROM numbers GROUP BY job_id)"""
_TRIED = """tried AS (
  SELECT job_id, attempt_number, status FROM v_attempts
  UNION ALL SELECT job_id, attempt_number, status FROM v_open_attempts)"""


def _tried(v):
    return v.attempts.select("job_id", "attempt_number", "status").unionByName(
        v.open_attempts.select("job_id", "attempt_number", "status"))


@query("attempt_sequence", """
SELECT *, missing_numbers = 0 AND repeated_numbers = 0 AND open_attempts <= 1 AND successes <= 1 AS in_order FROM sequence""",
       ("v_jobs", "v_attempts", "v_open_attempts"), f"{_TRIED},\n{_SEQUENCE}")
def _(v):
    return audit.attempt_sequence(_tried(v))


@query("overlapping_attempts", """
SELECT job_id, attempt_number, attempt_id, previous_end FROM (
  SELECT *, max(started_at + INTERVAL '1' MILLISECOND * CAST(duration_ms AS INT)) OVER (
    PARTITION BY job_id ORDER BY started_at, attempt_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_end
  FROM late) t
WHERE started_at < previous_end""",
       ("v_attempts",), "late AS (SELECT * REPLACE (duration_ms * 100 AS duration_ms) FROM v_attempts)")
def _(v):
    late = v.attempts.withColumn("duration_ms", F.col("duration_ms") * 100)
    return audit.overlapping_attempts(late).select("job_id", "attempt_number", "attempt_id", "previous_end")


# Tables in which every rule is broken somewhere.
_BROKEN = """broken AS (SELECT * REPLACE (CASE WHEN job_id % 11 = 0 THEN 'BROKEN' ELSE status END AS status, CASE WHEN job_id % 13 <> 0 THEN locked_by END AS locked_by) FROM v_jobs),
overlap AS (SELECT *, max(started_at + INTERVAL '1' MILLISECOND * CAST(duration_ms * 100 AS INT)) OVER (
  PARTITION BY job_id ORDER BY started_at, attempt_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_end FROM v_attempts)"""


@query("audit", """
SELECT 'attempt_claimed_twice' AS rule, count(*) FILTER (WHERE repeated_numbers > 0) AS violations FROM sequence
UNION ALL SELECT 'several_open_attempts', count(*) FILTER (WHERE open_attempts > 1) FROM sequence
UNION ALL SELECT 'attempt_number_missing', count(*) FILTER (WHERE missing_numbers > 0) FROM sequence
UNION ALL SELECT 'running_job_without_attempt', count(*) FROM broken j WHERE status = 'RUNNING'
  AND NOT EXISTS (SELECT 1 FROM tried t WHERE t.job_id = j.job_id AND t.status = 'RUNNING')
UNION ALL SELECT 'open_attempt_without_running_job', count(*) FROM tried t WHERE status = 'RUNNING'
  AND NOT EXISTS (SELECT 1 FROM broken j WHERE t.job_id = j.job_id AND j.status = 'RUNNING')
UNION ALL SELECT 'several_successes', count(*) FROM (SELECT job_id FROM tried WHERE status = 'SUCCEEDED' GROUP BY job_id HAVING count(*) > 1) s
UNION ALL SELECT 'unpublished_event', count(*) FROM v_outbox WHERE published_at IS NULL
UNION ALL SELECT 'unknown_status', count(*) FROM broken WHERE status = 'BROKEN'
UNION ALL SELECT 'attempts_overlap', count(*) FROM overlap WHERE started_at < previous_end
UNION ALL SELECT 'running_job_without_owner', count(*) FROM broken WHERE status = 'RUNNING' AND locked_by IS NULL
UNION ALL SELECT 'idempotency_key_reused', count(*) FROM (
  SELECT tenant_id, idempotency_key FROM v_submissions WHERE idempotency_key IS NOT NULL
  GROUP BY tenant_id, idempotency_key HAVING count(*) > 1) k""",
       ("v_jobs", "v_attempts", "v_open_attempts", "v_outbox", "v_submissions"), f"{_TRIED},\n{_SEQUENCE},\n{_BROKEN}")
def _(v):
    jobs = v.jobs.withColumns({"status": F.when(F.col("job_id") % 11 == 0, "BROKEN").otherwise(F.col("status")),
                               "locked_by": F.when(F.col("job_id") % 13 != 0, F.col("locked_by"))})
    timed = v.attempts.withColumn("duration_ms", F.col("duration_ms") * 100)
    return audit.audit(jobs, _tried(v), v.outbox, v.submissions, timed)


STATUS_SQL = """CASE event_type WHEN 'job.created' THEN 'PENDING' WHEN 'job.started' THEN 'RUNNING'
  WHEN 'job.completed' THEN 'SUCCEEDED' WHEN 'job.failed' THEN 'FAILED' WHEN 'job.retry_scheduled' THEN 'RETRY_SCHEDULED' END"""
MOVES_SQL = " OR ".join(
    f"(previous_status = '{start}' AND status IN ({', '.join(repr(e) for e in ends)}))" for start, ends in S.MOVES.items())
STEPS = f"""steps AS (
  SELECT job_id, event_id, created_at, event_type, {STATUS_SQL} AS status,
         lag({STATUS_SQL}) OVER (PARTITION BY job_id ORDER BY created_at, event_id) AS previous_status
  FROM v_outbox),
judged AS (
  SELECT *, CASE WHEN previous_status IS NULL THEN event_type = 'job.created'
                 ELSE event_type <> 'job.created' AND ({MOVES_SQL}) END AS allowed FROM steps)"""


@query("transition_audit", "SELECT * FROM judged", ("v_outbox",), STEPS)
def _(v):
    return audit.transition_audit(v.outbox)


@query("job_history", """
SELECT j.job_id, j.tenant_id, j.job_type, j.status, coalesce(a.attempts, 0) AS attempts,
       coalesce(a.failed_attempts, 0) AS failed_attempts, a.last_attempt_number, a.last_attempt_status,
       coalesce(e.events, 0) AS events, e.first_event, e.last_event, e.last_event_at
FROM v_jobs j
LEFT JOIN (SELECT job_id, count(*) AS attempts, count(*) FILTER (WHERE status = 'FAILED') AS failed_attempts,
                  max(attempt_number) AS last_attempt_number, arg_max(status, attempt_number) AS last_attempt_status
           FROM v_attempts GROUP BY job_id) a ON a.job_id = j.job_id
LEFT JOIN (SELECT job_id, count(*) AS events, arg_min(event_type, created_at) AS first_event,
                  arg_max(event_type, created_at) AS last_event, max(created_at) AS last_event_at
           FROM v_outbox GROUP BY job_id) e ON e.job_id = j.job_id""", ("v_jobs", "v_attempts", "v_outbox"))
def _(v):
    return listing.job_history(v.jobs, v.attempts, v.outbox)


@query("job_timeline", """
SELECT t.* FROM (
  SELECT job_id, 'attempt' AS section, started_at AS at, attempt_id AS item_id, status AS label FROM v_attempts
  UNION ALL SELECT job_id, 'event', created_at, event_id, event_type FROM v_outbox) t
WHERE EXISTS (SELECT 1 FROM v_jobs j WHERE j.job_id = t.job_id)""", ("v_jobs", "v_attempts", "v_outbox"))
def _(v):
    return listing.job_timeline(v.jobs, v.attempts, v.outbox)
