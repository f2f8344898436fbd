"""The lifecycle tables derived from the test tables.

Each text runs in Spark and, with plain table names filled in, in the oracle database.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktide.streaming.io import FILES_PER_BATCH, stream_table

JOBS_AS_OF = "1998-06-30 12:00:00"
EVENTS_AS_OF = "2024-01-20 00:00:00"

VIEWS: dict[str, str] = {
    "v_tenants": """
SELECT n_nationkey AS tenant_id, n_name AS slug FROM {nation}""",
    "v_api_clients": """
SELECT c_custkey AS client_id, c_nationkey AS tenant_id, c_name AS name,
       concat('key-', CAST(c_custkey AS STRING)) AS api_key,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'admin' WHEN 'MACHINERY' THEN 'operator'
            WHEN 'FURNITURE' THEN 'operator' ELSE 'viewer' END AS role,
       c_acctbal >= 0 AS enabled, c_custkey % 10 = 0 AS revoked
FROM {customer}""",
    "v_jobs": """
SELECT o.o_orderkey AS job_id, c.c_nationkey AS tenant_id,
       concat('job-', CAST(o.o_orderkey AS STRING)) AS name,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'SEND_EMAIL' WHEN 'BUILDING' THEN 'CALL_WEBHOOK'
            WHEN 'FURNITURE' THEN 'GENERATE_REPORT' WHEN 'HOUSEHOLD' THEN 'SYNC_CUSTOMER_DATA'
            ELSE 'CLEANUP_EXPIRED_SESSIONS' END AS job_type,
       CASE o.o_orderstatus
         WHEN 'F' THEN CASE o.o_orderkey % 4 WHEN 0 THEN 'DEAD_LETTERED' WHEN 1 THEN 'CANCELLED' ELSE 'SUCCEEDED' END
         WHEN 'O' THEN CASE o.o_orderkey % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'SCHEDULED' WHEN 2 THEN 'RETRY_SCHEDULED' ELSE 'PAUSED' END
         ELSE CASE o.o_orderkey % 8 WHEN 0 THEN 'FAILED' ELSE 'RUNNING' END END AS status,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 10 WHEN '2-HIGH' THEN 8 WHEN '5-LOW' THEN 1 ELSE 5 END AS priority,
       o.o_orderdate + INTERVAL '1' HOUR * CAST(o.o_orderkey % 24 AS INT) AS run_at,
       o.o_orderdate AS created_at,
       o.o_orderkey % 5 AS retry_count, 3 AS max_retries,
       CASE WHEN o.o_orderkey % 6 = 0 THEN 0 ELSE 30 END AS retry_backoff_seconds,
       300 AS timeout_seconds,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 8 <> 0
            THEN concat('worker-', CAST(o.o_custkey % 20 AS STRING)) END AS locked_by,
       CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 8 <> 0 AND o.o_orderkey % 13 <> 0
            THEN o.o_orderdate + INTERVAL '1' HOUR * CAST(o.o_orderkey % 24 AS INT) + INTERVAL '360' SECOND END AS locked_until
FROM {orders} o LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey""",
    "v_open_attempts": """
SELECT job_id AS attempt_id, job_id, tenant_id, locked_by AS worker_id,
       CAST(retry_count + 1 AS INT) AS attempt_number, 'RUNNING' AS status, run_at AS started_at
FROM {v_jobs} WHERE status = 'RUNNING'""",
    "v_outcomes": """
SELECT job_id, CASE WHEN job_id % 7 = 0 THEN 'worker-stale' ELSE locked_by END AS worker_id,
       CASE CAST(FLOOR(job_id / 5.0) AS BIGINT) % 5 WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 429 WHEN 3 THEN 400 ELSE 204 END AS http_status,
       CASE WHEN CAST(FLOOR(job_id / 5.0) AS BIGINT) % 5 = 2 THEN CASE job_id % 3 WHEN 0 THEN ' 120 ' WHEN 1 THEN '5000' ELSE 'soon' END END AS retry_after,
       job_id % 1000 AS duration_ms
FROM {v_jobs} WHERE status = 'RUNNING'""",
    # Claims that were given back have left older attempts open.
    "v_all_open_attempts": """
SELECT * FROM {v_open_attempts}
UNION ALL
SELECT -job_id AS attempt_id, job_id, tenant_id, worker_id, attempt_number, status, started_at - INTERVAL '1' HOUR AS started_at
FROM {v_open_attempts} WHERE job_id % 6 = 0""",
    # Reports that name their attempt: of every job, again with another outcome, late for an attempt long gone, and by others.
    "v_reports": """
WITH numbered AS (SELECT *, CAST(FLOOR(job_id / 5.0) AS BIGINT) % 9 AS kind FROM {v_jobs} WHERE status = 'RUNNING'),
told AS (
  SELECT job_id * 4 AS outcome_id, job_id, CASE WHEN job_id % 12 = 0 THEN -job_id WHEN job_id % 13 = 0 THEN 1000000000 + job_id ELSE job_id END AS attempt_id,
         CASE WHEN job_id % 7 = 0 THEN 'worker-stale' ELSE locked_by END AS worker_id, kind FROM numbered
  UNION ALL
  SELECT job_id * 4 + 1, job_id, job_id, locked_by, 4 FROM numbered WHERE job_id % 3 = 0
  UNION ALL
  SELECT job_id * 4 - 1, job_id, CAST(NULL AS BIGINT), locked_by, 4 FROM numbered WHERE job_id % 5 = 0)
SELECT outcome_id, job_id, attempt_id, worker_id, job_id % 1000 AS duration_ms,
       CASE kind WHEN 0 THEN 200 WHEN 1 THEN 503 WHEN 2 THEN 429 WHEN 3 THEN 400 WHEN 4 THEN 204 END AS http_status,
       CASE WHEN kind = 2 THEN CASE job_id % 3 WHEN 0 THEN ' 120 ' WHEN 1 THEN '5000' ELSE 'soon' END END AS retry_after,
       CASE kind WHEN 0 THEN repeat('all "fine" ', CAST(1 + job_id % 600 AS INT)) WHEN 1 THEN concat('busy ', CAST(job_id AS STRING)) END AS body,
       CASE kind WHEN 6 THEN 'timeout' WHEN 7 THEN CASE job_id % 3 WHEN 0 THEN 'build' WHEN 1 THEN 'cancelled' ELSE 'read' END WHEN 8 THEN 'panic' END AS error_kind,
       CASE WHEN kind >= 6 THEN concat('failed: ', CAST(kind AS STRING)) END AS error_message
FROM told""",
    "v_dead_letters": """
SELECT job_id AS dead_letter_id, job_id AS original_job_id, tenant_id, name, job_type,
       'webhook returned HTTP 503' AS final_error, retry_count + 1 AS retry_count, run_at AS failed_at,
       CASE WHEN job_id % 3 = 0 THEN run_at + INTERVAL '1' DAY END AS requeued_at
FROM {v_jobs} WHERE status = 'DEAD_LETTERED'""",
    "v_attempts": """
WITH raw AS (
  SELECT event_id AS attempt_id, CAST(FLOOR(event_id / 4.0) AS BIGINT) AS job_id,
         CAST(event_id % 4 + 1 AS INT) AS attempt_number,
         concat('worker-', CAST(user_id % 20 AS STRING)) AS worker_id, ts AS started_at,
         CAST(ROUND(value * 1000) AS BIGINT) AS duration_ms,
         CASE event_type WHEN 'click' THEN 200 WHEN 'signup' THEN 204 WHEN 'view' THEN 429
              WHEN 'error' THEN 503 ELSE 400 END AS http_status
  FROM {events}),
marked AS (
  SELECT *, COALESCE(SUM(CASE WHEN http_status IN (200, 204, 400) THEN 1 ELSE 0 END) OVER (
           PARTITION BY job_id ORDER BY attempt_number
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS finals_before
  FROM raw)
SELECT attempt_id, job_id, attempt_number, worker_id, started_at, duration_ms, http_status,
       CASE WHEN http_status BETWEEN 200 AND 299 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status
FROM marked WHERE finals_before = 0""",
    "v_outbox": """
SELECT event_id, user_id AS job_id, user_id % 5 AS tenant_id,
       CASE event_type WHEN 'signup' THEN 'job.created' WHEN 'view' THEN 'job.started'
            WHEN 'purchase' THEN 'job.completed' WHEN 'error' THEN 'job.failed'
            ELSE 'job.retry_scheduled' END AS event_type,
       CASE event_type WHEN 'signup' THEN 'scheduler-api' ELSE 'worker' END AS source,
       ts AS created_at,
       CASE WHEN event_id % 7 <> 0 THEN ts + INTERVAL '1' SECOND * CAST(event_id % 60 AS INT) END AS published_at,
       ts + INTERVAL '1' HOUR * CAST(event_id % 48 AS INT) AS next_publish_at,
       CASE WHEN event_id % 21 = 0 THEN ts + INTERVAL '1' DAY * CAST(event_id % 9 AS INT) END AS claimed_until,
       event_id % 5 AS publish_attempts, props AS payload
FROM {events}""",
    "v_heartbeats": """
SELECT concat('worker-', CAST(user_id % 20 AS STRING)) AS worker_id, ts FROM {events}""",
    "v_requests": """
SELECT event_id AS request_id, ts, user_id AS client_id,
       concat('key-', CAST(user_id AS STRING)) AS api_key,
       concat('/', event_type) AS route, value / 100 AS duration_s,
       CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 201 ELSE 200 END AS http_status,
       CASE event_type WHEN 'signup' THEN 'operator' WHEN 'purchase' THEN 'admin' ELSE 'viewer' END AS required_role
FROM {events}""",
    "v_submissions": """
SELECT o_orderkey AS seq, o_orderkey % 5 AS tenant_id,
       CASE WHEN o_orderkey % 11 <> 0 THEN concat('k-', CAST(o_orderkey % 3000 AS STRING)) END AS idempotency_key,
       CASE WHEN o_orderkey % 97 = 0 THEN '  ' ELSE 'nightly' END AS name,
       CASE WHEN o_orderkey % 89 = 0 THEN 'UNKNOWN' ELSE 'CALL_WEBHOOK' END AS job_type,
       concat('{{"url":"https://example.com/', o_orderpriority, '"}}') AS payload,
       TIMESTAMP '1998-01-01 00:00:00' AS run_at,
       CASE WHEN o_orderkey % 83 = 0 THEN 11 ELSE 0 END AS priority,
       0 AS max_retries, 0 AS retry_backoff_seconds, 0 AS timeout_seconds
FROM {orders}""",
    "v_commands": """
SELECT event_id AS command_id, event_id AS job_id, ts AS issued_at,
       CASE event_type WHEN 'click' THEN 'pause' WHEN 'view' THEN 'resume' WHEN 'error' THEN 'retry'
            ELSE 'cancel' END AS command
FROM {events}""",
    # Several commands per job: the same operators acting on the jobs whose ids match a user.
    "v_command_series": """
SELECT event_id AS command_id, user_id AS job_id, ts AS issued_at,
       CASE event_type WHEN 'click' THEN 'pause' WHEN 'view' THEN 'resume' WHEN 'error' THEN 'pause'
            WHEN 'signup' THEN 'retry' ELSE CASE event_id % 9 WHEN 0 THEN 'cancel' ELSE 'resume' END END AS command
FROM {events}""",
}


# The test tables' columns: fixed, so that no file has to be opened to learn them.
RAW_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def inputs_of(text: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(text) if name))


class Views:
    """The views as DataFrames over one folder of test tables, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir.rstrip("/")
        self._built: dict[str, DataFrame] = {}

    def streaming(self, table: str, path: str | None = None, files_per_batch: int = FILES_PER_BATCH) -> Views:
        """The same views with one raw table read as a stream, from its own place or from ``path``."""
        other = Views(self._spark, self._dir)
        # A pattern, because the file source wants a folder or a glob and the table may be either.
        path = path or f"{self._dir}/{table}.parque[t]"
        other._path = path
        other._built[table] = stream_table(self._spark, path, RAW_SCHEMAS[table], files_per_batch=files_per_batch)
        return other

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._built:
            view = f"v_{name}"
            if view in VIEWS:
                text = VIEWS[view]
                parts = {n: getattr(self, n.removeprefix("v_")) for n in inputs_of(text)}
                df = self._spark.sql(text, **parts)
                for column, kind in df.dtypes:
                    if kind == "timestamp":
                        df = df.withColumn(column, F.col(column).cast("timestamp_ntz"))
            else:
                df = self._spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{self._dir}/{name}.parquet")
            self._built[name] = df
        return self._built[name]


def with_views(*names: str) -> str:
    """A WITH clause defining views and everything they need, over the raw tables."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in inputs_of(VIEWS[name]):
            if needed in VIEWS:
                add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = []
    for name in ordered:
        text = VIEWS[name].format(**{n: n for n in inputs_of(VIEWS[name])})
        parts.append(f"{name} AS ({text}\n)")
    return "WITH RECURSIVE " + ",\n".join(parts)
