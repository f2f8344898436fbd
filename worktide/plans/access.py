"""Queries about API access, webhook targets and incoming requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import web
from worktide.operators import access, handlers, limits
from worktide.plans.registry import EVENTS_NOW, query
from worktide.plans.views import EVENTS_AS_OF
from worktide.sources.intake import parse_requests
from worktide.sources.tables import downgrade, upgrade

NOW = EVENTS_AS_OF

_PRINCIPALS = """principals AS (
  SELECT r.request_id, r.ts, r.client_id, r.route, r.duration_s, r.http_status, r.required_role,
         c.client_id AS principal_id, c.tenant_id AS principal_tenant_id, t.slug AS tenant_slug, c.name AS client_name, c.role,
         CASE WHEN (CASE c.role WHEN 'admin' THEN 3 WHEN 'operator' THEN 2 ELSE 1 END)
                >= (CASE r.required_role WHEN 'admin' THEN 3 WHEN 'operator' THEN 2 ELSE 1 END)
              THEN 'OK' ELSE 'FORBIDDEN' END AS access
  FROM v_requests r JOIN v_api_clients c ON sha256(trim(r.api_key)) = sha256(c.api_key) AND c.enabled AND NOT c.revoked
  JOIN v_tenants t ON t.tenant_id = c.tenant_id)"""
_ACCESS = ("v_requests", "v_api_clients", "v_tenants")


def _clients(v):
    return access.digest_clients(v.api_clients)


def _principals(v):
    return access.resolve_principals(v.requests, _clients(v), v.tenants)


@query("principals", "SELECT * FROM principals", _ACCESS, _PRINCIPALS)
def _(v):
    return _principals(v)


@query("unauthorized", """
SELECT request_id, ts, client_id, route, duration_s, http_status, required_role, 'UNAUTHORIZED' AS access
FROM v_requests r WHERE NOT EXISTS (SELECT 1 FROM principals p WHERE p.request_id = r.request_id)""", _ACCESS, _PRINCIPALS)
def _(v):
    return access.unauthorized(v.requests, _clients(v), v.tenants)


@query("client_last_used", "SELECT principal_id AS client_id, max(ts) AS last_used_at FROM principals GROUP BY principal_id", _ACCESS, _PRINCIPALS)
def _(v):
    return access.client_last_used(_principals(v))


@query("key_digests", """SELECT client_id, sha256(trim(api_key)) AS key_hash, substr(trim(api_key), 1, 14) AS key_prefix
FROM v_api_clients""", ("v_api_clients",))
def _(v):
    return _clients(v).select("client_id", "key_hash", "key_prefix")


# Registrations by order: keys of known customers, keys nobody holds yet (several times), unknown roles.
_REGISTERED = """registrations AS (
  SELECT o_orderkey AS registration_id, concat('key-', o_custkey * 2) AS api_key,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'admin' WHEN '2-HIGH' THEN 'operator' WHEN '5-LOW' THEN 'auditor' ELSE 'viewer' END AS role
  FROM orders),
firsts AS (SELECT api_key, min(registration_id) AS first_id FROM registrations WHERE role <> 'auditor' GROUP BY api_key)"""


@query("register_clients", """
SELECT r.registration_id, sha256(r.api_key) AS key_hash, substr(r.api_key, 1, 14) AS key_prefix, r.role,
       CASE WHEN r.role <> 'auditor' THEN coalesce(CAST(c.client_id AS VARCHAR), 'new') END AS client_id,
       r.role <> 'auditor' AND c.client_id IS NULL AND r.registration_id = f.first_id AS is_new,
       CASE WHEN r.role = 'auditor' THEN 'unknown role' END AS error
FROM registrations r LEFT JOIN firsts f ON f.api_key = r.api_key LEFT JOIN v_api_clients c ON c.api_key = r.api_key""",
       ("v_api_clients",), _REGISTERED)
def _(v):
    priority = F.col("o_orderpriority")
    wanted = v.orders.select(
        F.col("o_orderkey").alias("registration_id"),
        F.concat(F.lit("key-"), (F.col("o_custkey") * 2).cast("string")).alias("api_key"),
        F.when(priority == "1-URGENT", "admin").when(priority == "2-HIGH", "operator").when(priority == "5-LOW", "auditor")
        .otherwise("viewer").alias("role"),
    )
    made = access.register_clients(wanted, _clients(v), NOW)
    known = F.when(F.length("client_id") == 64, "new").otherwise(F.col("client_id"))
    return made.withColumn("client_id", known).withColumn("is_new", F.coalesce("is_new", F.lit(False))).select(
        "registration_id", "key_hash", "key_prefix", "role", "client_id", "is_new", "error")


@query("revoke_clients", f"""
SELECT client_id, false AS enabled, {EVENTS_NOW} AS revoked_at FROM v_api_clients c
WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.client_id)""", ("v_api_clients",))
def _(v):
    asked = v.events.select(F.col("user_id").alias("client_id"))
    return access.revoke_clients(_clients(v), asked, NOW)[0].select("client_id", "enabled", "revoked_at")


# --- rate limit ---------------------------------------------------------------------------

CAPACITY, PERIOD = 3, 86_400


@query("rate_limit", f"""
SELECT request_id, client_id, ts, allowed, CAST(units AS BIGINT) AS units_left FROM bucket""", ("v_requests",), f"""
ordered AS (
  SELECT request_id, client_id, ts, epoch_us(ts) AS us,
         row_number() OVER (PARTITION BY client_id ORDER BY ts, request_id) AS n FROM v_requests),
bucket AS (
  SELECT request_id, client_id, ts, us, n, true AS allowed, CAST({CAPACITY - 1} AS HUGEINT) * {PERIOD * 1_000_000} AS units
  FROM ordered WHERE n = 1
  UNION ALL
  SELECT request_id, client_id, ts, us, n, level >= {PERIOD * 1_000_000} AS allowed,
         CASE WHEN level >= {PERIOD * 1_000_000} THEN level - {PERIOD * 1_000_000} ELSE level END AS units
  FROM (SELECT o.request_id, o.client_id, o.ts, o.us, o.n,
               least(CAST({CAPACITY * PERIOD * 1_000_000} AS HUGEINT), b.units + (o.us - b.us) * {CAPACITY}) AS level
        FROM bucket b JOIN ordered o ON o.client_id = b.client_id AND o.n = b.n + 1) refilled)""")
def _(v):
    return limits.rate_limit(v.requests, CAPACITY, PERIOD).select("request_id", "client_id", "ts", "allowed", "units_left")


# --- webhook targets ----------------------------------------------------------------------

ALLOWED = ("spam-farm.example.org", " WWW.ththen.example.com")

# The pages' own addresses, and the same pages behind hosts of other kinds.
_TARGETS = """targets AS (
  SELECT page_id, url FROM pages
  UNION ALL SELECT page_id, concat('http://10.', page_id % 256, '.3.4:8080/', page_id) FROM pages
  UNION ALL SELECT page_id, concat('https://172.', page_id % 40, '.0.1/') FROM pages
  UNION ALL SELECT page_id, concat('http://', page_id % 256, '.168.7.9/x') FROM pages
  UNION ALL SELECT page_id, concat('ftp://files', page_id, '.example.com/') FROM pages
  UNION ALL SELECT page_id, concat('http://user:pw@host', page_id, '.example.com/') FROM pages),
split AS (
  SELECT *, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
         regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS authority,
         regexp_extract(url, '^[a-z]+://(?:[^@/]*@)?([^:/?#]*)', 1) AS host FROM targets),
kinds AS (
  SELECT *, host IN ('spam-farm.example.org', 'www.ththen.example.com') AS listed,
         regexp_full_match(host, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+') AS literal,
         TRY_CAST(split_part(host, '.', 1) AS INT) AS a, TRY_CAST(split_part(host, '.', 2) AS INT) AS b FROM split),
reasons AS (
  SELECT *, CASE WHEN scheme NOT IN ('http', 'https') THEN 'webhook URL must use http or https'
                 WHEN contains(authority, '@') THEN 'webhook URL must not contain credentials'
                 WHEN NOT listed AND literal AND (a IN (10, 127) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)
                      OR (a = 169 AND b = 254)) THEN 'webhook target resolves to a private or local address' END AS reason FROM kinds)"""


@query("classify_targets", """
SELECT page_id, url, host, reason, CASE WHEN reason IS NOT NULL THEN 'UNSAFE_WEBHOOK_TARGET' WHEN listed THEN 'ALLOWED'
       WHEN literal THEN 'SAFE' ELSE 'UNRESOLVED' END AS verdict
FROM reasons""", (), _TARGETS)
def _(v):
    number = F.col("page_id").cast("string")
    kinds = F.array(
        F.col("url"),
        F.concat(F.lit("http://10."), (F.col("page_id") % 256).cast("string"), F.lit(".3.4:8080/"), number),
        F.concat(F.lit("https://172."), (F.col("page_id") % 40).cast("string"), F.lit(".0.1/")),
        F.concat(F.lit("http://"), (F.col("page_id") % 256).cast("string"), F.lit(".168.7.9/x")),
        F.concat(F.lit("ftp://files"), number, F.lit(".example.com/")),
        F.concat(F.lit("http://user:pw@host"), number, F.lit(".example.com/")),
    )
    return web.classify_targets(v.pages.select("page_id", F.explode(kinds).alias("url")), ALLOWED)


@query("classify_targets_by_table", """
SELECT page_id, host, CASE WHEN EXISTS (SELECT 1 FROM split s WHERE s.scheme = 'https' AND s.host = p.host) THEN 'ALLOWED'
       ELSE 'UNRESOLVED' END AS verdict
FROM split p""", (), """split AS (
  SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
         lower(regexp_extract(url, '^[a-z]+://([^:/?#]*)', 1)) AS host FROM pages)""")
def _(v):
    """Hosts that serve any page over https are trusted; the list is a table joined by host."""
    hosts = v.pages.filter(F.col("url").startswith("https:")).select(
        F.regexp_extract("url", "^[a-z]+://([^:/?#]*)", 1).alias("host"))
    return web.classify_targets(v.pages, hosts).select("page_id", "host", "verdict")


@query("request_methods", """
SELECT event_id, CASE WHEN upper(trim(m)) = '' THEN 'POST' WHEN upper(trim(m)) IN ('GET', 'POST', 'PUT', 'PATCH', 'DELETE')
       THEN upper(trim(m)) END AS method
FROM (SELECT event_id, CASE event_type WHEN 'click' THEN ' get ' WHEN 'view' THEN '' WHEN 'error' THEN 'trace'
             WHEN 'signup' THEN 'Patch' ELSE 'put' END AS m FROM events) s""")
def _(v):
    kind = F.col("event_type")
    given = F.when(kind == "click", " get ").when(kind == "view", "").when(kind == "error", "trace").when(
        kind == "signup", "Patch").otherwise("put")
    return v.events.select("event_id", web.normal_method(given).alias("method"))


@query("clean_headers", """
SELECT event_id, 'application/json' AS accept, CAST(user_id AS VARCHAR) AS x_user, CAST(event_id AS VARCHAR) AS x_trace,
       CAST(3 AS INT) AS headers
FROM events""")
def _(v):
    headers = F.create_map(
        F.lit("accept"), F.lit("application/json"), F.lit("x-uSER"), F.col("user_id").cast("string"),
        F.lit("HOST"), F.lit("evil.example"), F.lit("idempotency-key"), F.lit("forged"),
        F.lit("X-TRACE"), F.lit("shadowed"), F.lit("x-trace"), F.col("event_id").cast("string"),
    )
    cleaned = v.events.select("event_id", web.clean_headers(headers).alias("h"))
    return cleaned.select("event_id", F.col("h")["Accept"].alias("accept"), F.col("h")["X-User"].alias("x_user"),
                          F.col("h")["X-Trace"].alias("x_trace"), F.size("h").alias("headers"))


@query("clip_bytes", """
SELECT doc_id, strlen(text) > 4096 AS clipped, CASE WHEN strlen(text) <= 4096 THEN md5(text) END AS kept_whole
FROM documents""")
def _(v):
    text = F.col("text")
    excerpt = R.clip_bytes(text, 4096)
    return v.documents.select(
        "doc_id", R.is_clipped(text, 4096).alias("clipped"),
        F.when(F.octet_length(text) <= 4096, F.md5(excerpt)).alias("kept_whole"),
    )


@query("clip_excerpt", """
SELECT doc_id, least(strlen(text), 1000) - 3 <= strlen(text) AS bounded,
       CASE WHEN strlen(text) = length(text) THEN md5(substr(text, 1, 1000)) END AS plain_md5
FROM documents""")
def _(v):
    """Byte counts hold for every text; where every character is one byte the excerpt is a plain prefix."""
    text, excerpt = F.col("text"), R.clip_bytes(F.col("text"), 1000)
    # A character cut in half becomes a three-byte replacement mark.
    bounded = F.octet_length(excerpt).between(F.least(F.octet_length(text), F.lit(1000)) - 3, F.lit(1002))
    return v.documents.select(
        "doc_id", bounded.alias("bounded"),
        F.when(F.octet_length(text) == F.length(text), F.md5(excerpt)).alias("plain_md5"))


@query("webhook_calls", """
SELECT o_orderkey AS job_id,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN concat('https://', lower(substr(o_orderpriority, 3, 3)), '.example.com/', o_orderkey) END AS url,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'POST' WHEN '2-HIGH' THEN 'PUT' WHEN '5-LOW' THEN 'GET' END AS method,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_orderkey % 5 + 1 AS VARCHAR) END AS attempt_header,
       CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_orderkey AS VARCHAR) END AS key_header,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN 'INVALID_PAYLOAD' WHEN '4-NOT SPECIFIED' THEN 'INVALID_METHOD' END AS error_code,
       CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN false END AS retryable
FROM orders""")
def _(v):
    level, key = F.col("o_orderpriority"), F.col("o_orderkey").cast("string")
    method = F.when(level == "1-URGENT", "").when(level == "2-HIGH", " put ").when(level == "5-LOW", "get").otherwise("trace")
    payload = F.when(level == "3-MEDIUM", F.concat(F.lit('{"url":'), key)).otherwise(F.concat(
        F.lit('{"url":"https://'), F.lower(F.substring(level, 3, 3)), F.lit(".example.com/"), key, F.lit('","method":"'), method,
        F.lit('","headers":{"idempotency-key":"forged"}}')))
    jobs = v.orders.select(F.col("o_orderkey").alias("job_id"), payload.alias("payload"),
                           (F.col("o_orderkey") % 5 + 1).alias("attempt_number"))
    calls = web.webhook_calls(jobs)
    return calls.select("job_id", "url", "method", F.col("headers")["X-Scheduler-Attempt"].alias("attempt_header"),
                        F.col("headers")["Idempotency-Key"].alias("key_header"), "error_code", "retryable")


# --- intake, handlers, schema versions ----------------------------------------------------

@query("parse_requests", """
SELECT s.seq, CASE WHEN s.seq % 10 >= 6 THEN 'INVALID_JSON' END AS error, CASE WHEN s.seq % 10 < 6 THEN s.name END AS name,
       CASE WHEN s.seq % 10 < 6 THEN s.job_type END AS job_type, CASE WHEN s.seq % 10 < 6 THEN s.payload END AS payload,
       CASE WHEN s.seq % 10 < 6 THEN s.run_at END AS run_at, CASE WHEN s.seq % 10 < 6 THEN s.priority END AS priority
FROM v_submissions s""", ("v_submissions",))
def _(v):
    n = F.col("seq") % 10
    name = F.concat(F.lit('{"name":"'), F.col("name"))
    body = (
        F.when(n == 7, F.concat(name, F.lit('","colour":"red"}')))
        .when(n == 8, F.concat(name, F.lit('","priority":"high"}')))
        .when(n == 9, name)
        .when(n == 6, F.concat(name, F.lit('","run_at":"yesterday"}')))
        .otherwise(F.concat(name, F.lit('","job_type":"'), F.col("job_type"), F.lit('","payload":'), F.col("payload"),
                            F.lit(',"run_at":"1998-01-01T00:00:00Z","priority":'), F.col("priority").cast("string"), F.lit("}")))
    )
    parsed = parse_requests(v.submissions.select("seq", body.alias("body")))
    read = F.col("error").isNull()
    return parsed.select("seq", "error", *[
        F.when(read, F.col(c)).alias(c) for c in ("name", "job_type", "payload", "priority")
    ], F.when(read, F.col("run_at").cast("timestamp_ntz")).alias("run_at"))


@query("upgrade_schema", """
SELECT job_id, tenant_id, CAST(NULL AS VARCHAR) AS idempotency_key, CAST(NULL AS VARCHAR) AS request_hash,
       CAST(NULL AS VARCHAR) AS source_dead_letter_id
FROM (SELECT job_id, 1 AS tenant_id FROM v_jobs) j""", ("v_jobs",))
def _(v):
    old = downgrade(v.jobs, "jobs")
    return upgrade(old, "jobs", default_tenant=1).select(
        "job_id", "tenant_id", "idempotency_key", "request_hash", "source_dead_letter_id")


_HANDLED = """
SELECT job_id, CASE job_type WHEN 'CALL_WEBHOOK' THEN concat('{"target":"', name, '"}')
         WHEN 'SEND_EMAIL' THEN concat('{"mailed":', job_id, '}') END AS result,
       job_type IN ('CALL_WEBHOOK', 'SEND_EMAIL') AS succeeded,
       CASE WHEN job_type NOT IN ('CALL_WEBHOOK', 'SEND_EMAIL') THEN 'UNSUPPORTED_JOB_TYPE' END AS error_code,
       CASE WHEN job_type NOT IN ('CALL_WEBHOOK', 'SEND_EMAIL') THEN false END AS retryable,
       CASE WHEN job_type NOT IN ('CALL_WEBHOOK', 'SEND_EMAIL') THEN concat('unsupported job type ', job_type) END AS message
FROM v_jobs"""


@query("apply_handlers", _HANDLED, ("v_jobs",))
def _(v):
    done = handlers.apply_handlers(v.jobs, {
        "CALL_WEBHOOK": lambda jobs: F.to_json(F.struct(F.col("name").alias("target"))),
        "SEND_EMAIL": lambda jobs: F.to_json(F.struct(F.col("job_id").alias("mailed"))),
    })
    return done.select("job_id", "result", "succeeded", "error_code", "retryable", "message")


@query("apply_row_handlers", _HANDLED, ("v_jobs",))
def _(v):
    done = handlers.apply_row_handlers(v.jobs.select("job_id", "job_type", "name"), {
        "CALL_WEBHOOK": lambda row: '{"target":"%s"}' % row["name"],
        "SEND_EMAIL": lambda row: '{"mailed":%d}' % row["job_id"],
    })
    return done.select("job_id", "result", "succeeded", "error_code", "retryable", "message")
