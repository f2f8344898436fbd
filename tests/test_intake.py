"""Requests: parsing, validation, idempotency; API access; webhook targets; handlers."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import web
from worktide.operators import access, handlers, submit
from worktide.sources import intake

NOW = "2024-05-01 10:00:00"
_FIELDS = ("seq int, tenant_id int, idempotency_key string, name string, job_type string, payload string, run_at string, "
           "priority int, max_retries int, retry_backoff_seconds int, timeout_seconds int")


def requests(spark, *given):
    base = dict(tenant_id=1, idempotency_key=None, name="n", job_type="CALL_WEBHOOK", payload='{"url":"https://example.com"}',
                run_at="2024-05-01 10:01:00", priority=0, max_retries=0, retry_backoff_seconds=0, timeout_seconds=0)
    names = [p.split()[0] for p in _FIELDS.split(", ")]
    made = [tuple({**base, "seq": i, **g}[n] for n in names) for i, g in enumerate(given)]
    return spark.createDataFrame(made, _FIELDS).withColumn("run_at", F.col("run_at").cast("timestamp_ntz"))


def test_defaults_and_initial_status(spark):
    made = rows(submit.submit(requests(spark, {}, dict(run_at=NOW)), None, NOW).jobs, "run_at")
    assert [(j["status"], j["priority"], j["max_retries"], j["retry_backoff_seconds"], j["timeout_seconds"]) for j in made] == [
        ("PENDING", 5, 3, 30, 300), ("SCHEDULED", 5, 3, 30, 300)]


@pytest.mark.parametrize("broken, message", [
    (dict(name="   "), "name is required"), (dict(name=None), "name is required"),
    (dict(job_type="UNKNOWN"), "unsupported job type"), (dict(job_type=None), "unsupported job type"),
    (dict(payload=None), "payload must be valid JSON"), (dict(payload="{"), "payload must be valid JSON"),
    (dict(payload="null"), "payload must be valid JSON"), (dict(run_at=None), "run_at is required"),
    (dict(priority=11), "priority must be between 0 and 10"), (dict(priority=-1), "priority must be between 0 and 10"),
    (dict(max_retries=-1), "max_retries must not be negative"),
    (dict(retry_backoff_seconds=-1), "retry_backoff_seconds must not be negative"),
    (dict(timeout_seconds=-1), "timeout_seconds must not be negative"),
    (dict(idempotency_key="é" * 128, name=""), "Idempotency-Key exceeds 255 characters"),
    (dict(name="", job_type="UNKNOWN"), "name is required"), (dict(), None), (dict(priority=10), None),
])
def test_first_broken_rule(spark, broken, message):
    assert R.with_defaults(requests(spark, broken)).select(R.validation_error().alias("e")).first().e == message


def test_idempotency(spark):
    given = requests(
        spark, dict(idempotency_key="k"), dict(idempotency_key=" k "), dict(idempotency_key="k", priority=9),
        dict(idempotency_key="k", tenant_id=2), {}, {}, dict(idempotency_key="  "),
        dict(idempotency_key="late", name=""), dict(idempotency_key="late"), dict(idempotency_key="k", priority=5))
    change = submit.submit(given, None, NOW)
    got = {r.seq: r for r in change.decisions.collect()}
    assert {s: r.outcome for s, r in got.items()} == {
        0: "CREATED", 1: "REPLAYED", 2: "CONFLICT", 3: "CREATED", 4: "CREATED", 5: "CREATED", 6: "CREATED", 7: "INVALID",
        8: "CREATED", 9: "REPLAYED"}
    assert got[1].job_id == got[0].job_id == got[9].job_id and got[2].job_id is None
    made = change.jobs.select("job_id")
    assert made.distinct().count() == made.count() == 6
    assert change.events.count() == 6 and {r.event_type for r in change.events.collect()} == {"job.created"}
    assert {r.seq: r.reason for r in change.rejects.collect()} == {
        2: "idempotency key was used for a different request", 7: "name is required"}


def test_stored_keys_win(spark):
    given = requests(spark, dict(idempotency_key="k"), dict(idempotency_key="k", priority=1))
    stored = submit.submit(given.filter("seq = 1"), None, NOW).jobs
    later = {r.seq: (r.outcome, r.job_id) for r in submit.judge_requests(given, stored, "2024-05-02 00:00:00").collect()}
    assert later[0] == ("CONFLICT", None) and later[1] == ("REPLAYED", stored.first().job_id)


def test_a_key_shared_by_most_requests(spark):
    given = requests(spark, *[dict(idempotency_key="hot", priority=1 + i % 2) for i in range(300)],
                     *[dict(idempotency_key=f"k{i}") for i in range(50)], *[{} for _ in range(50)])
    got = submit.judge_requests(given, None, NOW).groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in got} == {"CREATED": 101, "REPLAYED": 149, "CONFLICT": 150}


@pytest.mark.parametrize("body, error", [
    ('{"name":"a","job_type":"CALL_WEBHOOK","payload":{"url":"x"},"run_at":"2024-05-01T10:00:00Z"}', None),
    ('{"name":"a","run_at":"2024-05-01T12:00:00.5+02:00"}', None), ("{}", None),
    ('{"name":"a","colour":"red"}', "INVALID_JSON"), ('{"name":"a"', "INVALID_JSON"), ("[1]", "INVALID_JSON"),
    ('{"name":5}', "INVALID_JSON"), ('{"job_type":["a"]}', "INVALID_JSON"), ('{"name":null}', None),
    ('{"priority":"high"}', "INVALID_JSON"), ('{"priority":1.5}', "INVALID_JSON"), ('{"run_at":"2024-05-01"}', "INVALID_JSON"),
    ('{"run_at":"2024-13-01T00:00:00Z"}', "INVALID_JSON"), ("", "INVALID_JSON"), (None, "INVALID_JSON"),
])
def test_parse_requests(spark, body, error):
    df = spark.createDataFrame([(1, body)], "id int, body string")
    parsed = intake.parse_requests(df)
    assert parsed.first().error == error
    assert intake.accepted(parsed).count() == (error is None) and intake.quarantine(parsed, "id").count() == (error is not None)


def test_parse_keeps_payload_order_and_limits_size(spark):
    body = '{"payload": {"b": 1, "a": [true, null]}, "run_at": "2024-05-01T12:00:00+02:00"}'
    df = spark.createDataFrame([(body,), ('{"name":"' + "x" * (1 << 20) + '"}',)], "body string")
    small, large = intake.parse_requests(df).orderBy(F.length("body")).collect()
    assert small.payload == '{"b":1,"a":[true,null]}' and str(small.run_at) == "2024-05-01 10:00:00" and small.priority == 0
    assert large.error == "INVALID_JSON"


def _clients(spark):
    df = spark.createDataFrame([(1, 10, "a", "key-a", "admin", True, False), (2, 10, "b", "key-b", "viewer", True, False),
                                (3, 10, "c", "key-c", "admin", False, False), (4, 10, "d", "key-d", "admin", True, True),
                                (5, 99, "e", "key-e", "admin", True, False)],
                               "client_id int, tenant_id int, name string, api_key string, role string, enabled boolean, revoked boolean")
    return access.digest_clients(df)


def test_principals(spark):
    tenants = spark.createDataFrame([(10, "ten")], "tenant_id int, slug string")
    asked = spark.createDataFrame([(i, k, role) for i, (k, role) in enumerate([
        (" key-a ", "admin"), ("key-b", "viewer"), ("key-b", "operator"), ("key-c", "viewer"), ("key-d", "viewer"),
        ("key-e", "viewer"), ("nope", "viewer"), ("key-a", "king")])], "request_id int, api_key string, required_role string")
    found = {r.request_id: r.access for r in access.resolve_principals(asked, _clients(spark), tenants).collect()}
    assert found == {0: "OK", 1: "OK", 2: "FORBIDDEN", 7: "FORBIDDEN"}
    assert sorted(r.request_id for r in access.unauthorized(asked, _clients(spark), tenants).collect()) == [3, 4, 5, 6]


def test_register_and_revoke(spark):
    asked = spark.createDataFrame([(1, 10, "x", "new", "viewer"), (2, 10, "y", " new ", "admin"), (3, 10, "z", "key-a", "admin"),
                                   (4, 10, "q", "other", "king")],
                                  "registration_id int, tenant_id int, name string, api_key string, role string")
    made = {r.registration_id: r for r in access.register_clients(asked, _clients(spark), NOW).collect()}
    assert made[1].is_new and not made[2].is_new and made[1].client_id == made[2].client_id
    assert made[3].client_id == "1" and not made[3].is_new and made[4].error == "unknown role" and made[4].client_id is None
    changed, missing = access.revoke_clients(_clients(spark), spark.createDataFrame([(1,), (1,), (77,)], "client_id int"), NOW)
    assert [(r.client_id, r.enabled, str(r.revoked_at)) for r in changed.collect()] == [(1, False, NOW)]
    assert [r.client_id for r in missing.collect()] == [77]


@pytest.mark.parametrize("url, verdict", [
    ("http://127.0.0.1/internal", "UNSAFE_WEBHOOK_TARGET"), ("HTTPS://[::1]:80/x", "UNSAFE_WEBHOOK_TARGET"),
    ("http://[::ffff:7f00:1]/", "UNSAFE_WEBHOOK_TARGET"), ("http://[::ffff:10.1.2.3]/", "UNSAFE_WEBHOOK_TARGET"),
    ("http://[fd00::1]", "UNSAFE_WEBHOOK_TARGET"), ("http://[fe80::1%25eth0]/", "UNSAFE_WEBHOOK_TARGET"),
    ("http://[ff02::1]/", "UNSAFE_WEBHOOK_TARGET"), ("http://0.0.0.0", "UNSAFE_WEBHOOK_TARGET"),
    ("http://172.31.0.1", "UNSAFE_WEBHOOK_TARGET"), ("http://172.32.0.1", "SAFE"), ("http://[2001:db8::1]/", "SAFE"),
    ("http://8.8.8.8:8080/", "SAFE"), ("https://a_b.example.com/x y", "UNRESOLVED"), ("http://010.0.0.1/", "UNRESOLVED"),
    ("ftp://example.com", "UNSAFE_WEBHOOK_TARGET"), ("http://u:p@example.org", "UNSAFE_WEBHOOK_TARGET"),
    ("http://", "UNSAFE_WEBHOOK_TARGET"), (None, "UNSAFE_WEBHOOK_TARGET"), ("http://h:8x/", "INVALID_URL"),
    ("http://h/%zz", "INVALID_URL"), (":x", "INVALID_URL"), ("http://Example.com/", "ALLOWED"), ("http://10.0.0.9/", "ALLOWED"),
])
def test_targets(spark, url, verdict):
    df = spark.createDataFrame([(url,)], "url string")
    assert web.classify_targets(df, [" EXAMPLE.com ", "10.0.0.9"]).first().verdict == verdict


def test_private_targets_can_be_allowed(spark):
    df = spark.createDataFrame([("http://127.0.0.1/",)], "url string")
    assert web.classify_targets(df, allow_private=True).first().verdict == "SAFE"


def test_headers_and_methods(spark):
    df = spark.createDataFrame([({"x-a": "1", "X-A": "2", "host": "h", "content-LENGTH": "3", "bad name": "v",
                                  "x-scheduler-job-id": "f", "accept": "j"},), (None,), ({},)], "h map<string,string>")
    cleaned = [r.x for r in df.select(web.clean_headers(F.col("h")).alias("x")).collect()]
    assert cleaned == [{"X-A": "1", "bad name": "v", "Accept": "j"}, None, {}]
    names = [(" get ", "GET"), ("", "POST"), (None, "POST"), ("trace", None), ("Delete", "DELETE")]
    for given, wanted in names:
        assert spark.range(1).select(web.normal_method(F.lit(given).cast("string")).alias("m")).first().m == wanted


def test_webhook_calls(spark):
    payloads = ['{"url":"https://h.example/","headers":{"x-scheduler-attempt":"7","accept":"a"},"body":{"b":1}}',
                '{"url":"https://h.example/","method":"patch","headers":{"content-type":"text/plain"}}', "{", None,
                '{"url":"http://127.0.0.1/internal"}', '{"url":"https://h.example/","method":"trace"}', '{"url":"http://h:x/"}']
    df = spark.createDataFrame(list(enumerate(payloads)), "job_id int, payload string").withColumn("attempt_number", F.lit(2))
    got = {r.job_id: r for r in web.webhook_calls(df).collect()}
    assert {k: r.error_code for k, r in got.items()} == {
        0: None, 1: None, 2: "INVALID_PAYLOAD", 3: "INVALID_PAYLOAD", 4: "UNSAFE_WEBHOOK_TARGET", 5: "INVALID_METHOD", 6: "INVALID_URL"}
    assert got[0].headers == {"X-Scheduler-Job-Id": "0", "X-Scheduler-Attempt": "2", "Idempotency-Key": "0", "Accept": "a",
                              "Content-Type": "application/json"}
    assert (got[0].method, got[0].body) == ("POST", '{"b":1}') and (got[1].method, got[1].headers["Content-Type"]) == ("PATCH", "text/plain")
    assert got[4].retryable is False and got[0].retryable is None


def test_row_handlers_classify_their_errors(spark):
    def handle(row):
        if row["n"] == 0:
            return '{"ok":true}'
        if row["n"] == 1:
            raise handlers.HandlerError("BROKEN", "no use", False, 9)
        if row["n"] == 2:
            raise TimeoutError("too slow")
        raise KeyError("lost")

    df = spark.createDataFrame([(i, "CALL_WEBHOOK") for i in range(4)] + [(9, "OTHER")], "n int, job_type string")
    got = {r.n: r for r in handlers.apply_row_handlers(df, {"CALL_WEBHOOK": handle}).collect()}
    assert {n: (r.succeeded, r.error_code, r.retryable) for n, r in got.items()} == {
        0: (True, None, None), 1: (False, "BROKEN", False), 2: (False, "TIMEOUT", True), 3: (False, "HANDLER_ERROR", True),
        9: (False, "UNSUPPORTED_JOB_TYPE", False)}
    assert got[1].retry_after_seconds == 9 and got[0].result == '{"ok":true}'
