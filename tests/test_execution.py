from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from worktide.functions import states as S
from worktide.operators import changes, deadletters, execution

NOW = "2024-05-01 10:00:00"
LATER = "2024-05-01 11:00:00"
_JOBS = ("job_id string, tenant_id int, name string, job_type string, payload string, status string, priority int, "
         "run_at timestamp_ntz, created_at timestamp_ntz, retry_count int, max_retries int, retry_backoff_seconds int, "
         "timeout_seconds int, locked_by string, locked_until timestamp_ntz")
_OUTCOMES = ("outcome_id int, job_id string, worker_id string, http_status int, retry_after string, duration_ms bigint")


def make_jobs(spark, *given):
    base = dict(tenant_id=1, name="n", job_type="CALL_WEBHOOK", payload="{}", status="PENDING", priority=5,
                run_at="2024-05-01 09:00:00", created_at="2024-05-01 08:00:00", retry_count=0, max_retries=3,
                retry_backoff_seconds=30, timeout_seconds=1, locked_by=None, locked_until=None)
    names = [part.split()[0] for part in _JOBS.split(", ")]
    made = [{**base, "job_id": f"j{i}", **job} for i, job in enumerate(given)]
    times = ("run_at", "created_at", "locked_until")
    text = _JOBS.replace("timestamp_ntz", "string")
    df = spark.createDataFrame([tuple(m[n] for n in names) for m in made], text)
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def running(spark, *given):
    defaults = dict(status="RUNNING", locked_by="w1", locked_until="2024-05-01 10:05:00")
    jobs = make_jobs(spark, *[{**defaults, **job} for job in given])
    attempts = jobs.select(F.concat(F.lit("a-"), "job_id").alias("attempt_id"), "job_id", "tenant_id",
                           F.col("locked_by").alias("worker_id"), (F.col("retry_count") + 1).alias("attempt_number"),
                           "status", F.col("run_at").alias("started_at"))
    return jobs, attempts


def outcomes(spark, *given):
    return execution.webhook_outcomes(spark.createDataFrame(list(given), _OUTCOMES))


def test_consecutive_claims_are_disjoint_and_in_order(spark):
    jobs = make_jobs(spark, *[dict(priority=i % 3) for i in range(10)])
    plan = execution.batch_plan(jobs, NOW, ["worker-a", "worker-b", "worker-c"], 5)
    taken = [(r.worker_id, r.job_id, r.priority) for r in plan.orderBy("position").collect()]
    assert [w for w, _, _ in taken] == ["worker-a"] * 5 + ["worker-b"] * 5
    assert len({j for _, j, _ in taken}) == 10
    assert [p for _, _, p in taken] == sorted([i % 3 for i in range(10)], reverse=True)


def test_top_k_is_taken_without_a_full_sort(spark):
    jobs = make_jobs(spark, {}, {})
    plan = execution.due_top_k(jobs, NOW, 5)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_start_due(spark):
    jobs = make_jobs(spark, {}, dict(status="PAUSED"), dict(retry_count=2))
    plan = spark.createDataFrame([("j0", "w1"), ("j1", "w1"), ("j2", "w2")], "job_id string, worker_id string")
    change = execution.start_due(jobs, plan, NOW, 60).materialize()
    started = {r.job_id: r for r in change.jobs.collect()}
    assert set(started) == {"j0", "j2"}
    assert all(r.status == "RUNNING" and str(r.locked_until) == "2024-05-01 10:01:00" for r in started.values())
    assert {(r.job_id, r.attempt_number, r.worker_id) for r in change.attempts.collect()} == {("j0", 1, "w1"), ("j2", 3, "w2")}
    assert {r.payload for r in change.events.collect()} == {
        '{"worker_id":"w1","attempt_number":1}', '{"worker_id":"w2","attempt_number":3}'}
    assert [r.job_id for r in change.rejects.collect()] == ["j1"]
    # Starting the same plan again changes nothing: the jobs are no longer due.
    after = changes.apply_changes(jobs, change.jobs, "job_id")
    assert after.count() == 3 and execution.start_due(after, plan, NOW, 60).jobs.count() == 0


def test_finish_success_and_conflicts(spark):
    jobs, attempts = running(spark, {}, {}, dict(status="SUCCEEDED"))
    reported = outcomes(spark, (1, "j0", "w1", 204, None, 50), (2, "j1", "w-stale", 204, None, 50),
                        (3, "j2", "w1", 204, None, 50), (4, "j0", "w1", 503, None, 70))
    change = execution.finish(jobs, attempts, reported, NOW).materialize()
    job = rows(change.jobs)
    assert [(j["job_id"], j["status"], j["locked_by"], j["locked_until"]) for j in job] == [("j0", "SUCCEEDED", None, None)]
    assert str(job[0]["completed_at"]) == NOW
    attempt = rows(change.attempts)[0]
    assert (attempt["status"], attempt["execution_duration_ms"], attempt["attempt_id"]) == ("SUCCEEDED", 50, "a-j0")
    assert [e.event_type for e in change.events.collect()] == ["job.completed"]
    assert change.dead_letters.count() == 0
    assert sorted(r.outcome_id for r in change.rejects.collect()) == [2, 3, 4]


def test_a_stale_report_does_not_shadow_the_owners(spark):
    jobs, attempts = running(spark, {})
    reported = outcomes(spark, (1, "j0", "w-stale", 400, None, 5), (2, "j0", "w1", 200, None, 5))
    change = execution.finish(jobs, attempts, reported, NOW)
    assert [j["status"] for j in rows(change.jobs)] == ["SUCCEEDED"]
    assert [r.outcome_id for r in change.rejects.collect()] == [1]


def test_a_job_without_an_open_attempt_conflicts(spark):
    jobs, attempts = running(spark, {})
    change = execution.finish(jobs, attempts.filter("false"), outcomes(spark, (1, "j0", "w1", 200, None, 5)), NOW)
    assert change.jobs.count() == 0 and change.rejects.count() == 1


_REPORTS = ("outcome_id int, job_id string, attempt_id string, worker_id string, duration_ms bigint, http_status int, retry_after string, "
            "body string, error_kind string, error_message string")


def test_reports_settle_the_attempt_they_name(spark):
    jobs, attempts = running(spark, {}, {}, {}, {})
    older = attempts.filter("job_id = 'j0'").withColumn("attempt_id", F.lit("a-older"))
    given = [(1, "j0", "a-gone", "w1", 1, 200, None, None, None, None),      # of an attempt that is not open
             (2, "j0", "a-older", "w1", 2, 503, None, "busy", None, None),   # the first that counts
             (3, "j0", "a-j0", "w1", 3, 200, None, None, None, None),
             (4, "j1", None, "w1", 4, 200, None, None, None, None),
             (5, "j1", "a-j0", "w1", 5, 200, None, None, None, None),        # another job's attempt
             (6, "j2", "a-j2", "w2", 6, 200, None, None, None, None),        # not the owner
             (7, "j3", "a-j3", "w1", 7, None, None, None, "timeout", "context deadline exceeded")]
    reports = execution.execution_outcomes(spark.createDataFrame(given, _REPORTS))
    change = execution.finish(jobs, attempts.union(older), reports, NOW).materialize()
    settled = {a["attempt_id"]: a for a in rows(change.attempts)}
    assert {k: (a["status"], a["error_code"], a["execution_duration_ms"]) for k, a in settled.items()} == {
        "a-older": ("FAILED", "WEBHOOK_HTTP_ERROR", 2), "a-j3": ("FAILED", "TIMEOUT", 7)}
    assert settled["a-older"]["result"] == '{"duration_ms":2,"response_excerpt":"busy","response_truncated":false,"status_code":503}'
    assert settled["a-j3"]["result"] is None and settled["a-j3"]["error_message"] == "context deadline exceeded"
    assert sorted(r.outcome_id for r in change.rejects.collect()) == [1, 3, 4, 5, 6]


def test_error_kinds_and_excerpts(spark):
    given = [(i, "j", "a", "w", 9, None, "60", None, kind, f"it was {kind}") for i, kind in enumerate([*S.ERROR_KINDS, "other"])]
    given += [(20, "j", "a", "w", 9, 200, None, "é" * 2049, None, None), (21, "j", "a", "w", 9, 200, None, "x" * 4096, None, None),
              (22, "j", "a", "w", 9, None, None, None, None, None)]
    found = {r.outcome_id: r for r in execution.execution_outcomes(spark.createDataFrame(given, _REPORTS)).collect()}
    for i, (code, again) in enumerate([*S.ERROR_KINDS.values(), S.OTHER_ERROR]):
        assert (found[i].succeeded, found[i].error_code, found[i].retryable, found[i].retry_after_seconds, found[i].result) == (False, code, again, 0, None)
        assert found[i].message.startswith("it was")
    long, exact = (json.loads(found[i].result) for i in (20, 21))
    assert long["response_truncated"] and long["response_excerpt"] == "é" * 2048
    assert not exact["response_truncated"] and len(exact["response_excerpt"]) == 4096
    assert (found[22].error_code, found[22].result) == ("WEBHOOK_NETWORK_ERROR", None)


def test_finish_failures(spark):
    jobs, attempts = running(spark, {}, dict(retry_count=3), {}, {})
    reported = outcomes(spark, (1, "j0", "w1", 503, None, 5), (2, "j1", "w1", 503, "60", 5), (3, "j2", "w1", 400, None, 5),
                        (4, "j3", "w1", 429, "120", 5))
    change = execution.fail(jobs, attempts, reported, NOW).materialize()
    after = {j["job_id"]: j for j in rows(change.jobs)}
    assert {k: (v["status"], v["retry_count"]) for k, v in after.items()} == {
        "j0": ("RETRY_SCHEDULED", 1), "j1": ("DEAD_LETTERED", 4), "j2": ("DEAD_LETTERED", 1), "j3": ("RETRY_SCHEDULED", 1)}
    assert str(after["j0"]["run_at"]) == "2024-05-01 10:00:30" and str(after["j3"]["run_at"]) == "2024-05-01 10:02:00"
    assert str(after["j1"]["run_at"]) == "2024-05-01 09:00:00"
    assert {d["original_job_id"]: d["final_error"] for d in rows(change.dead_letters)} == {
        "j1": "webhook returned HTTP 503", "j2": "webhook returned HTTP 400"}
    kinds = sorted((e.job_id, e.event_type) for e in change.events.collect())
    assert kinds == sorted([(j, "job.failed") for j in after] + [
        ("j0", "job.retry_scheduled"), ("j1", "job.dead_lettered"), ("j2", "job.dead_lettered"), ("j3", "job.retry_scheduled")])
    failed = {a["job_id"]: a for a in rows(change.attempts)}
    assert failed["j2"]["retryable"] is False and failed["j0"]["error_code"] == "WEBHOOK_HTTP_ERROR"
    events = change.events.select("event_id")
    assert events.distinct().count() == events.count() == 8


def test_override_ignores_the_owner(spark):
    jobs, attempts = running(spark, {}, dict(status="PENDING"))
    reported = outcomes(spark, (1, "j0", "anyone", 200, None, 5), (2, "j1", "anyone", 503, None, 5), (3, "gone", "x", 200, None, 5))
    change = execution.finish(jobs, attempts, reported, NOW, guard=False)
    assert {j["job_id"]: j["status"] for j in rows(change.jobs)} == {"j0": "SUCCEEDED", "j1": "RETRY_SCHEDULED"}
    assert [r.outcome_id for r in change.rejects.collect()] == [3]


def test_recover_expired(spark):
    jobs, attempts = running(spark, {}, dict(retry_count=3), dict(locked_until=None), dict(locked_until="2024-05-01 12:00:00"))
    change = execution.recover_expired(jobs, attempts, LATER, "lease lost")
    after = {j["job_id"]: j for j in rows(change.jobs)}
    assert {k: (v["status"], v["retry_count"], v["last_error"]) for k, v in after.items()} == {
        "j0": ("RETRY_SCHEDULED", 1, "lease lost"), "j1": ("DEAD_LETTERED", 4, "lease lost")}
    assert {a["attempt_id"]: (a["status"], a["error_code"], a["retryable"]) for a in rows(change.attempts)} == {
        "a-j0": ("FAILED", "LEASE_EXPIRED", True), "a-j1": ("FAILED", "LEASE_EXPIRED", True)}
    assert [d["original_job_id"] for d in rows(change.dead_letters)] == ["j1"]
    told = {e.job_id: (e.event_type, e.source, e.payload) for e in change.events.collect()}
    assert told["j1"] == ("job.dead_lettered", "recovery", '{"reason":"lease lost","retry_count":4}')
    assert told["j0"][0] == "job.retry_scheduled" and '"next_run_at"' in told["j0"][2]
    # A second pass finds nothing.
    again = changes.apply_changes(jobs, change.jobs, "job_id")
    assert execution.recover_expired(again, attempts, LATER, "x").jobs.count() == 0


def test_every_change_is_an_allowed_move_and_nothing_is_lost(spark):
    jobs, attempts = running(spark, *[dict(retry_count=i % 5) for i in range(40)])
    codes = [200, 503, 429, 400, 204]
    given = [(i, f"j{i % 45}", "w1" if i % 7 else "w-stale", codes[i % 5], "9", i) for i in range(60)]
    change = execution.finish(jobs, attempts, outcomes(spark, *given), NOW).materialize()
    before = {r.job_id: r.status for r in jobs.collect()}
    after = change.jobs.collect()
    assert all(S.may_move(before[r.job_id], r.status) for r in after)
    assert len(after) + change.rejects.count() == 60
    snapshot = changes.apply_change_set({"jobs": jobs, "attempts": attempts}, change)
    assert snapshot["jobs"].count() == 40 and snapshot["attempts"].count() == 40
    # Reporting the same batch again changes nothing.
    again = execution.finish(snapshot["jobs"], snapshot["attempts"], outcomes(spark, *given), NOW)
    assert again.jobs.count() == 0 and again.rejects.count() == 60


def test_extend_and_release(spark):
    jobs, attempts = running(spark, {}, {})
    renewals = spark.createDataFrame(
        [("j0", "w1", "2024-05-01 10:00:00"), ("j0", "w1", "2024-05-01 10:00:20"), ("j1", "w2", "2024-05-01 10:00:00")],
        "job_id string, worker_id string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    # The lease runs until 10:05: a renewal that would end before that does not shorten it.
    for ttl, until in ((60, "2024-05-01 10:05:00"), (600, "2024-05-01 10:10:20")):
        change = execution.extend_leases(jobs, renewals, ttl)
        assert [(j["job_id"], str(j["locked_until"])) for j in rows(change.jobs)] == [("j0", until)]
    assert [r.job_id for r in change.rejects.collect()] == ["j1"]
    asked = spark.createDataFrame([(1, "j0", "w1"), (2, "j1", "w2")], "release_id int, job_id string, worker_id string")
    given_back = execution.release(jobs, asked, NOW)
    assert [(j["job_id"], j["status"], j["locked_by"]) for j in rows(given_back.jobs)] == [("j0", "RETRY_SCHEDULED", None)]
    with pytest.raises(ValueError):
        execution.release(jobs, asked, NOW, "SUCCEEDED")


def test_a_released_attempt_stays_open_and_the_next_claim_reuses_its_number(spark):
    from worktide.operators.audit import attempt_sequence

    jobs, attempts = running(spark, {})
    asked = spark.createDataFrame([(1, "j0", "w1")], "release_id int, job_id string, worker_id string")
    released = changes.apply_changes(jobs, execution.release(jobs, asked, NOW).jobs, "job_id")
    plan = spark.createDataFrame([("j0", "w2")], "job_id string, worker_id string")
    opened = execution.start_due(released, plan, LATER, 60).attempts
    both = attempts.unionByName(opened, allowMissingColumns=True)
    found = attempt_sequence(both).first()
    assert (found.open_attempts, found.repeated_numbers, found.in_order) == (2, 1, False)


def test_requeue_once_with_standard_settings(spark):
    letters = spark.createDataFrame(
        [("d1", "j1", 1, "n", "CALL_WEBHOOK", "{}", "boom", 9, None), ("d2", "j2", 1, "n", "CALL_WEBHOOK", "{}", "boom", 9, NOW)],
        "dead_letter_id string, original_job_id string, tenant_id int, name string, job_type string, payload string, "
        "final_error string, retry_count int, requeued_at string",
    ).withColumns({"failed_at": F.lit(NOW).cast("timestamp_ntz"), "requeued_at": F.col("requeued_at").cast("timestamp_ntz")})
    asked = spark.createDataFrame([(1, "d1"), (1, "d1"), (1, "d2"), (2, "d1")], "tenant_id int, dead_letter_id string")
    change = deadletters.requeue(letters, asked, LATER)
    job = rows(change.jobs)
    assert len(job) == 1
    assert (job[0]["status"], job[0]["priority"], job[0]["max_retries"], job[0]["retry_backoff_seconds"], job[0]["retry_count"],
            job[0]["timeout_seconds"], job[0]["source_dead_letter_id"]) == ("PENDING", 5, 3, 30, 0, 300, "d1")
    letter = rows(change.dead_letters)[0]
    assert letter["requeued_job_id"] == job[0]["job_id"] and str(letter["requeued_at"]) == LATER
    assert sorted((r.tenant_id, r.dead_letter_id) for r in change.rejects.collect()) == [(1, "d2"), (2, "d1")]
    again = deadletters.requeue(changes.apply_changes(letters, change.dead_letters, "dead_letter_id"), asked, LATER)
    assert again.jobs.count() == 0


def test_observed_counts(spark):
    from pyspark.sql import Observation

    jobs, attempts = running(spark, {}, {})
    seen = Observation()
    execution.finish(jobs, attempts, outcomes(spark, (1, "j0", "w1", 200, None, 5)), NOW).observe(seen).jobs.collect()
    assert seen.get["accepted"] == 1
