"""Ordered folds against plain loops, with keys cut into many chunks."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from worktide.functions import states as S
from worktide.operators.audit import transition_audit
from worktide.operators.commands import apply_commands, judge_commands, judge_single_commands
from worktide.operators.leases import lease_expiries, worker_sessions
from worktide.operators.limits import BucketFold, rate_limit
from worktide.operators.audit import overlapping_attempts
from worktide.operators.ordered import with_earlier


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 6), st.sampled_from([5, 60, 1000]), st.lists(st.integers(0, 900), min_size=1, max_size=40),
       st.data())
def test_bucket_summary_equals_the_loop(capacity, period, gaps, data):
    fold, clock, times = BucketFold(capacity, period), 0, []
    for gap in gaps:
        clock += gap
        times.append((clock,))
    summary = fold.unknown()
    for row in times:
        summary = fold.extend(summary, row)
    state = [data.draw(st.integers(0, capacity * period)), -data.draw(st.integers(0, 2 * period))]
    expected = state
    for row in times:
        expected, _ = fold.step(expected, row)
    assert fold.resolve(summary, state) == expected


def test_bucket_summary_stays_small():
    fold, summary = BucketFold(120, 60_000_000), BucketFold(120, 60_000_000).unknown()
    clock, longest = 0, 0
    random.seed(3)
    for _ in range(3000):
        clock += random.randint(0, 900_000)
        summary = fold.extend(summary, (clock,))
        longest = max(longest, len(summary["pieces"]))
    assert longest < 300


def _hot(count, others, seed):
    """A hot key with most of the rows among small ones."""
    random.seed(seed)
    return ["hot"] * count + [f"k{i}" for i in range(others) for _ in range(2)]


def test_rate_limit_with_a_hot_client_in_many_chunks(spark):
    clock, data = 0, []
    for i, client in enumerate(_hot(600, 30, 1)):
        clock += random.randint(0, 400_000)
        data.append((i, client, clock))
    df = spark.createDataFrame(data, "request_id int, client_id string, us bigint").withColumn("ts", F.timestamp_micros("us"))
    limited = rate_limit(df, 10, 2, chunks=16)
    got = {r.request_id: (r.allowed, r.units_left) for r in limited.collect()}
    fold, levels, expected = BucketFold(10, 2_000_000), {}, {}
    for request, client, us in data:
        state = levels.get(client) or fold.start((us,))
        levels[client], expected[request] = fold.step(state, (us,))
    assert got == expected and {a for a, _ in got.values()} == {True, False}


def test_one_per_minute(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 1_000_000), (3, "a", 61_000_000)], "request_id int, client_id string, us bigint")
    limited = rate_limit(df.withColumn("ts", F.timestamp_micros("us")), capacity=1)
    assert [r.allowed for r in limited.orderBy("request_id").collect()] == [True, False, True]


def test_previous_value_across_chunks(spark):
    data = [(k, i, f"v{i}") for i, k in enumerate(_hot(300, 20, 2))]
    df = spark.createDataFrame(data, "k string, i int, v string")
    got = {r.i: r.before for r in with_earlier(df, "k", ["i"], F.col("v"), "before", chunks=12).collect()}
    last, expected = {}, {}
    for k, i, v in data:
        expected[i], last[k] = last.get(k), v
    assert got == expected


def test_largest_earlier_value_across_chunks(spark):
    data = [(k, i, i * 7919 % 1000) for i, k in enumerate(_hot(300, 20, 2))]
    df = spark.createDataFrame(data, "k string, i int, v int")
    got = {r.i: r.before for r in with_earlier(df, "k", ["i"], F.col("v"), "before", largest=True, chunks=12).collect()}
    most, expected = {}, {}
    for k, i, v in data:
        expected[i], most[k] = most.get(k), max(v, most.get(k, v))
    assert got == expected


def test_overlaps_with_equal_and_missing_numbers(spark):
    data = [("a1", "j", 1, 0, 10_000), ("a2", "j", 1, 5, 100), ("a3", "j", 4, 6, 100), ("a4", "j", 5, 11, 100), ("b1", "k", 1, 5, 100)]
    df = spark.createDataFrame(data, "attempt_id string, job_id string, attempt_number int, s bigint, duration_ms bigint").withColumn(
        "started_at", F.timestamp_seconds("s").cast("timestamp_ntz"))
    assert {r.attempt_id for r in overlapping_attempts(df).collect()} == {"a2", "a3"}


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), ("x", 3, "c")], "k string, i int, v string")
    got = {r.i: r.before for r in with_earlier(df, "k", ["i"], F.col("v"), "before").collect()}
    assert got == {1: None, 2: "a", 3: None}


def _jobs(spark, *statuses):
    return spark.createDataFrame([(f"j{i}", 1, s, 5) for i, s in enumerate(statuses)],
                                 "job_id string, tenant_id int, status string, priority int").withColumns({
        "run_at": F.lit("2024-01-01").cast("timestamp_ntz"), "locked_by": F.lit(None).cast("string"),
        "locked_until": F.lit(None).cast("timestamp_ntz")})


def _attempts(spark):
    return spark.createDataFrame([("a3", "j3", 1, "w", 1, "RUNNING")],
                                 "attempt_id string, job_id string, tenant_id int, worker_id string, attempt_number int, status string")


def _commands(spark, data):
    return spark.createDataFrame(data, "command_id int, job_id string, command string").withColumn(
        "issued_at", F.timestamp_seconds("command_id").cast("timestamp_ntz"))


def test_command_series_equals_the_loop_for_a_hot_job(spark):
    random.seed(5)
    jobs = _jobs(spark, *S.STATUSES)
    kinds = ["pause", "resume", "pause", "resume", "retry"]
    data = [(i, "j0" if i % 10 else f"j{random.randint(0, 9)}", random.choice(kinds)) for i in range(500)]
    data += [(500, "j0", "cancel"), (501, "j0", "resume")]
    judged = {r.command_id: (r.status_before, r.status_after) for r in judge_commands(jobs, _commands(spark, data)).collect()}
    status = {f"j{i}": s for i, s in enumerate(S.STATUSES)}
    for number, job, command in data:
        after = S.obey(command, status.get(job))
        assert judged[number] == (status.get(job), after)
        status[job] = after or status.get(job)


def test_single_commands_agree_with_the_general_form(spark):
    jobs = _jobs(spark, *S.STATUSES)
    for command in S.COMMANDS:
        given_commands = _commands(spark, [(i, f"j{i}", command) for i in range(len(S.STATUSES))])
        one = {r.command_id: (r.status_before, r.status_after) for r in judge_single_commands(jobs, given_commands).collect()}
        many = {r.command_id: (r.status_before, r.status_after) for r in judge_commands(jobs, given_commands).collect()}
        assert one == many


def test_apply_commands(spark):
    jobs = _jobs(spark, "PENDING", "SUCCEEDED", "RETRY_SCHEDULED", "RUNNING", "PAUSED", "FAILED", "DEAD_LETTERED")
    change = apply_commands(jobs, _attempts(spark), _commands(spark, [
        (1, "j0", "cancel"), (2, "j1", "cancel"), (3, "j2", "pause"), (4, "j3", "cancel"), (5, "j4", "resume"),
        (6, "j5", "retry"), (7, "j6", "retry"), (8, "nobody", "cancel"), (9, "j4", "pause"), (10, "j0", "resume"),
    ]), "2024-06-01 00:00:00").materialize()
    assert {r.job_id: r.status for r in change.jobs.collect()} == {
        "j0": "CANCELLED", "j3": "CANCELLED", "j4": "PAUSED", "j5": "RETRY_SCHEDULED"}
    assert {r.command_id: r.reason for r in change.rejects.collect()} == {
        2: "cannot transition SUCCEEDED to CANCELLED", 3: "cannot transition RETRY_SCHEDULED to PAUSED",
        7: "cannot transition DEAD_LETTERED to RETRY_SCHEDULED", 8: "NOT_FOUND", 10: "cannot transition CANCELLED to SCHEDULED"}
    attempt = change.attempts.first()
    assert (attempt.status, attempt.error_code, attempt.error_message, attempt.retryable) == (
        "CANCELLED", "CANCELLED", "cancelled by operator", False)
    assert sorted(r.event_type for r in change.events.collect()) == [
        "job.cancelled", "job.cancelled", "job.paused", "job.retry_scheduled", "job.scheduled"]


def test_commands_respect_tenants(spark):
    given_commands = _commands(spark, [(1, "j0", "cancel")]).withColumn("tenant_id", F.lit(2))
    change = apply_commands(_jobs(spark, "PENDING"), _attempts(spark), given_commands, "2024-06-01 00:00:00")
    assert change.jobs.count() == 0 and change.rejects.first().reason == "NOT_FOUND"


def test_transition_audit_flags_forbidden_moves(spark):
    kinds = ["job.created", "job.started", "job.completed", "job.started", "job.unknown", "job.created"]
    df = spark.createDataFrame([(i, "j", k) for i, k in enumerate(kinds)], "event_id int, job_id string, event_type string")
    found = transition_audit(df.withColumn("created_at", F.timestamp_seconds("event_id"))).orderBy("event_id").collect()
    assert [(r.event_id, r.previous_status, r.allowed) for r in found] == [
        (0, None, True), (1, "PENDING", True), (2, "RUNNING", True), (3, "SUCCEEDED", False), (5, "RUNNING", False)]


def _signals(spark, data):
    return spark.createDataFrame(data, "job_id string, s bigint, alive boolean, signal_id int").withColumn(
        "ts", F.timestamp_seconds("s"))


def test_lease_expiry(spark):
    df = _signals(spark, [("a", 0, True, 1), ("a", 10, True, 2), ("a", 31, True, 3), ("a", 35, False, 4),
                          ("b", 0, True, 5), ("b", 20, True, 6), ("c", 0, False, 7)])
    found = {(r.job_id, r.expired_at.timestamp()) for r in lease_expiries(df, 20, "1970-01-01 00:00:41").collect()}
    assert {(job, int(when)) for job, when in found} == {("a", 30), ("b", 40)}
    assert lease_expiries(df, 20, "1970-01-01 00:00:40").count() == 1


def test_sessions_split_only_beyond_the_ttl(spark):
    beats = spark.createDataFrame([("w", s) for s in (0, 5, 30, 60, 91, 91, 92)] + [("v", 7)], "worker_id string, s bigint")
    found = worker_sessions(beats.withColumn("ts", F.timestamp_seconds("s")), 30).collect()
    spans = sorted((r.worker_id, int(r.session_start.timestamp()), int(r.session_end.timestamp()), r.heartbeats) for r in found)
    assert spans == [("v", 7, 37, 1), ("w", 0, 90, 4), ("w", 91, 122, 3)]
