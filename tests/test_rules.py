from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S

NOW = "2024-05-01 10:00:00"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def at(seconds):
    return datetime.datetime(2024, 5, 1, 10) + datetime.timedelta(seconds=seconds)


@pytest.mark.parametrize("before, after, allowed", [
    ("PENDING", "RUNNING", True), ("SCHEDULED", "PAUSED", True), ("RUNNING", "SUCCEEDED", True),
    ("RUNNING", "RETRY_SCHEDULED", True), ("PAUSED", "SCHEDULED", True), ("FAILED", "RETRY_SCHEDULED", True),
    ("DEAD_LETTERED", "RETRY_SCHEDULED", True), ("SUCCEEDED", "RUNNING", False), ("PENDING", "SUCCEEDED", False),
    ("CANCELLED", "PENDING", False), ("PAUSED", "RUNNING", False), ("nonsense", "RUNNING", False),
])
def test_moves(spark, before, after, allowed):
    assert one(spark, R.can_move(F.lit(before), F.lit(after))) is allowed
    assert S.may_move(before, after) is allowed


def test_eighteen_moves():
    assert sum(len(ends) for ends in S.MOVES.values()) == 18


@pytest.mark.parametrize("retry_count, max_retries, retryable, wait, expected", [
    (1, 3, True, 0, ("RETRY_SCHEDULED", 2, at(60))),
    (3, 3, True, 0, ("DEAD_LETTERED", 4, None)),
    (0, 3, False, 0, ("DEAD_LETTERED", 1, None)),       # permanent errors go straight to the dead letters
    (0, 3, True, 120, ("RETRY_SCHEDULED", 1, at(120))),  # Retry-After replaces the backoff
    (3, 3, True, 120, ("DEAD_LETTERED", 4, None)),
])
def test_failure_decision(spark, retry_count, max_retries, retryable, wait, expected):
    df = spark.createDataFrame([(retry_count, max_retries, 30, retryable, wait)],
                               "retry_count int, max_retries int, retry_backoff_seconds int, ok boolean, wait int")
    decided = df.select(R.decide_failure(R.instant(NOW), F.col("ok"), F.col("wait")).alias("d")).first().d
    assert (decided.status, decided.retry_count, decided.run_at) == expected


@pytest.mark.parametrize("base, attempt, seconds", [
    (30, 3, 120), (30, 1, 30), (0, 1, 30), (-5, 2, 60), (30, 0, 30), (30, -4, 30), (30, 500, S.BACKOFF_CEILING_SECONDS),
])
def test_backoff(spark, base, attempt, seconds):
    assert one(spark, R.backoff_seconds(F.lit(base), F.lit(attempt))) == seconds


@pytest.mark.parametrize("header, seconds", [
    ("120", 120), (" 120 ", 120), ("5000", 900), ("-3", 0), ("soon", 0), ("", 0), (None, 0), ("1.5", 0),
    ("99999999999999999999999", 0), ("+7", 7),
])
def test_retry_after(spark, header, seconds):
    assert one(spark, R.retry_after_seconds(F.lit(header).cast("string"))) == seconds


@pytest.mark.parametrize("status, succeeded, retryable", [
    (200, True, None), (204, True, None), (299, True, None), (301, False, False), (400, False, False), (404, False, False),
    (408, False, True), (429, False, True), (500, False, True), (503, False, True),
])
def test_http_outcome(spark, status, succeeded, retryable):
    outcome = one(spark, R.http_outcome(F.lit(status), F.lit("5")))
    assert (outcome.succeeded, outcome.retryable) == (succeeded, retryable)
    assert outcome.message == (None if succeeded else f"webhook returned HTTP {status}")


@pytest.mark.parametrize("kind, expected", [
    ("typed", ("BROKEN", False)), ("timeout", ("TIMEOUT", True)), ("cancelled", ("CANCELLED", True)),
    ("other", ("HANDLER_ERROR", True)), (None, ("HANDLER_ERROR", True)),
])
def test_error_classes(spark, kind, expected):
    verdict = one(spark, R.classify_error(F.lit(kind).cast("string"), F.lit("BROKEN"), F.lit(False), F.lit("m")))
    assert (verdict.error_code, verdict.retryable) == expected


def test_leases_are_strict_and_due_times_are_not(spark):
    df = spark.sql(f"""SELECT * FROM VALUES
        (1, 'PENDING', TIMESTAMP_NTZ '{NOW}', CAST(NULL AS TIMESTAMP_NTZ)),
        (2, 'PENDING', TIMESTAMP_NTZ '{NOW}', TIMESTAMP_NTZ '{NOW}'),
        (3, 'SCHEDULED', TIMESTAMP_NTZ '2024-05-01 10:00:01', NULL),
        (4, 'RETRY_SCHEDULED', TIMESTAMP_NTZ '2024-05-01 09:00:00', TIMESTAMP_NTZ '2024-05-01 09:59:59'),
        (5, 'RUNNING', TIMESTAMP_NTZ '2024-05-01 09:00:00', TIMESTAMP_NTZ '{NOW}'),
        (6, 'RUNNING', TIMESTAMP_NTZ '2024-05-01 09:00:00', NULL),
        (7, 'RUNNING', TIMESTAMP_NTZ '2024-05-01 09:00:00', TIMESTAMP_NTZ '2024-05-01 09:59:59')
        AS t(id, status, run_at, locked_until)""")
    now = R.instant(NOW)
    assert [r.id for r in df.filter(R.is_due(now)).orderBy("id").collect()] == [1, 4]
    assert [r.id for r in df.filter(R.is_expired(now)).collect()] == [7]


def test_publish_delay(spark):
    assert [one(spark, R.publish_delay_seconds(F.lit(n))) for n in (0, 1, 5, 8, 9, 2000)] == [1, 2, 32, 256, 300, 300]


def test_clip_bytes_never_breaks_a_text(spark):
    assert one(spark, R.clip_bytes(F.lit("abc"), 3)) == "abc"
    assert one(spark, R.clip_bytes(F.lit("abcd"), 3)) == "abc"
    assert one(spark, R.clip_bytes(F.lit("aé日"), 3)) == "aé"
    assert one(spark, R.clip_bytes(F.lit("aé日"), 2)).startswith("a")
    assert one(spark, R.is_clipped(F.lit("日"), 2)) is True


@pytest.mark.parametrize("role, required, allowed", [
    ("admin", "operator", True), ("operator", "operator", True), ("operator", "viewer", True), ("viewer", "operator", False),
    ("stranger", "viewer", False), ("admin", "stranger", False),
])
def test_roles(spark, role, required, allowed):
    assert one(spark, R.role_allows(F.lit(role), F.lit(required))) is allowed


def test_key_digest_is_stable_and_hides_the_key(spark):
    digest = one(spark, R.key_digest(F.lit(" sk_secret ")))
    assert digest == one(spark, R.key_digest(F.lit("sk_secret"))) and "sk_secret" not in digest
    assert one(spark, R.key_prefix(F.lit("sk_0123456789abcd"))) == "sk_0123456789a"


def test_instants_do_not_depend_on_the_local_zone(spark):
    aware = datetime.datetime(2024, 5, 1, 12, tzinfo=datetime.timezone(datetime.timedelta(hours=2)))
    assert one(spark, R.instant(aware)) == one(spark, R.instant(NOW)) == at(0)


def test_no_response_is_a_network_error(spark):
    from worktide.functions import rules

    row = spark.range(1).select(rules.http_outcome(F.lit(None).cast("int"), F.lit(None).cast("string")).alias("o")).first()["o"]
    assert (row["succeeded"], row["error_code"], row["retryable"], row["retry_after_seconds"]) == (False, "WEBHOOK_NETWORK_ERROR", True, 0)


def test_white_space_of_every_kind_is_trimmed(spark):
    from worktide.functions import rules

    row = spark.range(1).select(rules.trimmed(F.lit("\t\n k\u00a0\u3000")).alias("t"), rules.retry_after_seconds(F.lit("\t120")).alias("s")).first()
    assert (row["t"], row["s"]) == ("k", 120)
