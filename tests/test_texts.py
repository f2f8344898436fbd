"""Texts pass through unchanged, nothing is lost on the way out, and promises are checked."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import web
from worktide.operators import commands, listing
from worktide.sources import snapshots
from worktide.sources.intake import parse_requests
from worktide.sources.outlet import compact, envelope, unsendable
from worktide.streaming.relay import relay_round

GOOD = ['{"a":1,"a":2}', '"abc"', "5", "[1, 2]", "null", '{"n":12345678901234567890123456789012345678901234567890}', ' {"a":{"a":1,"a":"}"}} ',
        '["]",{"a":1,"a":2}]']
BAD = ["", " ", "abc", "1,2", "1],[2", '1,"q":2', '1},{"a":1', "{'a':1}", '{"a":1', '{"a":1,"a":2} x', "NaN", None, '{"a":1,"a":2}}', '[{"a":1,"a":2}']


def test_json_validity(spark):
    table = spark.createDataFrame([(t, t in GOOD) for t in GOOD + BAD], "t string, good boolean")
    assert [r.t for r in table.filter(R.is_json(F.col("t")) != F.col("good")).collect()] == []


def test_payloads_keep_their_text(spark):
    bodies = spark.createDataFrame([(i, '{"name":"n","payload":%s}' % p) for i, p in enumerate(['"abc"', '{"b":"x"}', '"{}"', '{"payload":"x"}', "7", '""'])], "i int, body string")
    assert [r["payload"] for r in rows(parse_requests(bodies), "i")] == ['"abc"', '{"b":"x"}', '"{}"', '{"payload":"x"}', "7", '""']
    jobs = spark.createDataFrame([(i, 1, '{"url":"https://a.example/","body":%s}' % b) for i, b in enumerate(['"abc"', '{"q":1}', "3"])],
                                 "job_id int, attempt_number int, payload string")
    assert [r["body"] for r in rows(web.webhook_calls(jobs), "job_id")] == ['"abc"', '{"q":1}', "3"]


BOX = ("event_id string, tenant_id int, job_id string, event_type string, source string, payload string, created_at timestamp_ntz, "
       "published_at timestamp_ntz, next_publish_at timestamp_ntz, claimed_until timestamp_ntz, claimed_by string, publish_attempts int, last_publish_error string")


def box(spark, events):
    """(event, job, payload, minute created, minute due)"""
    given = spark.createDataFrame(events, "event_id string, job_id string, payload string, made int, due int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    at = lambda c: F.timestamp_add("MINUTE", F.col(c).cast("bigint"), start)
    nothing = F.lit(None)
    return given.select("event_id", F.lit(1).alias("tenant_id"), "job_id", F.lit("job.started").alias("event_type"), F.lit("s").alias("source"), "payload",
                        at("made").alias("created_at"), nothing.cast("timestamp_ntz").alias("published_at"), at("due").alias("next_publish_at"),
                        nothing.cast("timestamp_ntz").alias("claimed_until"), nothing.cast("string").alias("claimed_by"),
                        F.lit(0).alias("publish_attempts"), nothing.cast("string").alias("last_publish_error"))


def test_envelope_carries_the_payload_as_given(spark):
    payloads = ['{"k":1,"k":1.0}', '{"n":12345678901234567890123456789012345678901234567890}', None, "{bad"]
    events = box(spark, [(f"e{i}", "j", p, i, 0) for i, p in enumerate(payloads)])
    values = [r["value"] for r in rows(envelope(events), "event_id")]
    assert [v.partition('"payload":')[2] for v in values] == [payloads[0] + "}", payloads[1] + "}", ""]
    assert values[2].endswith('"}')
    assert [r["event_id"] for r in rows(unsendable(events))] == ["e3"]


def test_compact(spark):
    long = '{"a":"' + '\\" ' * 50_000 + '"}'
    given = [' { "a b" : [ 1 , " \\" x " ] }\n', long, '"$1 \\\\" ']
    table = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string")
    assert [r["t"] for r in rows(table.select("i", compact(F.col("t")).alias("t")), "i")] == ['{"a b":[1," \\" x "]}', long, '"$1 \\\\"']


def test_relay_rounds_lose_nothing(spark):
    sent, fail = [], [True]

    def writer(df, round_id):
        found = [r["key"] for r in df.collect()]
        if fail[0]:
            raise RuntimeError("broker away")
        sent.extend(found)

    outbox = box(spark, [("e1", "a", "{}", 1, 1), ("e2", "a", "{}", 2, 2), ("e3", "b", "{bad", 3, 3), ("e4", "b", "{}", 4, 4), ("e5", "c", "{}", 5, 500)])
    outbox = relay_round(outbox, writer, "2024-01-01 00:10:00").checkpoint()
    state = {r["event_id"]: r for r in rows(outbox)}
    assert sent == [] and all(r["published_at"] is None for r in state.values())
    assert state["e1"]["last_publish_error"] == "broker away" and state["e1"]["publish_attempts"] == 1
    assert state["e2"]["claimed_by"] == "relay" and state["e2"]["publish_attempts"] == 0
    assert state["e3"]["last_publish_error"] == "payload is not valid JSON" and state["e5"]["claimed_by"] is None
    fail[0] = False
    for minute in ("00:20", "00:30", "09:00"):
        outbox = relay_round(outbox, writer, f"2024-01-01 {minute}:00").checkpoint()
    state = {r["event_id"]: r for r in rows(outbox)}
    assert {k for k, r in state.items() if r["published_at"] is None} >= {"e3"}
    assert {k for k, r in state.items() if r["published_at"] is not None} >= {"e1", "e2", "e5"}
    assert sent.count("a") == 2 and sent.count("c") == 1


def test_pages_and_times_are_checked():
    for size in (0, 101):
        with pytest.raises(ValueError):
            listing.page_size(size)
    listing.JobFilter(1, created_after="2024-01-01T00:00:00", created_before="2024-01-01 12:00:00")
    listing.JobFilter(1, created_after="2024-01-01T13:00:00+02:00", created_before="2024-01-01 12:00:00")
    with pytest.raises(ValueError):
        listing.JobFilter(1, created_after="2024-01-01T13:00:00Z", created_before="2024-01-01 12:00:00")


def test_a_promise_of_single_commands_is_checked(spark):
    jobs = spark.createDataFrame([("j", 1, "RUNNING"), ("k", 1, "RUNNING")], "job_id string, tenant_id int, status string")
    twice = spark.createDataFrame([(1, "j", "cancel"), (2, "j", "cancel")], "command_id int, job_id string, command string")
    once = twice.withColumn("job_id", F.when(F.col("command_id") == 1, "j").otherwise("k"))
    assert {r["status_after"] for r in rows(commands.judge_single_commands(jobs, once))} == {"CANCELLED"}
    with pytest.raises(PySparkException, match="several commands"):
        commands.judge_single_commands(jobs, twice).collect()


def test_a_committed_batch_is_refused(spark, tmp_path):
    table = spark.range(3)
    snapshots.write_snapshot(spark, str(tmp_path), "0001", {"jobs": table})
    with pytest.raises(ValueError):
        snapshots.write_snapshot(spark, str(tmp_path), "0001", {"jobs": table})
