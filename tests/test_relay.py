"""The relay keeps every job's order over rounds."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from worktide.operators.outbox import frontier, publishable_in_order
from worktide.streaming.relay import relay_round, relay_rounds

START = datetime(2024, 1, 1)
SCHEMA = ("event_id long, job_id string, tenant_id long, event_type string, source string, created_at timestamp_ntz, published_at timestamp_ntz, "
          "next_publish_at timestamp_ntz, claimed_until timestamp_ntz, claimed_by string, publish_attempts int, last_publish_error string, payload string")


def event(number, job, created=0, due=0, lease=None, tries=0, payload="{}", published=None):
    at = lambda s: None if s is None else START + timedelta(seconds=s)
    return (number, job, 1, "job.started", "worker", at(created), at(published), at(due), at(lease), None if lease is None else "other", tries, None, payload)


def at(seconds):
    return str(START + timedelta(seconds=seconds))


class Sink:
    """Keeps what it is given, and fails in the rounds it is told to."""

    def __init__(self, failing=()):
        self.sent, self.failing = [], failing

    def __call__(self, df, round_id):
        rows = df.select("key", F.get_json_object("value", "$.event_id").cast("long").alias("id")).collect()
        if round_id in self.failing:
            raise RuntimeError("no broker")
        self.sent.append(sorted((r.key, r.id) for r in rows))


def test_a_backed_off_event_holds_the_next_one_back_in_later_rounds(spark):
    box = spark.createDataFrame([event(1, "a", 0, tries=6), event(2, "a", 1), event(3, "b", 2)], SCHEMA)
    sink = Sink()
    refuse = F.when((F.col("event_id") == 1) & (F.col("publish_attempts") == 6), "too large")
    after = relay_rounds(box, sink, [at(10), at(45), at(80)], refused=refuse, lease_seconds=30)
    assert sink.sent == [[("b", 3)], [], [("a", 1), ("a", 2)]]
    assert {r.event_id: (str(r.published_at), r.publish_attempts, r.claimed_by) for r in after.collect()} == {
        1: (at(80), 8, None), 2: (at(80), 1, None), 3: (at(10), 1, None)}


def test_undue_and_leased_events_hold_back_what_follows(spark):
    box = spark.createDataFrame([
        event(1, "a", 0), event(2, "a", 1, due=100), event(3, "a", 2), event(4, "b", 0, lease=50), event(5, "b", 1), event(6, "c", 5, published=6),
        event(7, "c", 7), event(8, None, 0, due=100), event(9, None, 1)], SCHEMA)
    assert [r.event_id for r in publishable_in_order(box, at(10)).orderBy("event_id").collect()] == [1, 7, 9]
    assert {r.job_id: r.blocked_from.event_id for r in frontier(box, at(10)).collect()} == {"a": 2, "b": 4}
    assert [r.event_id for r in publishable_in_order(box, at(60), 2).collect()] == [1, 4]
    with pytest.raises(ValueError):
        publishable_in_order(box, at(10), 0)


def test_a_failing_sink_backs_the_first_events_off_and_gives_the_rest_back(spark):
    box = spark.createDataFrame([event(1, "a", 0), event(2, "a", 1), event(3, "b", 2, payload="{not json")], SCHEMA)
    after = {r.event_id: r for r in relay_round(box, Sink([0]), at(10)).collect()}
    assert [(after[k].publish_attempts, after[k].claimed_by, after[k].last_publish_error) for k in (1, 2, 3)] == [
        (1, None, "no broker"), (0, None, None), (1, None, "payload is not valid JSON")]


def test_the_drained_outbox_is_in_order(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        job = "hot" if i % 3 == 0 else f"j{i % 11}"
        rows.append(event(i, job, i // 2, due=rng.choice([0, 0, 30, 90, 300]), lease=rng.choice([None, None, None, 40, 200]), tries=rng.randrange(3),
                          published=i if rng.random() < 0.1 else None))
    fails = set(range(0, 400, 97))
    refused = F.when(F.col("event_id").isin(*fails) & (F.col("publish_attempts") < 2), "refused")
    sink = Sink([2])
    after = relay_rounds(spark.createDataFrame(rows, SCHEMA), sink, [at(s) for s in (200, 230, 260, 300, 400, 500, 600, 700, 800, 900)], n=250, refused=refused)
    found = after.collect()
    assert len(found) == 400 and all(r.published_at for r in found)
    sent = [pair for batch in sink.sent for pair in batch]
    assert len(sent) == len({e for _, e in sent}) == sum(1 for r in rows if r[6] is None)
    of = {}
    for r in sorted((r for r in found if rows[r.event_id][6] is None), key=lambda r: (r.created_at, r.event_id)):
        assert of.get(r.job_id, r.published_at) <= r.published_at
        of[r.job_id] = r.published_at
