"""Streams over several files, against their batch forms."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import TimerValues

from worktide.operators import leases
from worktide.operators.audit import transition_audit
from worktide.operators.limits import BucketFold, rate_limit
from worktide.sources.outlet import file_writer
from worktide.streaming import relay, stateful, windows
from worktide.streaming.io import drain, stream_table

KINDS = ["job.created", "job.started", "job.completed", "job.failed", "job.retry_scheduled"]


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """The same events in three files, oldest first, one micro-batch each."""
    random.seed(11)
    path, clock, data = str(tmp_path_factory.mktemp("events") / "table"), 0, []
    for i in range(300):
        clock += random.randint(1, 40)
        data.append((i, random.choice(["hot", "hot", "b", "c", f"k{i % 17}"]), random.choice(KINDS), clock))
    for part in range(3):
        chunk = spark.createDataFrame(data[part * 100:(part + 1) * 100], "event_id int, job_id string, event_type string, s bigint")
        chunk.withColumn("created_at", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def events(spark, files):
    return spark.read.parquet(files)


def stream(spark, files, events):
    return stream_table(spark, files, events.schema, files_per_batch=1)


@pytest.fixture(scope="module")
def shuffled(spark, files, tmp_path_factory):
    """The same events in six files, in no order of time."""
    path = str(tmp_path_factory.mktemp("shuffled") / "table")
    rows = spark.read.parquet(files)
    for part in range(6):
        rows.filter(F.col("event_id") * 7919 % 6 == part).coalesce(1).write.mode("append").parquet(path)
    return path


def as_set(df):
    names = sorted(df.columns)
    return sorted(tuple(str(r[n]) for n in names) for r in df.collect())


#: Longer than the whole span of the events; a last file with one row long after it lets all of them out.
LONG, AFTER = "20000 seconds", 10_000_000


def in_any_order(spark, path, events, run, batch):
    """``run`` over the shuffled files, 1, 3 and 64 a batch, gives the rows of ``batch``."""
    expected = as_set(batch)
    for per_batch in (1, 3, 64):
        streamed = drain(run(stream_table(spark, path, events.schema, files_per_batch=per_batch)))
        assert as_set(streamed.filter("key <> 'after'").withColumnRenamed("key", dict_key(batch))) == expected, per_batch


def dict_key(df):
    return next(c for c in ("job_id", "client_id") if c in df.columns)


@pytest.fixture(scope="module")
def ended(spark, shuffled):
    import time

    time.sleep(1.1)    # files are read by age
    spark.createDataFrame([(1000, "after", KINDS[0], AFTER)], "event_id int, job_id string, event_type string, s bigint").withColumn(
        "created_at", F.timestamp_seconds("s")).coalesce(1).write.mode("append").parquet(shuffled)
    return shuffled


def test_lifecycle(spark, ended, events):
    in_any_order(spark, ended, events, lambda df: stateful.lifecycle_stream(df, LONG).withColumnRenamed("job_id", "key"), transition_audit(events))


def test_rate_limit(spark, ended, events):
    def shaped(df):
        return df.select(F.col("job_id").alias("client_id"), F.col("event_id").alias("request_id"), F.col("created_at").alias("ts"))

    in_any_order(spark, ended, events, lambda df: stateful.rate_limit_stream(shaped(df), LONG, 2, 60).withColumnRenamed("client_id", "key"),
                 rate_limit(shaped(events), 2, 60).drop("ts"))


def test_lease_expiry(spark, ended, events):
    def signals(df):
        return df.select("job_id", F.col("created_at").alias("ts"), F.col("event_id").alias("signal_id"),
                         F.col("event_type").isin("job.started", "job.retry_scheduled").alias("alive"))

    in_any_order(spark, ended, events, lambda df: stateful.expiry_stream(signals(df), 60, LONG).withColumnRenamed("job_id", "key"),
                 leases.lease_expiries(signals(events), 60, "2000-01-01"))


def test_sessions(spark, files, events):
    def beats(df):
        return df.select(F.col("job_id").alias("worker_id"), F.col("created_at").alias("ts"))

    streamed = drain(windows.session_stream(beats(stream(spark, files, events)), 45, "0 seconds"))
    end = events.agg(F.max("created_at")).first()[0]
    closed = leases.worker_sessions(beats(events), 45).filter(F.col("session_end") <= F.lit(end))
    assert as_set(streamed) == as_set(closed)


def test_metrics(spark, files, events):
    def measured(df):
        return windows.metrics_stream(df, "created_at", ["event_type"], "10 minutes", "0 seconds", None, F.col("s") / 1000.0, (1.0,))

    end = events.agg(F.max("created_at")).first()[0]
    assert as_set(drain(measured(stream(spark, files, events)))) == as_set(measured(events).filter(F.col("window_end") <= F.lit(end)))


def test_dedupe(spark, files, events):
    twice = stream(spark, files, events).union(stream(spark, files, events))
    assert as_set(drain(relay.dedupe_events(twice, "1 hour"))) == as_set(events)


def test_relay_publishes_what_is_unpublished_and_resumes(spark, files, events, tmp_path):
    def box(df):
        return df.withColumns({"tenant_id": F.lit(1), "source": F.lit("worker"), "payload": F.lit("{}"),
                               "published_at": F.when(F.col("event_id") % 3 == 0, F.col("created_at"))})

    out, state, log = str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "log")
    for _ in range(2):  # the second run finds nothing new
        running = relay.relay_stream(box(stream(spark, files, events)), file_writer(out), state, record=file_writer(log))
        running.awaitTermination()
    delivered = spark.read.parquet(log)
    assert delivered.filter("delivered AND relay_id = 'relay'").select("event_id").distinct().count() == 200
    records = spark.read.parquet(out)
    assert records.count() == 200
    ids = {int(r.i) for r in records.select(F.get_json_object("value", "$.event_id").alias("i")).collect()}
    assert ids == {i for i in range(300) if i % 3}


class Held:
    """State of one key, without Spark: a value, a map whose writes are counted, and timers."""

    def __init__(self):
        self.value, self.map, self.timers, self.moved = None, {}, set(), 0
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getValueState(self, *_):  # noqa: N802
        return self

    getMapState = getValueState  # noqa: N815

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def updateValue(self, key, value):  # noqa: N802
        self.moved += 1
        self.map[key] = value

    def getValue(self, key):  # noqa: N802
        return self.map[key]

    def removeKey(self, key):  # noqa: N802
        del self.map[key]


START, MINUTE = 1_700_000_000_000_000, 60_000_000


def fed(watcher, carried, outputs, batches):
    """What ``watcher`` says of one key to micro-batches (watermark in minutes, rows), at once, and the key's state."""
    given, held = Row("key", "__us", "id", *carried), Held()
    row_type = T.StructType([T.StructField("__us", T.LongType()), T.StructField("id", T.LongType()), *[T.StructField(n, T.StringType()) for n in carried]])
    processor = stateful._InEventOrder(watcher, T.StructType.fromDDL(watcher.known), row_type, ["key", *outputs], 900_000)
    processor.init(held)
    told = []
    for minute, rows in batches:
        mark = 0 if minute is None else (START + minute * MINUTE) // 1000
        said = processor.handleInputRows(("k",), iter([given("k", START + at * MINUTE, i, *rest) for i, at, *rest in rows]), TimerValues(-1, mark))
        told += [values for row in said for values in zip(*row[1:], strict=True)]
    return told, held


def test_rows_the_watermark_has_passed_are_judged_as_they_come(spark):
    rows = [(i, i, KINDS[i % 5], "AB"[i % 2]) for i in range(80)]
    random.Random(5).shuffle(rows)
    first, second = [r for r in rows if r[0] < 40], [r for r in rows if r[0] >= 40]
    told, held = fed(stateful._Lifecycle(None), ["event_type", "status"], ["event_id", "us", "event_type", "status", "previous_status"],
                     [(None, first), (60, second)])
    assert told == [(i, START + i * MINUTE, KINDS[i % 5], "AB"[i % 2], "BA"[i % 2] if i else None) for i in range(60)]
    # Together they are more than a key's value keeps, yet no row went through the slots; one timer is left for the others.
    assert held.moved == 0 and len(held.timers) == 1 and min(held.timers) > (START + 60 * MINUTE) // 1000


def test_requests_the_watermark_has_passed_are_decided_as_they_come(spark):
    fold = BucketFold(2, 3 * MINUTE)
    rows = [(i, i) for i in range(80)]
    random.Random(6).shuffle(rows)
    first, second = [r for r in rows if r[0] < 40], [r for r in rows if r[0] >= 40]
    told, held = fed(stateful._Bucket(fold), [], ["request_id", "allowed", "units_left"], [(None, first), (60, second)])
    state, expected = fold.start((START,)), []
    for i in range(60):
        state, decision = fold.step(state, (START + i * MINUTE,))
        expected.append((i, *decision))
    assert told == expected and {allowed for _, allowed, _ in told} == {True, False}
    assert held.moved == 0 and len(held.timers) == 1


def test_rows_wait_for_their_stretch_though_the_watermark_is_inside_it(spark):
    """New rows do not open what has been kept before a stretch of time has passed: no row is read again and again."""
    rows = [(i, i // 50, KINDS[0], "A") for i in range(100)]
    told, held = fed(stateful._Lifecycle(None), ["event_type", "status"], ["event_id", "us", "event_type", "status", "previous_status"],
                     [(0, rows), (1, [(100, 14, KINDS[0], "A")]), (1, [(101, 14, KINDS[0], "A")])])
    assert told == [] and held.moved == len(held.map) and held.value[1] is None


def test_keys_share_buckets(spark, tmp_path):
    """The store is called once a bucket, not once a key; null keys, null ids, ids beyond 2**53 and times after 2262 stay what they are."""
    path, big = str(tmp_path / "many"), 2**60 + 1
    data = [(None if i % 501 == 0 else big + i, None if i % 7 == 0 else big + i % 3001, 100 + i % 50) for i in range(9000)]
    # The years 2286 and 8307.
    data += [(i, 5, s) for i, s in enumerate((10_000_000_000, 10_000_000_020, 10_000_000_025, 200_000_000_000, 200_000_000_001))]
    sent = spark.createDataFrame(data, "request_id bigint, client_id bigint, s bigint").withColumn("ts", F.timestamp_seconds("s"))
    sent.coalesce(1).write.parquet(path)
    found = stateful.rate_limit_stream(stream_table(spark, path, sent.schema), LONG, 2, 60)
    out = str(tmp_path / "out")
    said = []
    for more in (None, [(-1, -1, 250_000_000_000)]):
        if more:
            spark.createDataFrame(more, "request_id bigint, client_id bigint, s bigint").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.mode(
                "append").parquet(path)
        running = found.writeStream.outputMode("append").format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        running.awaitTermination()
        said += running.recentProgress
    updated = [p.stateOperators[0].numRowsUpdated for p in said if p.numInputRows == len(data)]
    assert len(updated) == 1 and updated[0] <= 2 * stateful.BUCKETS < 3002
    told = spark.read.parquet(out).filter("client_id IS NULL OR client_id >= 0")
    # Null ids of one client and time come in any order.
    expected = rate_limit(sent.drop("s"), 2, 60).drop("ts").select(told.columns)
    assert as_set(told) == as_set(expected) and told.filter("client_id IS NULL").count() == 1286


def test_what_is_known_of_many_keys_lies_in_pages(spark, monkeypatch):
    monkeypatch.setattr(stateful, "_PAGE", 3)
    fold, draw = BucketFold(2, 3 * MINUTE), random.Random(7)
    minutes = sorted(draw.randrange(400) for _ in range(600)) + [900]
    sent = [(START + at * MINUTE, i, f"c{draw.randrange(60)}" if at < 350 else "c0") for i, at in enumerate(minutes)]
    processor, held, told, pages = stateful._InFrames(
        stateful._Bucket(fold), T.StructType.fromDDL("level bigint, us bigint"), T.StructType.fromDDL("__us bigint, id bigint"),
        ["key", "request_id", "allowed", "units_left"], 1000), Held(), [], []
    processor.init(held)
    for minute in range(0, 1000, 20):
        rows = [row for row in sent if START + minute * MINUTE <= row[0] < START + (minute + 20) * MINUTE]
        # Two frames a call, as for more rows than one Arrow batch has.
        frames = [pd.DataFrame([(0, None, 0, *row) for row in part]) for part in (rows[::2], rows[1::2]) if part]
        for given, mark in ((frames, minute), (frames[:0], minute + 20)):
            for frame in processor.handleInputRows((0,), iter(given), TimerValues(-1, (START + mark * MINUTE) // 1000)):
                told += frame.itertuples(index=False, name=None)
        pages.append(len(held.value[6]) if held.value else 0)
    states, expected = {}, []
    for us, i, key in sent:
        states[key], decision = fold.step(states.get(key) or fold.start((us,)), (us,))
        expected.append((key, i, *decision))
    assert sorted(told) == sorted(expected) and max(pages) == 4
    # Full buckets are forgotten: nothing is left of them, nor of their pages.
    assert pages[-1] == 0 and not held.map and held.value is None
