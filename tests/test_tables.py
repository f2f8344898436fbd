"""Schemas, snapshots, listings, the outbox and reports."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from worktide.operators import listing, outbox, reports
from worktide.sources import outlet, snapshots, tables

NOW = "2024-05-01 10:00:00"


@pytest.mark.parametrize("table", ["jobs", "attempts", "dead_letters", "events"])
def test_schema_round_trip(spark, table):
    empty = spark.createDataFrame([], tables.TABLES[table])
    old = tables.downgrade(empty, table)
    again = tables.upgrade(old, table)
    assert set(again.columns) == set(empty.columns)
    assert {f.name: f.dataType for f in again.schema} == {f.name: f.dataType for f in tables.TABLES[table]}
    assert tables.upgrade(again, table).columns == again.columns


def test_upgrade_fills_the_default_tenant(spark):
    old = spark.sql("SELECT 'e' AS event_id, TIMESTAMP '2024-01-01 00:00:00' AS created_at")
    row = tables.upgrade(old, "events").first()
    assert row.tenant_id == "00000000-0000-0000-0000-000000000001" and row.schema_version == 1
    assert row.publish_attempts == 0 and row.next_publish_at == row.created_at and row.published_at is None


def test_snapshots_show_only_committed_batches(spark, tmp_path):
    root = str(tmp_path)
    beats = spark.sql("SELECT 'w' AS worker_id, TIMESTAMP '2024-01-01 00:00:00' AS ts")
    snapshots.write_snapshot(spark, root, "0001", {"heartbeats": beats})
    snapshots.write_snapshot(spark, root, "0002", {"heartbeats": beats.union(beats)}, {"heartbeats": ["worker_id"]})
    # A batch that died before its manifest.
    beats.write.parquet(f"{root}/batches/0003/heartbeats")
    assert snapshots.latest_batch(spark, root) == "0002"
    assert snapshots.read_snapshot(spark, root, "heartbeats").count() == 2
    assert snapshots.read_snapshot(spark, root, "heartbeats", "0001", fixed_schema=True).schema == tables.load_table(
        spark, "heartbeats", f"{root}/batches/0001/heartbeats").schema


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "jobs")
    spark.createDataFrame([], tables.JOBS).write.parquet(path)
    jobs = tables.load_table(spark, "jobs", path)
    wanted = listing.JobFilter("t", status="PENDING", created_after=NOW)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = listing.list_jobs(jobs, wanted).select("job_id")._jdf.queryExecution().toString()
    assert "EqualTo(tenant_id,t)" in plan and "EqualTo(status,PENDING)" in plan and "GreaterThanOrEqual(created_at" in plan
    scan = plan.split("ReadSchema: ")[-1].splitlines()[0]
    assert "payload" not in scan and "job_id" in scan


@pytest.mark.parametrize("bad", [
    dict(status="UNKNOWN"), dict(job_type="UNKNOWN"), dict(sort="name"), dict(order="up"),
    dict(created_after="2024-02-01", created_before="2024-01-01"),
])
def test_bad_filters_are_refused(bad):
    with pytest.raises(ValueError):
        listing.JobFilter("t", **bad)


def _listed(spark):
    return spark.range(250).select(
        F.col("id").alias("job_id"), (F.col("id") % 2).alias("tenant_id"), F.lit("PENDING").alias("status"),
        F.lit("CALL_WEBHOOK").alias("job_type"), (F.col("id") % 3).cast("int").alias("priority"),
        F.lit(NOW).cast("timestamp_ntz").alias("created_at"), F.lit(NOW).cast("timestamp_ntz").alias("run_at"))


def test_pages(spark):
    jobs = _listed(spark)
    assert [listing.page_size(n) for n in (1, 20, 100)] == [1, 20, 100]
    assert [listing.page_number(n) for n in (-3, 0, 1, 7)] == [1, 1, 1, 7]
    assert listing.list_jobs(jobs, listing.JobFilter(0, size=100)).count() == 100
    assert listing.list_jobs_total(jobs, listing.JobFilter(0)).first().total == 125
    seen, page = [], 1
    while found := listing.list_jobs(jobs, listing.JobFilter(0, sort="priority", page=page, size=50)).collect():
        seen += [(r.priority, r.job_id) for r in found]
        page += 1
    assert seen == sorted(seen, reverse=True) and len(seen) == 125 and all(j % 2 == 0 for _, j in seen)
    rest = listing.list_jobs_after(jobs, listing.JobFilter(0, sort="priority", size=50), *seen[49])
    assert [(r.priority, r.job_id) for r in rest.collect()] == seen[50:100]


def _outbox(spark, *given):
    df = spark.createDataFrame(list(given), "event_id int, job_id int, tenant_id int, published string, due string, lease string, "
                               "claimed_by string, publish_attempts int")
    return df.select("event_id", "job_id", "tenant_id", F.lit("job.created").alias("event_type"), F.lit("scheduler-api").alias("source"),
                     F.timestamp_seconds("event_id").cast("timestamp_ntz").alias("created_at"),
                     *[F.col(a).cast("timestamp_ntz").alias(b) for a, b in (
                         ("published", "published_at"), ("due", "next_publish_at"), ("lease", "claimed_until"))],
                     "claimed_by", "publish_attempts", F.lit('{"k": [1, 2]}').alias("payload"))


def test_publishing_round(spark):
    early = "2024-05-01 09:00:00"
    box = _outbox(spark, (1, 1, 1, None, early, None, None, 0), (2, 1, 1, None, NOW, NOW, "r0", 0), (3, 2, 1, early, early, None, None, 1),
                  (4, 2, 1, None, "2024-05-01 11:00:00", None, None, 0), (5, 3, 2, None, NOW, early, "r0", 3))
    claimed = outbox.claim_publishable(box, NOW, "r1", 10)
    assert [(r.event_id, r.claimed_by) for r in claimed.orderBy("event_id").collect()] == [(1, "r1"), (5, "r1")]
    held = box.join(claimed.select("event_id"), "event_id", "left_anti").unionByName(claimed)
    results = spark.createDataFrame([(1, 1, "r1", True, None), (2, 5, "r1", False, "x" * 2000), (3, 2, "other", True, None)],
                                    "result_id int, event_id int, relay_id string, delivered boolean, error string")
    change = outbox.apply_publish_results(held, results, NOW)
    after = {r.event_id: r for r in change.events.collect()}
    assert str(after[1].published_at) == NOW and after[1].publish_attempts == 1 and after[1].claimed_by is None
    assert after[5].published_at is None and str(after[5].next_publish_at) == "2024-05-01 10:00:08"
    assert after[5].publish_attempts == 4 and len(after[5].last_publish_error) == 1000
    assert [(r.event_id, r.reason) for r in change.rejects.collect()] == [(2, "LEASE_LOST")]
    replayed = outbox.replay(held, spark.createDataFrame([(1, 3), (2, 3), (1, 99)], "tenant_id int, event_id int"), NOW)
    again = replayed.events.collect()
    assert [(r.event_id, r.published_at, str(r.next_publish_at), r.publish_attempts) for r in again] == [(3, None, NOW, 1)]
    assert sorted((r.tenant_id, r.event_id) for r in replayed.rejects.collect()) == [(1, 99), (2, 3)]


def test_a_failure_holds_back_later_events_of_the_same_job(spark):
    box = _outbox(spark, *[(i, i % 2, 1, None, NOW, None, "r", 0) for i in range(6)])
    results = spark.createDataFrame([(i, i, "r", i != 2, None) for i in range(6)],
                                    "result_id int, event_id int, relay_id string, delivered boolean, error string")
    kept = {r.event_id: r.delivered for r in outbox.hold_back(results, box).collect()}
    assert kept == {0: True, 2: False, 1: True, 3: True, 5: True}


def test_envelope(spark):
    record = outlet.envelope(_outbox(spark, (7, 42, 1, None, NOW, None, None, 0))).first()
    assert record.key == "42"
    value = json.loads(record.value)
    assert value == {"event_id": "7", "schema_version": 1, "tenant_id": "1", "event_type": "job.created", "source": "scheduler-api",
                     "entity_type": "job", "entity_id": "42", "occurred_at": "1970-01-01T00:00:07.000000Z", "payload": {"k": [1, 2]}}


def test_publish_replaces_a_repeated_batch(spark, tmp_path):
    box, target = _outbox(spark, *[(i, i % 3, 1, None, NOW, None, None, 0) for i in range(30)]), str(tmp_path / "out")
    for _ in range(2):
        outlet.publish(box, outlet.file_writer(target), 4)
    outlet.publish(box, outlet.noop_writer, 5)
    assert spark.read.parquet(target).count() == 30


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([("a", v) for v in (0.005, 0.006, 0.3, 99.0)] + [("b", 1.0), ("b", None)], "k string, v double")
    found = {(r.k, r.le): r.bucket_count for r in reports.histogram(df, F.col("v"), ["k"]).collect()}
    assert [found["a", le] for le in ("0.005", "0.01", "0.25", "0.5", "10", "+Inf")] == [1, 2, 2, 3, 3, 4]
    assert found["b", "+Inf"] == 1 and found["b", "0.5"] == 0 and found["b", "1"] == 1


def test_quantiles(spark):
    df = spark.range(1, 101).select(F.lit("a").alias("k"), F.col("id").alias("v"))
    exact = reports.latency_quantiles(df.union(df), F.col("v"), ["k"]).first()
    assert (exact.p50, exact.max, exact.rows) == (50.5, 100, 200) and abs(exact.p95 - 95.05) < 0.5
    rough = reports.latency_quantiles(df, F.col("v"), ["k"], exact=False).first()
    assert abs(rough.p50 - 50) <= 1 and rough.rows == 100


def test_recent_failures_count_failed_only(spark):
    df = spark.createDataFrame([("FAILED", "2024-04-30 10:00:00"), ("FAILED", "2024-04-30 09:59:59"), ("CANCELLED", NOW), ("FAILED", NOW)],
                               "status string, failed_at string").withColumn("failed_at", F.col("failed_at").cast("timestamp_ntz"))
    assert reports.recent_failures(df, NOW).first().failures == 2


def test_active_workers(spark):
    df = spark.createDataFrame([("a", "2024-05-01 09:59:31"), ("a", "2024-05-01 09:00:00"), ("b", "2024-05-01 09:59:30"),
                                ("c", "2024-05-01 10:00:01")], "worker_id string, ts string")
    live = reports.active_workers(df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), NOW).collect()
    assert [(r.worker_id, r.status) for r in live] == [("a", "active")]


def test_throughput_and_counters(spark):
    df = spark.createDataFrame([(0,), (10,), (20,)], "s bigint").withColumn("ts", F.timestamp_seconds("s"))
    assert reports.throughput(df, "ts").first().per_second == pytest.approx(3 / 20)
    assert reports.throughput(df.limit(1), "ts").first().per_second is None
    events = spark.createDataFrame([(1, "job.dead_lettered", "recovery"), (1, "job.dead_lettered", "worker"), (1, "job.created", "x"),
                                    (2, "job.started", "worker")], "job_id int, event_type string, source string")
    jobs = spark.createDataFrame([(1, "A"), (2, "B")], "job_id int, job_type string")
    found = {r.job_type: (r.created, r.claimed, r.dead_lettered) for r in reports.lifecycle_counters(events, jobs).collect()}
    assert found == {"A": (1, 0, 1), "B": (0, 1, 0)}
