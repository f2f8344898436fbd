"""Views kept by deltas, quantiles by selection, positions, and reconciliation by checksums."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_execution import NOW, outcomes, running

from worktide.operators import changes, execution, maintained, quantiles, ranks, reconcile
from worktide.streaming import windows


def as_rows(df):
    names = sorted(df.columns)
    return sorted(str([r[c] for c in names]) for r in rows(df))


def test_views_follow_change_sets(spark):
    jobs, attempts = running(spark, {}, {}, dict(retry_count=3), dict(tenant_id=2), dict(tenant_id=2, status="PENDING", locked_by=None, locked_until=None))
    counts = maintained.STATUS_COUNTS.full(jobs)
    settled = execution.finish(jobs, attempts, outcomes(spark, (1, "j0", "w1", 200, None, 5), (2, "j2", "w1", 503, None, 5), (3, "j3", "w1", 503, None, 5)), NOW).materialize()
    after = changes.apply_changes(jobs, settled.jobs, "job_id")
    plan = spark.createDataFrame([("j4", "w9")], "job_id string, worker_id string")
    started = execution.start_due(after, plan, NOW, 60).materialize()
    backlog = maintained.BACKLOG.full(settled.events.limit(0))
    for change in (settled, started):
        counts = maintained.STATUS_COUNTS.follow(counts, change)
        backlog = maintained.BACKLOG.follow(backlog, change, row="")
    after = changes.apply_changes(after, started.jobs, "job_id")
    assert as_rows(counts) == as_rows(maintained.STATUS_COUNTS.full(after))
    assert {(r.tenant_id, r.status): r.jobs for r in counts.collect()} == {
        (1, "SUCCEEDED"): 1, (1, "RUNNING"): 1, (1, "DEAD_LETTERED"): 1, (2, "RETRY_SCHEDULED"): 1, (2, "RUNNING"): 1}
    events = settled.events.unionByName(started.events)
    assert as_rows(backlog) == as_rows(maintained.BACKLOG.full(events))
    failures = maintained.FAILURES.full(settled.attempts)
    shown = {r.tenant_id: r for r in maintained.board(counts, backlog, failures, NOW).collect()}
    assert (shown[1].total_jobs, shown[1].failures_last_hours, shown[2].outbox_backlog) == (3, 1, 3)
    assert maintained.STATUS_COUNTS.follow(counts, changes.ChangeSet(settled.decisions)) is counts
    with pytest.raises(ValueError):
        maintained.BACKLOG.delta(None, None)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    groups = {"hot": rng.integers(-10**12, 10**12, 3000), "ties": rng.integers(0, 3, 500), "one": np.array([7]), None: np.array([-2**63, 0, 2**63 - 1]), "wide": rng.integers(0, 2**62, 200)}
    data = [(g, int(v)) for g, values in groups.items() for v in values] + [("empty", None)]
    wanted = (0.0, 0.25, 0.5, 0.95, 0.999, 1.0)
    df = spark.createDataFrame(data, "g string, v bigint").repartition(5)
    found = {r.g: r for r in quantiles.exact_quantiles(df, F.col("v"), wanted, ["g"]).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g].rows == len(values)
        assert np.allclose(found[g].quantiles, np.quantile(values.astype(np.longdouble), wanted).astype(float), rtol=1e-12)
    assert quantiles.exact_quantiles(df.filter("g = 'ties'"), F.col("v"), [0.5]).first().rows == 500
    assert quantiles.exact_quantiles(df.filter("v IS NULL"), F.col("v"), [0.5], ["g"]).count() == 0
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(df, F.col("v"), [])


def test_sketches_merge_upward(spark):
    df = spark.range(20_000).select(F.timestamp_seconds(F.col("id")).alias("ts"), (F.col("id") * 7919 % 20_000).alias("v"), F.lit("a").alias("g"))
    hours = quantiles.window_sketches(df, "ts", F.col("v"), "1 hour", ["g"])
    assert hours.count() == 6
    day = quantiles.merged_sketches(quantiles.merged_sketches(hours, ["g"], "2 hours"), ["g"])
    found = quantiles.sketch_quantiles(day, (0.5, 0.95)).first()
    assert found.rows == 20_000 and abs(found.quantiles[0] - 10_000) < 600 and abs(found.quantiles[1] - 19_000) < 600


def test_positions(spark):
    rng = random.Random(5)
    data = [(i, rng.randrange(5)) for i in range(500)]
    df = spark.createDataFrame(data, "id int, priority int").repartition(7)
    found = ranks.with_positions(df, [F.desc("priority"), F.asc("id")], partitions=6).collect()
    assert [r.id for r in sorted(found, key=lambda r: r.position)] == [i for i, _ in sorted(data, key=lambda x: (-x[1], x[0]))]
    assert sorted(r.position for r in found) == list(range(1, 501))
    assert ranks.with_positions(df.limit(0), [F.asc("id")]).count() == 0


def test_reconciliation_finds_the_planted_differences(spark):
    left = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("b"))
    right = left.filter("id NOT IN (10, 4000)").unionByName(spark.createDataFrame([(9000, 1, "x")], "id bigint, a bigint, b string")).withColumns({
        "a": F.when(F.col("id") == 77, None).when(F.col("id") == 70, F.lit(0)).otherwise(F.col("a")), "b": F.when(F.col("id") == 300, "y").otherwise(F.col("b"))})
    assert {(r.id, r.kind) for r in reconcile.differences(left, right, "id", ["a", "b"]).collect()} == {
        (10, "left_only"), (4000, "left_only"), (9000, "right_only"), (70, "differs"), (300, "differs")}
    leaves = reconcile.differing_leaves(*[reconcile.checksums(t, "id", ["a", "b"]) for t in (left, right)])
    assert leaves.count() <= 5
    assert reconcile.differences(left, left, "id", ["a", "b"]).count() == 0
    swapped = left.withColumns({"a": F.when(F.col("id") == 7, F.lit(5)).otherwise(F.col("a")), "b": F.col("b")})
    assert [r.kind for r in reconcile.differences(left, swapped, "id", ["a", "b"]).collect()] == ["differs"]


def test_a_heartbeat_is_gone_after_a_full_ttl(spark):
    from worktide.operators import leases

    beats = spark.createDataFrame([("w", s) for s in (0, 59, 119, 178)], "worker_id string, s int").select("worker_id", F.timestamp_seconds("s").alias("ts"))
    found = [r.heartbeats for r in leases.worker_sessions(beats, 60).orderBy("session_start").collect()]
    assert found == [2, 2] == [r.heartbeats for r in windows.session_stream(beats, 60, "0 seconds").orderBy("session_start").collect()]
    ends = [[str(r.session_end) for r in df.orderBy("session_start").collect()] for df in (leases.worker_sessions(beats, 60), windows.session_stream(beats, 60, "0 seconds"))]
    assert ends[0] == ends[1]


def test_any_page_reads_its_ranges(spark, tmp_path):
    from worktide.operators.pages import build_directory

    rng = random.Random(9)
    data = [(i, rng.randrange(20)) for i in range(1000)]
    made = build_directory(spark.createDataFrame(data, "id int, priority int").repartition(5), [("priority", False), ("id", True)], str(tmp_path / "t"), ranges=10)
    expected = [i for i, _ in sorted(data, key=lambda x: (-x[1], x[0]))]
    for number, size in ((1, 30), (7, 100), (34, 30), (11, 100)):
        assert [r.id for r in made.page(number, size).collect()] == expected[(number - 1) * size:number * size]
    assert made.page(99, 100).count() == 0 and made.page(1, 5).columns == ["id", "priority"]
    plan = made.page(3, 10)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "page_range" in plan
    assert made.ranges().agg(F.sum("rows")).first()[0] == 1000


def test_reports_of_streams_are_kept(spark, tmp_path):
    from worktide.streaming.io import drain, stream_table
    from worktide.streaming.monitor import Monitor, per_query, progress

    path, kept = str(tmp_path / "in"), str(tmp_path / "kept")
    make = lambda low, high: spark.range(low, high).select(F.timestamp_seconds(F.col("id")).alias("ts")).coalesce(1).write.mode("append").parquet(path)
    make(1000, 1100)
    stream = stream_table(spark, path, "ts timestamp", files_per_batch=1).observe("seen", F.count(F.lit(1)).alias("rows"))
    counted = stream.withWatermark("ts", "10 seconds").groupBy(F.window("ts", "5 seconds").alias("w")).agg(F.count("*").alias("n")).select("w.start", "n")
    with Monitor(spark, kept):
        drain(counted, "counted", lambda: (make(5000, 5001), make(0, 30)))
    found = per_query(progress(spark, kept)).collect()
    assert [r.input_rows for r in found] == [131]
    rows = progress(spark, kept).orderBy("batch").collect()
    assert rows[0].observed["seen"]["rows"] == 100 and any(r.watermark and r.state_rows for r in rows)
    # Late rows are counted after they were combined by window.
    assert sum(r.dropped_rows for r in rows) == 6
