"""The exactly-once sink: lost checkpoints, killed tasks, several writers."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from worktide.sources.ledger import manifests, read_ledger, write_ledger
from worktide.streaming.io import stream_table


@pytest.fixture
def files(spark, tmp_path):
    path = str(tmp_path / "in")
    for part in range(3):
        spark.range(part * 100, part * 100 + 100).coalesce(2).write.mode("append").parquet(path)
    return path


def stream(spark, files):
    return stream_table(spark, files, "id bigint", files_per_batch=2)


def ids(spark, path):
    return sorted(r.id for r in read_ledger(spark, path, "id bigint").collect())


def test_repeated_batches_leave_each_record_once(spark, files, tmp_path):
    out = str(tmp_path / "out")
    assert ids_or_none(spark, out) == []
    for attempt in ("a", "a", "b"):  # again with its checkpoint, then with a new one
        write_ledger(stream(spark, files), out, str(tmp_path / attempt)).awaitTermination()
        assert ids(spark, out) == list(range(300))
    write_ledger(stream(spark, files), out, str(tmp_path / "c"), writer="other").awaitTermination()
    assert ids(spark, out) == sorted([*range(300)] * 2)
    assert {r.writer: r.rows for r in manifests(spark, out).groupBy("writer").agg(F.sum("rows").alias("rows")).collect()} == {"stream": 300, "other": 300}
    # Nothing is left of the batches that were repeated.
    assert len(os.listdir(f"{out}/parts")) == sum(len(r.files) for r in manifests(spark, out).collect())


def ids_or_none(spark, path):
    os.makedirs(f"{path}/commits", exist_ok=True)
    return ids(spark, path)


def test_a_killed_batch_leaves_nothing_and_comes_again(spark, files, tmp_path):
    out, flag = str(tmp_path / "out"), str(tmp_path / "flag")

    @F.udf("bigint")
    def frail(x):
        if x == 250 and not os.path.exists(flag):
            raise RuntimeError("lost")
        return x

    frail_stream = stream(spark, files).select(frail("id").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_ledger(frail_stream, out, str(tmp_path / "state")).awaitTermination()
    assert set(ids(spark, out)) <= set(range(200))
    open(flag, "w").close()
    write_ledger(stream(spark, files).select(frail("id").alias("id")), out, str(tmp_path / "state")).awaitTermination()
    assert ids(spark, out) == list(range(300))
