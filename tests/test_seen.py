"""Repeats are dropped whatever their distance, and no id is lost, also with full filters."""

from __future__ import annotations

import random

import pytest

from worktide.streaming.seen import SeenIds


@pytest.mark.parametrize("blocks", [1, 64])
def test_each_id_is_admitted_once(spark, tmp_path, blocks):
    rng = random.Random(blocks)
    seen = SeenIds(spark, str(tmp_path / "seen"), buckets=3, blocks=blocks, compact_every=2)
    known: set[int] = set()
    for batch in range(5):
        given = [rng.randrange(900) for _ in range(400)]
        rows = spark.createDataFrame([(i, k) for k, i in enumerate(given)] + [(None, -1)], "event_id int, at int")
        found = seen.admit(rows, "event_id", "at", batch).collect()
        assert sorted(r.event_id for r in found if r.event_id is not None) == sorted({*given} - known)
        assert [r.at for r in found if r.event_id is None] == [-1]
        assert all(given.index(r.event_id) == r.at for r in found if r.event_id is not None)
        if batch == 3:  # a repeated batch gives the same rows
            again = seen.admit(rows, "event_id", "at", batch).collect()
            assert sorted(map(str, again)) == sorted(map(str, found))
        known |= {*given}
    larger = seen.rebuild(str(tmp_path / "larger"), 128, 5)
    rows = spark.createDataFrame([(i, i) for i in range(1000)], "event_id int, at int")
    assert sorted(r.event_id for r in larger.admit(rows, "event_id", "at", 5).collect()) == sorted({*range(1000)} - known)


def test_hardly_any_new_id_is_looked_up(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path / "seen"), buckets=2, blocks=64)
    seen.admit(spark.range(1000).selectExpr("id AS event_id", "id AS at"), "event_id", "at", 0).count()
    held = seen.filters(1)
    assert held.count() <= 128
    placed = seen._placed(spark.range(5000, 9000).selectExpr("CAST(id AS string) AS id"))
    passing = placed.alias("p").join(held.alias("f"), (placed.bucket == held.bucket) & (placed.block == held.block)).filter(
        " AND ".join(f"(p.w{k} & f.w{k}) = p.w{k}" for k in range(8)))
    assert passing.count() < 80
