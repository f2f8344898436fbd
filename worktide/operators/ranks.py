"""Positions of all rows in one order, without a window over all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktide.session import checkpoint_dir


def _free(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def with_positions(df: DataFrame, order: list[Column], position: str = "position", partitions: int | None = None) -> DataFrame:
    """``df`` with each row's position, from 1, in an order that tells all rows apart.

    The rows are cut into ranges of the order, and the cut is fixed in a checkpoint, since it rests on a sample. Each range is
    numbered by itself; the counts of the ranges, one number each, give what comes before it.
    """
    if position in df.columns:
        raise ValueError(f"column {position!r} is there already")
    checkpoint_dir(df.sparkSession)
    part, within, before = (_free(df, n) for n in ("__part", "__within", "__before"))
    cut = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    fixed = cut.withColumn(part, F.spark_partition_id()).checkpoint()
    counts = sorted((r[part], r["count"]) for r in fixed.groupBy(part).count().collect())
    offsets, total = [], 0
    for number, count in counts:
        offsets.append((number, total))
        total += count
    known = df.sparkSession.createDataFrame(offsets or [(0, 0)], f"{part} int, {before} bigint")
    numbered = fixed.withColumn(within, F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    # One row a range.
    placed = numbered.join(F.broadcast(known), part)
    return placed.select(*df.columns, (F.col(before) + F.col(within)).alias(position))
