"""Any page of a sorted table at one cost, through a directory of pages.

The table is stored once in ranges of the order, each a partition of its own. The directory has a row for each range: how many rows
stand before it and how many it holds. A page then reads the one or two ranges it lies in, whatever its number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from worktide.operators.listing import page_number, page_size

_RANGE = "page_range"


@dataclass(frozen=True)
class Directory:
    """A sorted table and its directory, both stored under ``path``."""

    spark: SparkSession
    path: str
    order: tuple[tuple[str, bool], ...]

    def _sorted(self) -> list[Column]:
        return [F.asc(c) if up else F.desc(c) for c, up in self.order]

    def ranges(self) -> DataFrame:
        """(page_range, rows, before): one row a range."""
        return self.spark.read.parquet(f"{self.path}/directory")

    def page(self, number: int = 1, size: int = 20) -> DataFrame:
        """A page in order; empty beyond the last."""
        size = page_size(size)
        skip = (page_number(number) - 1) * size
        held = self.ranges().filter((F.col("before") < skip + size) & (F.col("before") + F.col("rows") > skip)).select(_RANGE, "before").collect()
        table = self.spark.read.parquet(f"{self.path}/rows")
        if not held:
            return table.limit(0).drop(_RANGE)
        # At most as many ranges as the page has rows; in practice one or two.
        first = min(r["before"] for r in held)
        rows = table.filter(F.col(_RANGE).isin([r[_RANGE] for r in held])).drop(_RANGE)
        return rows.orderBy(*self._sorted()).offset(skip - first).limit(size)


def build_directory(df: DataFrame, order: list[tuple[str, bool]], path: str, ranges: int | None = None) -> Directory:
    """Store ``df`` in ranges of ``order`` - (column, ascending), which together tell all rows apart - with its directory."""
    if _RANGE in df.columns:
        raise ValueError(f"column {_RANGE!r} is there already")
    path = path.rstrip("/")
    made = Directory(df.sparkSession, path, tuple(order))
    cut = df.repartitionByRange(ranges, *made._sorted()) if ranges else df.repartitionByRange(*made._sorted())
    cut.withColumn(_RANGE, F.spark_partition_id()).sortWithinPartitions(*made._sorted()).write.mode("overwrite").partitionBy(_RANGE).parquet(f"{path}/rows")
    counts = df.sparkSession.read.parquet(f"{path}/rows").groupBy(_RANGE).agg(F.count("*").alias("rows"))
    # One row a range: a window over them is small.
    before = F.sum("rows").over(Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    counts.withColumn("before", F.coalesce(before, F.lit(0))).write.mode("overwrite").parquet(f"{path}/directory")
    return made
