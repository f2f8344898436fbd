"""Finding where two tables differ by comparing checksums first.

Rows are dealt by a hash of their key into the leaves of a tree. A leaf's checksum does not depend on the order of its rows: their
number, the exclusive or of one hash and the sum of another. Checksums of inner ranges are those of their leaves put
together; where two ranges agree nothing below them is looked at, and only the rows of leaves that differ are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves: 4096, and 64 ranges above them.
LEAF_BITS, RANGE_BITS = 12, 6


def _leaf(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - LEAF_BITS).cast("int")


def checksums(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(leaf, n, mixed, added): at most 4096 rows, combined before the shuffle. To be stored with a table and compared later."""
    # Hashes pass over nulls, so whether a value is null is hashed beside it.
    values = [F.col(key), *[part for c in columns for part in (F.col(c).isNull(), F.col(c))]]
    hashed = rows.select(_leaf(F.col(key)).alias("leaf"), F.xxhash64(F.lit(1), *values).alias("x"), F.xxhash64(F.lit(2), *values).alias("y"))
    return _together(hashed.select("leaf", F.lit(1).alias("n"), F.col("x").alias("mixed"), F.col("y").cast("decimal(38,0)").alias("added")), "leaf")


def _together(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(F.sum("n").alias("n"), F.bit_xor("mixed").alias("mixed"), F.sum("added").alias("added"))


def _unlike(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    other = right.toDF(*[f"{c}_" for c in right.columns])
    same = F.col("n").eqNullSafe(F.col("n_")) & F.col("mixed").eqNullSafe(F.col("mixed_")) & F.col("added").eqNullSafe(F.col("added_"))
    return left.join(other, F.col(by) == F.col(f"{by}_"), "full").filter(~same).select(F.coalesce(by, f"{by}_").alias(by))


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """(leaf) where the checksums of two tables differ: first by range, then by leaf within the ranges that differ."""
    sides = [side.select(F.shiftright("leaf", LEAF_BITS - RANGE_BITS).alias("range"), "leaf", "n", "mixed", "added") for side in (left, right)]
    ranges = F.broadcast(_unlike(*[_together(side, "range") for side in sides], "range"))  # 64 at most
    return _unlike(*[side.join(ranges, "range", "left_semi").select("leaf", "n", "mixed", "added") for side in sides], "leaf")


def differences(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, kind, left, right): rows of one table alone ('left_only', 'right_only') and keys whose ``columns`` differ ('differs').

    ``left`` and ``right`` hold the columns' values. Keys are unique in each table and not null.
    """
    # At most one short row a leaf.
    leaves = F.broadcast(differing_leaves(checksums(left, key, columns), checksums(right, key, columns)))
    sides = [rows.select(F.col(key), F.struct(*columns).alias(name)).withColumn("leaf", _leaf(F.col(key))).join(leaves, "leaf", "left_semi").drop("leaf")
             for rows, name in ((left, "left"), (right, "right"))]
    met = sides[0].join(sides[1], key, "full")
    kind = F.when(F.col("right").isNull(), "left_only").when(F.col("left").isNull(), "right_only").when(~F.col("left").eqNullSafe(F.col("right")), "differs")
    return met.select(key, kind.alias("kind"), "left", "right").filter("kind IS NOT NULL")
