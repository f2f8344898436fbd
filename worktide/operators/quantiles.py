"""Exact quantiles by selection, and mergeable sketches of them.

Selection narrows, for each wanted rank of each group, an interval that holds it: every pass counts the values of the interval in
``SPLITS`` equal parts and keeps the part with the rank. Counts are combined before the shuffle, so that a hot group is a few hundred
rows in it; whatever the values, no group is in one task. A range of 64 bits needs at most eight passes, microseconds of a day four.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktide.session import checkpoint_dir

SPLITS = 1024
#: Up to so many groups the intervals (a few short rows a group) are broadcast; beyond, joined by group.
BROADCAST_GROUPS = 20_000


def exact_quantiles(df: DataFrame, value: Column, probabilities: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """by..., rows, quantiles (an array of doubles in the order of ``probabilities``): linear between the two nearest ranks.

    ``value`` is a whole number; nulls do not count, and groups without values are left out. Null groups are groups.
    """
    if not probabilities or not all(0 <= p <= 1 for p in probabilities):
        raise ValueError("probabilities lie between 0 and 1")
    checkpoint_dir(df.sparkSession)
    by = list(by)
    keyed = df.select(F.struct(*by, F.lit(0).alias("__")).alias("g"), value.cast("bigint").alias("v")).filter("v IS NOT NULL")
    ends = keyed.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    # The ranks from 1 on of the two values on either side of each probability, and how far between them it lies.
    at = F.array(*[F.lit(float(p)) * (F.col("n") - 1) for p in probabilities])
    placed = ends.withColumn("at", at).checkpoint()
    ranks = placed.select("g", "low", "high", F.explode(F.array_distinct(F.flatten(F.transform("at", lambda x: F.array(
        F.floor(x).cast("bigint") + 1, F.ceil(x).cast("bigint") + 1))))).alias("rank"))
    small = placed.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    # rest: the rank within the interval.
    open_ = ranks.withColumn("rest", F.col("rank")).checkpoint()
    found = None
    while open_.limit(1).count():
        settled = open_.filter("low = high").select("g", "rank", F.col("low").alias("v"))
        found = settled if found is None else found.unionByName(settled)
        left = open_.filter("low < high")
        intervals = left.select(F.col("g").alias("g_"), "low", "high").distinct()
        # Width in a decimal: the ends may be as far apart as a long is wide.
        width = F.ceil((F.col("high").cast("decimal(20,0)") - F.col("low") + 1) / SPLITS).cast("decimal(20,0)")
        intervals = intervals.withColumn("width", width)
        met = keyed.join(F.broadcast(intervals) if small else intervals, F.col("g").eqNullSafe(F.col("g_")) & F.col("v").between(F.col("low"), F.col("high")))
        part = F.floor((F.col("v").cast("decimal(20,0)") - F.col("low")) / F.col("width")).cast("int")
        counts = met.groupBy("g", "low", "high", "width", part.alias("part")).agg(F.count("*").alias("n"))
        # At most SPLITS rows an interval.
        upto = F.sum("n").over(Window.partitionBy("g", "low", "high").orderBy("part"))
        counts = counts.select(F.col("g").alias("g_"), F.col("low").alias("low_"), F.col("high").alias("high_"), "width", "part", "n", upto.alias("upto"))
        hit = left.join(counts, F.col("g").eqNullSafe(F.col("g_")) & (F.col("low") == F.col("low_")) & (F.col("high") == F.col("high_"))
                        & (F.col("rest") <= F.col("upto")) & (F.col("rest") > F.col("upto") - F.col("n")))
        start = F.col("low").cast("decimal(20,0)") + F.col("part") * F.col("width")
        open_ = hit.select("g", "rank", start.cast("bigint").alias("low"),
                           F.least(F.col("high").cast("decimal(20,0)"), start + F.col("width") - 1).cast("bigint").alias("high"),
                           (F.col("rest") - (F.col("upto") - F.col("n"))).alias("rest")).checkpoint()
    if found is None:
        return df.limit(0).select(*by, F.lit(0).cast("bigint").alias("rows"), F.array(F.lit(0.0)).alias("quantiles"))
    values = found.groupBy(F.col("g").alias("g_")).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("of"))
    joined = placed.join(values, F.col("g").eqNullSafe(F.col("g_")))

    def between(x: Column) -> Column:
        low, high = (F.element_at("of", rank.cast("bigint") + 1) for rank in (F.floor(x), F.ceil(x)))
        return F.when(F.floor(x) == F.ceil(x), low.cast("double")).otherwise((F.ceil(x) - x) * low + (x - F.floor(x)) * high)

    return joined.select(*[F.col(f"g.{c}").alias(c) for c in by], F.col("n").alias("rows"), F.transform("at", between).alias("quantiles"))


def window_sketches(df: DataFrame, ts: str, value: Column, width: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., window_start, rows, sketch: a KLL sketch of a whole number for each window, to be stored and merged upward."""
    measured = df.select(*by, F.window(F.col(ts), width)["start"].alias("window_start"), value.cast("bigint").alias("v")).filter("v IS NOT NULL")
    return measured.groupBy(*by, "window_start").agg(F.count("*").alias("rows"), F.kll_sketch_agg_bigint("v").alias("sketch"))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), width: str | None = None) -> DataFrame:
    """The sketches of longer windows, or of all windows, from those of shorter ones."""
    keys = [*by, *([F.window("window_start", width)["start"].alias("window_start")] if width else [])]
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """The sketches' columns with ``quantiles`` in place of the sketch."""
    wanted = F.array(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(p))) for p in probabilities])
    return sketches.withColumn("quantiles", wanted).drop("sketch")
