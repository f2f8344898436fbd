"""Windowed streams: worker sessions and continuous metrics. The same expressions work on batches.

Rows later than the watermark's delay are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.functions import states as S


def session_stream(heartbeats: DataFrame, ttl_seconds: int, delay: str) -> DataFrame:
    """Spans in which a worker's heartbeats were less than the TTL apart; a heartbeat is gone once a full TTL has passed."""
    live = heartbeats.withWatermark("ts", delay)
    # Session windows also join what is exactly their gap apart.
    gap = f"{ttl_seconds * 1_000_000 - 1} microseconds"
    spans = live.groupBy("worker_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("heartbeats"))
    end = F.timestamp_micros(F.unix_micros("w.end") + 1)
    return spans.select("worker_id", F.col("w.start").alias("session_start"), end.alias("session_end"), "heartbeats")


def metrics_stream(rows: DataFrame, ts: str, by: Sequence[str], size: str, delay: str, slide: str | None = None,
                   seconds: Column | None = None, buckets: Sequence[float] = S.DURATION_BUCKETS) -> DataFrame:
    """Counts, and with ``seconds`` a cumulative duration histogram, per window and group.

    Tumbling windows, or sliding ones when ``slide`` is given. Aggregates are combined before the
    shuffle, so a hot group costs one row per task and window.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    measures = [F.count(F.lit(1)).alias("rows")]
    if seconds is not None:
        measures.append(F.sum(seconds).alias("total_seconds"))
        measures += [F.count_if(seconds <= bound).alias(f"le_{bound:g}".replace(".", "_")) for bound in buckets]
    grouped = rows.withWatermark(ts, delay).groupBy(window.alias("w"), *by).agg(*measures)
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          *[c for c in grouped.columns if c != "w"])
