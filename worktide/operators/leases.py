"""Which leases ran out, from the record of starts, renewals and ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.operators.ordered import with_earlier


def lease_expiries(signals: DataFrame, ttl_seconds: int, until: R.Instant | None = None,
                   signal_id: str = "signal_id") -> DataFrame:
    """(job_id, expired_at) of every lease that was neither renewed nor ended in time.

    ``signals`` has job_id, ts, alive and a unique id. Leases still open after the last signal count
    when they ended before ``until``.
    """
    timed = signals.withColumn("__us", F.unix_micros(F.col("ts").cast("timestamp")))
    ends = F.when(F.col("alive"), F.col("__us") + ttl_seconds * 1_000_000)
    seen = with_earlier(timed, "job_id", ["__us", signal_id], ends, "__until")
    kind = signals.schema["ts"].dataType
    gaps = seen.filter(F.col("__until") < F.col("__us")).select("job_id", F.col("__until").alias("us"))
    if until is not None:
        last = timed.groupBy("job_id").agg(
            F.max("__us").alias("__us"), F.max_by("alive", F.struct("__us", signal_id)).alias("alive"))
        limit = F.unix_micros(R.instant(until).cast("timestamp"))
        left = (F.col("__us") + ttl_seconds * 1_000_000)
        gaps = gaps.unionByName(last.filter(F.col("alive") & (left < limit)).select("job_id", left.alias("us")))
    return gaps.select("job_id", F.timestamp_micros("us").cast(kind).alias("expired_at"))


def worker_sessions(heartbeats: DataFrame, ttl_seconds: int) -> DataFrame:
    """Spans in which a worker was alive: heartbeats less than the TTL apart; a heartbeat is gone once a full TTL has passed.

    Two heartbeats within one TTL-wide slot always belong together, so every worker is first reduced to
    a row per slot, before the shuffle. What one worker can hold then is its time span over the TTL,
    however many heartbeats it sent.
    """
    width = ttl_seconds * 1_000_000
    slots = heartbeats.select("worker_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).groupBy(
        "worker_id", F.floor(F.col("us") / width).alias("slot")
    ).agg(F.min("us").alias("first"), F.max("us").alias("last"), F.count(F.lit(1)).alias("n"))
    by_worker = Window.partitionBy("worker_id").orderBy("slot")
    broken = F.col("first") - F.lag("last").over(by_worker) >= width
    numbered = slots.withColumn("__new", F.coalesce(broken, F.lit(True)).cast("int")).withColumn(
        "session", F.sum("__new").over(by_worker)
    )
    kind = heartbeats.schema["ts"].dataType
    return numbered.groupBy("worker_id", "session").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("heartbeats")
    ).select(
        "worker_id", F.timestamp_micros("first").cast(kind).alias("session_start"),
        F.timestamp_micros(F.col("last") + width).cast(kind).alias("session_end"), "heartbeats",
    )
