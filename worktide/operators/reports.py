"""Counts, counters, histograms, quantiles and the dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S


def status_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("tenant_id", "status").agg(F.count(F.lit(1)).alias("jobs"))


def status_rollup(jobs: DataFrame) -> DataFrame:
    """The same with a subtotal per tenant and a grand total (NULL in the rolled-up columns)."""
    return jobs.rollup("tenant_id", "status").agg(F.count(F.lit(1)).alias("jobs"))


def recent_failures(attempts: DataFrame, as_of: R.Instant, by: Sequence[str] = (), hours: int = 24) -> DataFrame:
    """FAILED attempts of the last day. Cancelled attempts also have a failure time but do not count."""
    since = R.add_seconds(R.instant_like(as_of, attempts, "failed_at"), -3600 * hours)
    failed = attempts.filter((F.col("status") == S.FAILED) & (F.col("failed_at") >= since))
    return failed.groupBy(*by).agg(F.count(F.lit(1)).alias("failures"))


def outbox_backlog(outbox: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unpublished events, whether or not a relay holds them."""
    return outbox.groupBy(*by).agg(F.count_if(F.col("published_at").isNull()).alias("backlog"))


def active_workers(heartbeats: DataFrame, as_of: R.Instant, ttl_seconds: int = S.HEARTBEAT_TTL_SECONDS) -> DataFrame:
    """Workers whose last heartbeat up to ``as_of`` has not outlived the TTL."""
    now = R.instant_like(as_of, heartbeats, "ts")
    seen = heartbeats.filter(F.col("ts") <= now).groupBy("worker_id").agg(F.max("ts").alias("last_heartbeat"))
    return seen.filter(R.is_live(now, ttl_seconds)).withColumn("status", F.lit("active"))


def dashboard(jobs: DataFrame, attempts: DataFrame, outbox: DataFrame, heartbeats: DataFrame,
              as_of: R.Instant, ttl_seconds: int = S.HEARTBEAT_TTL_SECONDS) -> DataFrame:
    """One record per tenant: jobs per status, live workers, unpublished events, failures of the last day.

    Every input is reduced to one row per tenant first. Workers are shared by all tenants.
    """
    counts = status_counts(jobs).groupBy("tenant_id").agg(
        F.map_from_entries(F.collect_list(F.struct("status", "jobs"))).alias("status_counts"),
        F.sum("jobs").alias("total_jobs"),
    )
    workers = active_workers(heartbeats, as_of, ttl_seconds).agg(F.count(F.lit(1))).scalar()
    joined = counts.join(outbox_backlog(outbox, ["tenant_id"]), "tenant_id", "full").join(
        recent_failures(attempts, as_of, ["tenant_id"]), "tenant_id", "full"
    )
    return joined.fillna(0, ["total_jobs", "backlog", "failures"]).select(
        "tenant_id", "status_counts", "total_jobs", workers.alias("active_workers"),
        F.col("backlog").alias("outbox_backlog"), F.col("failures").alias("failures_last_24_hours"),
    )


def lifecycle_counters(events: DataFrame, jobs: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Created, claimed, completed, failed and dead-lettered per job type.

    Dead letters from lease recovery are not counted. ``requests`` are judged ones (job_type, outcome): a repeat that was answered
    with the job it had made counts as created once more, as the service counts answers and not rows. Events are reduced per job and kind before they
    meet their job, so a job with a flood of events costs a few rows in the join.
    """
    reduced = events.groupBy("job_id", "event_type", "source").agg(F.count(F.lit(1)).alias("n"))
    typed = reduced.join(jobs.select("job_id", "job_type"), "job_id")

    def total(kind: str, extra: Column | None = None) -> Column:
        hit = F.col("event_type") == kind
        return F.coalesce(F.sum(F.when(hit if extra is None else hit & extra, F.col("n"))), F.lit(0)).cast("bigint")

    counted = typed.groupBy("job_type").agg(
        total("job.created").alias("created"), total("job.started").alias("claimed"),
        total("job.completed").alias("completed"), total("job.failed").alias("failed"),
        total("job.dead_lettered", F.col("source") != "recovery").alias("dead_lettered"),
    )
    if requests is None:
        return counted
    again = requests.filter(F.col("outcome") == "REPLAYED").groupBy("job_type").agg(F.count(F.lit(1)).alias("replays"))
    joined = counted.join(again, "job_type", "full").fillna(0)
    return joined.withColumn("created", F.col("created") + F.col("replays")).drop("replays")


def histogram(df: DataFrame, value: Column, by: Sequence[str], buckets: Sequence[float] = S.DURATION_BUCKETS) -> DataFrame:
    """A cumulative histogram per group in one pass: by..., le, bucket_count, total_count, total_sum."""
    measured = df.select(*by, value.alias("__v")).filter(F.col("__v").isNotNull())
    counts = [F.count_if(F.col("__v") <= bound).alias(f"__b{i}") for i, bound in enumerate(buckets)]
    wide = measured.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_count"), F.sum("__v").alias("total_sum"), *counts
    )
    steps = [F.struct(F.lit(format(bound, "g")).alias("le"), F.col(f"__b{i}").alias("bucket_count"))
             for i, bound in enumerate(buckets)]
    steps.append(F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("bucket_count")))
    return wide.select(*by, "total_count", "total_sum", F.inline(F.array(*steps)))


def duration_histogram(attempts: DataFrame, jobs: DataFrame) -> DataFrame:
    """Execution time of successful attempts per job type."""
    done = attempts.filter(F.col("status") == S.SUCCEEDED).select("job_id", "duration_ms")
    typed = done.join(jobs.select("job_id", "job_type"), "job_id")
    return histogram(typed, F.col("duration_ms") / 1000.0, ["job_type"])


def http_counts(requests: DataFrame) -> DataFrame:
    """Requests by method, route and status; a request no route matched is counted as 'unmatched'."""
    return _routed(requests).groupBy("method", "route", F.col("http_status").alias("status")).agg(
        F.count(F.lit(1)).alias("requests")
    )


def http_latency(requests: DataFrame) -> DataFrame:
    return histogram(_routed(requests), F.col("duration_s"), ["method", "route"])


def _routed(requests: DataFrame) -> DataFrame:
    return requests.withColumn("route", F.coalesce(R.empty_to_null(F.col("route")), F.lit("unmatched")))


def lag_ms(later: str, earlier: str) -> Column:
    """Whole milliseconds between two instants."""
    micros = F.unix_micros(F.col(later).cast("timestamp")) - F.unix_micros(F.col(earlier).cast("timestamp"))
    return F.floor(micros / 1000).cast("bigint")


def publish_counters(outbox: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Deliveries and failed tries. Every try but the delivering one has failed."""
    delivered = F.col("published_at").isNotNull()
    failures = F.greatest(F.col("publish_attempts") - F.when(delivered, 1).otherwise(0), F.lit(0))
    return outbox.groupBy(*by).agg(
        F.count_if(delivered).alias("published"), F.sum(failures).cast("bigint").alias("publish_failures")
    )


def publish_latency(outbox: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Time from creation to publication."""
    done = outbox.filter(F.col("published_at").isNotNull())
    return histogram(done, lag_ms("published_at", "created_at") / 1000.0, by)


def latency_quantiles(df: DataFrame, value: Column, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """p50, p95 and maximum of an integer measure per group.

    Exact quantiles are taken over (value, count) pairs, so memory follows the number of different
    milliseconds and not the number of rows; ``exact=False`` uses a sketch.
    """
    measured = df.select(*by, value.alias("__v")).filter(F.col("__v").isNotNull())
    if exact:
        pairs = measured.groupBy(*by, "__v").agg(F.count(F.lit(1)).alias("__n"))
        q = F.percentile("__v", F.array(F.lit(0.5), F.lit(0.95)), F.col("__n"))
        total = F.sum("__n")
    else:
        pairs = measured
        q = F.percentile_approx("__v", F.array(F.lit(0.5), F.lit(0.95)))
        total = F.count(F.lit(1))
    out = pairs.groupBy(*by).agg(q.alias("q"), F.max("__v").alias("max"), total.alias("rows"))
    return out.select(*by, F.col("q")[0].cast("double").alias("p50"), F.col("q")[1].cast("double").alias("p95"),
                      "max", "rows")


def throughput(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per second between the first and the last instant; NULL when there is only one instant."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    span = (F.max(micros) - F.min(micros)) / 1_000_000.0
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), span.alias("seconds"))
    return out.withColumn("per_second", F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")))
