"""The event outbox: what can be published, what publishing led to, replay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.changes import ChangeSet, guarded_join, revise


ORDER = ("created_at", "event_id")


def publishable(outbox: DataFrame, as_of: R.Instant, n: int = 50) -> DataFrame:
    """The next ``n`` events to publish, oldest first."""
    if n < 1:
        raise ValueError("n must be at least 1")
    now = R.instant_like(as_of, outbox, "created_at")
    return outbox.filter(R.is_publishable(now)).orderBy(*ORDER).limit(n)


def frontier(outbox: DataFrame, as_of: R.Instant) -> DataFrame:
    """(job_id, blocked_from) of the jobs with an unpublished event that cannot go out now: leased, backed off or not due.

    From the oldest of these on, the job's events have to wait. An aggregate: a hot job is combined before the shuffle.
    """
    now = R.instant_like(as_of, outbox, "created_at")
    stuck = F.col("published_at").isNull() & F.col("job_id").isNotNull() & ~F.coalesce(R.is_publishable(now), F.lit(False))
    return outbox.filter(stuck).groupBy("job_id").agg(F.min(F.struct(*ORDER)).alias("blocked_from"))


def publishable_in_order(outbox: DataFrame, as_of: R.Instant, n: int | None = 50) -> DataFrame:
    """The next ``n`` events (all, if None) of each job's unbroken run of oldest unpublished ones.

    An event goes out only when every earlier unpublished event of its job can go out with it, so that no round sends an event
    ahead of one that waits. What the limit leaves out is later than what it lets through. Events without a job follow no order.
    """
    now = R.instant_like(as_of, outbox, "created_at")
    wall = frontier(outbox, as_of).select(F.col("job_id").alias("__job"), "blocked_from")
    ready = outbox.filter(R.is_publishable(now)).join(wall, F.col("job_id") == F.col("__job"), "left")
    free = ready.filter(F.col("blocked_from").isNull() | (F.struct(*ORDER) < F.col("blocked_from"))).select(*outbox.columns)
    if n is None:
        return free
    if n < 1:
        raise ValueError("n must be at least 1")
    return free.orderBy(*ORDER).limit(n)


def claim_publishable(outbox: DataFrame, as_of: R.Instant, relay_id: str, n: int | None = 50,
                      lease_seconds: int = 30, in_order: bool = False) -> DataFrame:
    """The same rows with the relay's lease on them; ``in_order`` takes those of ``publishable_in_order``."""
    now = R.instant_like(as_of, outbox, "created_at")
    picked = publishable_in_order(outbox, as_of, n) if in_order else publishable(outbox, as_of, n or 0)
    leased = {"claimed_by": F.lit(relay_id), "claimed_until": R.add_seconds(now, lease_seconds)}
    return picked.withColumns(leased)


def release_unsent(claimed: DataFrame, results: DataFrame) -> DataFrame:
    """The claimed events that nothing was recorded of, given back: their turn comes with that of the event before them."""
    rest = claimed.join(results.select("event_id"), "event_id", "left_anti")
    return rest.withColumns({"claimed_by": F.lit(None).cast("string"), "claimed_until": F.lit(None).cast(claimed.schema["claimed_until"].dataType)})


def apply_publish_results(outbox: DataFrame, results: DataFrame, as_of: R.Instant) -> ChangeSet:
    """Record deliveries and failures, for events the reporting relay still holds.

    ``results`` has result_id, event_id, relay_id, delivered, error.
    """
    now = R.instant_like(as_of, outbox, "created_at")
    applied, rejects = guarded_join(
        results, outbox.filter(F.col("claimed_by").isNotNull()),
        {"event_id": "event_id", "relay_id": "claimed_by"}, "result_id", base_alias="event",
    )
    decisions = applied.select("event", "delivered", "error", now.alias("now"))

    def changed(d: DataFrame) -> DataFrame:
        ok, tries = F.col("delivered"), F.col("event.publish_attempts")
        retry = R.add_seconds(F.col("now"), R.publish_delay_seconds(tries))
        return revise(
            d, "event",
            published_at=F.when(ok, F.col("now")).otherwise(F.col("event.published_at")),
            publish_attempts=tries + 1,
            last_publish_error=F.when(~ok, R.clip_bytes(F.col("error"), S.ERROR_BYTES)),
            next_publish_at=F.when(ok, F.col("event.next_publish_at")).otherwise(retry),
            claimed_by=F.lit(None).cast("string"),
            claimed_until=F.lit(None).cast(d.schema["now"].dataType),
        )

    return ChangeSet(decisions, {"events": changed}, rejects.withColumn("reason", F.lit("LEASE_LOST")))


def replay(outbox: DataFrame, requested: DataFrame, as_of: R.Instant) -> ChangeSet:
    """Make events publishable again, due at once; the number of tries made so far is kept.

    ``requested`` has tenant_id and event_id.
    """
    now = R.instant_like(as_of, outbox, "created_at")
    keys = ["tenant_id", "event_id"]
    wanted = requested.select(*keys).distinct()
    decisions = outbox.join(wanted, keys, "left_semi").select(
        F.struct(*outbox.columns).alias("event"), now.alias("now")
    )
    nothing = F.lit(None).cast(outbox.schema["created_at"].dataType)
    return ChangeSet(
        decisions,
        {"events": lambda d: revise(
            d, "event", published_at=nothing, next_publish_at=F.col("now"),
            last_publish_error=F.lit(None).cast("string"), claimed_by=F.lit(None).cast("string"),
            claimed_until=nothing)},
        wanted.join(outbox.select(*keys), keys, "left_anti").withColumn("reason", F.lit("NOT_FOUND")),
    )


def hold_back(results: DataFrame, outbox: DataFrame) -> DataFrame:
    """Results of one publishing round that may be recorded without breaking an entity's order.

    Once an event fails, later events of the same job are put back rather than delivered ahead of it.
    The first failure per job is an aggregate, so a hot job costs one row in the join.
    """
    placed = results.join(outbox.select("event_id", "job_id", "created_at"), "event_id")
    broken = placed.filter(~F.col("delivered")).groupBy("job_id").agg(
        F.min(F.struct("created_at", "event_id")).alias("__broken")
    )
    return placed.join(broken, "job_id", "left").filter(
        F.col("__broken").isNull() | (F.struct("created_at", "event_id") <= F.col("__broken"))
    ).select(*results.columns)
