"""The event relay, and de-duplication on the consumer's side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from worktide.functions import rules as R
from worktide.operators.changes import apply_changes
from worktide.operators.outbox import apply_publish_results, claim_publishable, hold_back, release_unsent
from worktide.session import checkpoint_dir
from worktide.sources.outlet import Writer, can_be_sent, publish


def _results(rows: DataFrame, relay_id: str, error) -> DataFrame:
    return rows.select(F.col("event_id").alias("result_id"), "event_id", F.lit(relay_id).alias("relay_id"),
                       error.isNull().alias("delivered"), error.alias("error"))


def _error(failure: str | None = None, refused: Column | None = None):
    sent = F.lit(failure).cast("string")
    if refused is not None:
        sent = F.coalesce(refused, sent)
    return F.when(~can_be_sent(F.col("payload")), "payload is not valid JSON").otherwise(sent)


def relay_round(outbox: DataFrame, writer: Writer, as_of: R.Instant, relay_id: str = "relay", n: int | None = 50,
                lease_seconds: int = 30, round_id: int = 0, refused: Column | None = None) -> DataFrame:
    """Claim up to ``n`` due events, send them, record what came of it; returns the next outbox.

    Only the unbroken run of a job's oldest unpublished events is claimed, so that events that are not due, backed off or leased hold
    back the later ones of their job, in this round and in all that follow. A failed record is backed off; the later
    events of its job are not sent ahead of it and are given back. An error of the writer fails the whole round.
    ``refused`` gives the error of events that the sink is known to refuse, such as too large ones, and null for the others.
    """
    changed = _round(outbox, writer, as_of, relay_id, n, lease_seconds, round_id, refused)
    return apply_changes(outbox, changed, "event_id")


def _round(outbox, writer, as_of, relay_id, n, lease_seconds, round_id, refused) -> DataFrame:
    checkpoint_dir(outbox.sparkSession)
    claimed = claim_publishable(outbox, as_of, relay_id, n, lease_seconds, in_order=True).checkpoint()
    results = hold_back(_results(claimed, relay_id, _error(refused=refused)), claimed)
    good = claimed.join(results.filter("delivered").select("event_id"), "event_id", "left_semi")
    try:
        publish(good, writer, round_id)
    except Exception as problem:  # Whatever the sink raises is a failed delivery, to be tried again.
        results = hold_back(_results(claimed, relay_id, _error(str(problem) or type(problem).__name__)), claimed)
    done = apply_publish_results(claimed, results, as_of)
    return done.events.unionByName(release_unsent(claimed, results), allowMissingColumns=True).checkpoint()


def relay_rounds(outbox: DataFrame, writer: Writer, instants: Sequence[R.Instant], relay_id: str = "relay", n: int | None = None,
                 lease_seconds: int = 30, refused: Column | None = None) -> DataFrame:
    """One round at each instant; returns the outbox after the last. Rounds read and write only what is unpublished."""
    checkpoint_dir(outbox.sparkSession)
    pending = outbox.filter(F.col("published_at").isNull()).checkpoint()
    settled = outbox.filter(F.col("published_at").isNotNull())
    for number, as_of in enumerate(instants):
        changed = _round(pending, writer, as_of, relay_id, n, lease_seconds, number, refused)
        settled = settled.unionByName(changed.filter(F.col("published_at").isNotNull()), allowMissingColumns=True)
        pending = apply_changes(pending, changed, "event_id").filter(F.col("published_at").isNull()).checkpoint()
    return settled.unionByName(pending, allowMissingColumns=True)


def relay_stream(events: DataFrame, writer: Writer, checkpoint: str, as_of: R.Instant | None = None,
                 record: Writer | None = None, relay_id: str = "relay", later: Writer | None = None) -> StreamingQuery:
    """Publish a stream of outbox rows, batch by batch, until it has caught up.

    Delivery is at least once: a batch that fails after its records were accepted is sent again under
    the same batch id. A sink that replaces by batch id therefore ends up with each record once. With
    ``as_of`` only rows publishable at that instant are sent; a stream offers a row only once, so ``later``
    has to take the unpublished rest, for ``relay_round`` or another run. ``record`` receives the results of
    each batch in the form ``apply_publish_results`` takes; payloads that are not JSON are failures.
    """
    if (as_of is None) != (later is None):
        raise ValueError("as_of and later go together: rows that are not due must be kept")
    ready = F.lit(True) if as_of is None else R.is_publishable(R.instant_like(as_of, events, "created_at"))
    ready = F.coalesce(ready, F.lit(False))

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            due = batch.filter(ready)
            publish(due, writer, batch_id)
            if later is not None:
                later(batch.filter(~ready), batch_id)
            if record is not None:
                record(_results(due, relay_id, _error()), batch_id)
        finally:
            batch.unpersist()

    return events.filter(F.col("published_at").isNull()).writeStream.foreachBatch(deliver).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start()


def dedupe_events(events: DataFrame, delay: str, ts: str = "created_at") -> DataFrame:
    """Drop repeated deliveries of an event that arrive within ``delay`` of each other.

    State is kept per event id, so no key is hot, and is forgotten once the watermark has passed.
    Rows later than the delay are dropped.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["event_id"])
