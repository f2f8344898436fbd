"""Consistency checks over the lifecycle tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.ordered import with_earlier


def transition_audit(events: DataFrame) -> DataFrame:
    """Every event with the status it leads to, the one before it, and whether that move is allowed.

    A job's first event has no previous status; it is in order when it opens the lifecycle.
    """
    known = events.select("job_id", "event_id", "created_at", "event_type").withColumn(
        "status", R.event_status(F.col("event_type"))
    ).filter(F.col("status").isNotNull())
    previous = with_earlier(known, "job_id", ["created_at", "event_id"], F.col("status"), "previous_status")
    return previous.withColumn("allowed", allowed_step())


def allowed_step():
    opening = F.col("event_type").isin("job.created", "job.requeued")
    return F.when(F.col("previous_status").isNull(), opening).otherwise(
        ~opening & R.can_move(F.col("previous_status"), F.col("status"))
    )


def attempt_sequence(attempts: DataFrame) -> DataFrame:
    """Per job: how many attempts, which numbers are missing or used twice, how many are open or succeeded.

    Counting per (job, number) first keeps every group small; no window over a job is needed.
    """
    per_number = attempts.groupBy("job_id", "attempt_number").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == S.RUNNING).alias("running"),
        F.count_if(F.col("status") == S.SUCCEEDED).alias("won"),
    )
    return per_number.groupBy("job_id").agg(
        F.sum("n").alias("attempts"), F.max("attempt_number").alias("last_number"),
        (F.max("attempt_number") - F.count(F.lit(1))).cast("bigint").alias("missing_numbers"),
        F.count_if(F.col("n") > 1).alias("repeated_numbers"), F.sum("running").alias("open_attempts"),
        F.sum("won").alias("successes"),
    ).withColumn("in_order", (F.col("missing_numbers") == 0) & (F.col("repeated_numbers") == 0)
                 & (F.col("open_attempts") <= 1) & (F.col("successes") <= 1))


def overlapping_attempts(attempts: DataFrame) -> DataFrame:
    """Attempts that began before every earlier one of the same job had ended, whatever their numbers.

    Earlier is by (started_at, attempt_id). ``previous_end`` is the latest end among the earlier ones; an attempt
    without a duration counts as ended where it began.
    """
    ended = F.timestamp_add("MILLISECOND", F.coalesce(F.col("duration_ms"), F.lit(0)), F.col("started_at"))
    placed = with_earlier(attempts, "job_id", ["started_at", "attempt_id"], ended, "previous_end", largest=True)
    return placed.filter(F.col("started_at") < F.col("previous_end"))


def _violations(counted: DataFrame, **rules: Column) -> DataFrame:
    """Several rules over one input, counted in one pass: a row per rule."""
    totals = counted.agg(*[F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias(name) for name, count in rules.items()])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules
    ])))


def audit(jobs: DataFrame, attempts: DataFrame, outbox: DataFrame,
          submissions: DataFrame | None = None, timed: DataFrame | None = None) -> DataFrame:
    """One row per rule with the number of violations.

    Rules that need the same input share one pass over it. ``timed`` has attempts with duration_ms, if those of ``attempts``
    have none.
    """
    def one(broken: Column) -> Column:
        return F.when(broken, 1)

    sequence = _violations(
        attempt_sequence(attempts),
        attempt_claimed_twice=one(F.col("repeated_numbers") > 0),
        attempt_number_missing=one(F.col("missing_numbers") > 0),
        several_open_attempts=one(F.col("open_attempts") > 1),
        several_successes=one(F.col("successes") > 1),
    )
    running = F.col("status") == S.RUNNING
    opened = attempts.filter(running).groupBy("job_id").agg(F.count(F.lit(1)).alias("open_attempts"))
    matched = jobs.filter(running).select("job_id", F.lit(True).alias("is_running")).join(opened, "job_id", "full")
    pairing = _violations(
        matched,
        running_job_without_attempt=one(F.col("open_attempts").isNull()),
        open_attempt_without_running_job=F.when(F.col("is_running").isNull(), F.col("open_attempts")),
    )
    states = _violations(
        jobs,
        unknown_status=one(~R.is_known_status(F.col("status"))),
        running_job_without_owner=one(running & F.col("locked_by").isNull()),
    )
    events = _violations(outbox, unpublished_event=one(F.col("published_at").isNull()))
    parts = [sequence, pairing, states, events]
    lasting = timed if timed is not None else attempts if "duration_ms" in attempts.columns else None
    if lasting is not None:
        parts.append(_violations(overlapping_attempts(lasting), attempts_overlap=F.lit(1)))
    if submissions is not None:
        keyed = submissions.filter(F.col("idempotency_key").isNotNull())
        uses = keyed.groupBy("tenant_id", "idempotency_key").agg(F.count(F.lit(1)).alias("n"))
        parts.append(_violations(uses, idempotency_key_reused=one(F.col("n") > 1)))
    return reduce(DataFrame.unionByName, parts)
