"""Bulk submission of create requests, with idempotency keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.operators.changes import ChangeSet, event_rows, payload_text

CREATED, REPLAYED, CONFLICT, INVALID = "CREATED", "REPLAYED", "CONFLICT", "INVALID"

_SPREAD = 1024  # how many shuffle groups the rows without a key are spread over


def judge_requests(requests: DataFrame, jobs: DataFrame | None, as_of: R.Instant) -> DataFrame:
    """Every request with its defaults filled in and what becomes of it.

    ``requests`` has seq (arrival order), tenant_id, idempotency_key and the job fields. Adds error,
    request_hash, outcome (CREATED / REPLAYED / CONFLICT / INVALID), job_id, status and owner_seq, the
    request of this batch that owns the key.

    The first valid request of a (tenant, key) owns the key unless a stored job already does. The owner
    is found by an aggregate, so a key that a third of all requests share is combined before the
    shuffle; joining it back is an ordinary equi-join whose hot partition AQE can split.
    """
    now = R.instant_like(as_of, requests, "run_at")
    key = R.empty_to_null(R.trimmed(F.col("idempotency_key")))
    judged = R.with_defaults(requests).withColumn("idempotency_key", key).withColumns({
        "error": R.validation_error(),
        "request_hash": R.request_hash(),
        "status": R.initial_status(F.col("run_at"), now),
    })
    first = judged.filter(F.col("error").isNull() & F.col("idempotency_key").isNotNull()).groupBy(
        "tenant_id", "idempotency_key"
    ).agg(F.min_by(F.struct("request_hash", F.lit(None).cast("string").alias("job_id"), "status", "seq"), "seq").alias("owner"))
    if jobs is not None and "idempotency_key" in jobs.columns:
        stored = jobs.filter(F.col("idempotency_key").isNotNull()).select(
            "tenant_id", "idempotency_key",
            F.struct("request_hash", F.col("job_id").cast("string").alias("job_id"), "status",
                     F.lit(None).cast(requests.schema["seq"].dataType).alias("seq")).alias("stored"),
        )
        first = first.join(stored, ["tenant_id", "idempotency_key"], "left").select(
            "tenant_id", "idempotency_key", F.coalesce("stored", "owner").alias("owner")
        )
    # Requests without a key, and invalid ones, match no owner; spread them so that they do not all
    # hash to one task.
    usable = F.col("idempotency_key").isNotNull() & F.col("error").isNull()
    lane = F.when(usable, F.lit(0)).otherwise(1 + F.pmod(F.xxhash64("seq"), F.lit(_SPREAD)))
    joined = judged.withColumn("__lane", lane.cast("int")).join(
        first.withColumn("__lane", F.lit(0)), ["tenant_id", "idempotency_key", "__lane"], "left"
    ).drop("__lane")
    owned = F.col("owner").isNotNull()
    outcome = (
        F.when(F.col("error").isNotNull(), INVALID)
        .when(~owned | F.coalesce(F.col("owner.seq") == F.col("seq"), F.lit(False)), CREATED)
        .when(F.col("owner.request_hash") == F.col("request_hash"), REPLAYED)
        .otherwise(CONFLICT)
    )
    # The id of a job made by this batch follows from the request that made it.
    made = R.derived_id(F.lit("job"), "tenant_id", F.coalesce("owner.seq", "seq"), now)
    return joined.withColumn("outcome", outcome).withColumns({
        "job_id": F.when(F.col("outcome").isin(CREATED, REPLAYED), F.coalesce("owner.job_id", made)),
        "status": F.when(F.col("outcome") == CREATED, F.col("status"))
        .when(F.col("outcome") == REPLAYED, F.col("owner.status")),
        "owner_seq": F.col("owner.seq"),
    }).drop("owner")


def submit(requests: DataFrame, jobs: DataFrame | None, as_of: R.Instant) -> ChangeSet:
    """Create jobs for the new requests; refused requests are in ``rejects`` with the reason."""
    now = R.instant_like(as_of, requests, "run_at")
    decisions = judge_requests(requests, jobs, as_of).withColumn("now", now)
    created = F.col("outcome") == CREATED
    author = F.col("created_by") if "created_by" in requests.columns else F.lit(None).cast("string")

    def new_jobs(d: DataFrame) -> DataFrame:
        return d.filter(created).select(
            "job_id", "tenant_id", "name", "job_type", "payload", "status", "priority", "run_at",
            F.lit(0).alias("retry_count"), "max_retries", "retry_backoff_seconds", "timeout_seconds",
            author.alias("created_by"), F.col("now").alias("created_at"), F.col("now").alias("updated_at"),
            F.lit(None).cast("string").alias("locked_by"),
            F.lit(None).cast(d.schema["now"].dataType).alias("locked_until"),
            "idempotency_key", "request_hash",
        )

    def created_events(d: DataFrame) -> DataFrame:
        payload = payload_text(status=F.col("status"), run_at=F.col("run_at"), priority=F.col("priority"))
        return event_rows(d.filter(created), [(F.lit("job.created"), None, payload)], "scheduler-api",
                          F.col("now"), F.col("job_id"), F.col("tenant_id"), F.lit(""))

    refused = decisions.filter(F.col("outcome").isin(CONFLICT, INVALID)).withColumn(
        "reason", F.coalesce("error", F.lit("idempotency key was used for a different request"))
    )
    return ChangeSet(decisions, {"jobs": new_jobs, "events": created_events}, refused)
