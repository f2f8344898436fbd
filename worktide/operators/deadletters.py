"""Dead letters: newest-first listing and one-time requeue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.changes import ChangeSet, event_rows, payload_text, revise


def requeue(dead_letters: DataFrame, requested: DataFrame, as_of: R.Instant,
            run_at: R.Instant | None = None) -> ChangeSet:
    """Create a fresh job for each requested dead letter not requeued before, and link the two.

    ``requested`` has tenant_id and dead_letter_id. The new job gets the standard settings, not those of
    the job it replaces.
    """
    now = R.instant_like(as_of, dead_letters, "failed_at")
    when = now if run_at is None else R.instant_like(run_at, dead_letters, "failed_at")
    keys = ["tenant_id", "dead_letter_id"]
    open_ones = dead_letters.filter(F.col("requeued_at").isNull())
    wanted = requested.select(*keys).distinct()
    decisions = open_ones.join(wanted, keys, "left_semi").select(
        F.struct(*dead_letters.columns).alias("letter"), now.alias("now"), when.alias("run_at"),
    ).withColumn("job_id", R.derived_id(F.lit("requeue"), "letter.dead_letter_id", "now"))
    rejects = wanted.join(open_ones.select(*keys), keys, "left_anti").withColumn("reason", F.lit("NOT_FOUND"))
    payload = "letter.payload" if "payload" in dead_letters.columns else None

    def fresh_jobs(d: DataFrame) -> DataFrame:
        return d.select(
            "job_id", "letter.tenant_id", "letter.name", "letter.job_type",
            (F.col(payload) if payload else F.lit(None).cast("string")).alias("payload"),
            R.initial_status(F.col("run_at"), F.col("now")).alias("status"),
            F.lit(S.DEFAULT_PRIORITY).alias("priority"), "run_at", F.lit(0).alias("retry_count"),
            F.lit(S.DEFAULT_RETRIES).alias("max_retries"),
            F.lit(S.DEFAULT_BACKOFF_SECONDS).alias("retry_backoff_seconds"),
            F.lit(S.DEFAULT_TIMEOUT_SECONDS).alias("timeout_seconds"),
            F.col("now").alias("created_at"), F.col("now").alias("updated_at"),
            F.col("letter.dead_letter_id").alias("source_dead_letter_id"),
        )

    return ChangeSet(
        decisions,
        {
            "jobs": fresh_jobs,
            "dead_letters": lambda d: revise(d, "letter", requeued_at=F.col("now"), requeued_job_id=F.col("job_id")),
            "events": lambda d: event_rows(
                d, [(F.lit("job.requeued"), None, payload_text(source_dead_letter_id=F.col("letter.dead_letter_id")))],
                "scheduler-api", F.col("now"), F.col("job_id"), F.col("letter.tenant_id"), F.lit("")),
        },
        rejects,
    )
