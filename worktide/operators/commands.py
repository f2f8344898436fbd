"""Operator commands (cancel, pause, resume, retry), any number per job, applied in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktide.functions import rules as R
from worktide.functions import states as S
from worktide.operators.changes import ChangeSet, event_rows, last_per, payload_text, revise
from worktide.operators.ordered import FiniteFold, ordered_fold


class CommandFold(FiniteFold):
    """Each command moves the job, or is refused and leaves it where it was."""

    states = S.STATUSES
    inputs = ("command", "initial_status")
    outputs = (T.StructField("status_before", T.StringType()), T.StructField("status_after", T.StringType()))

    def start(self, row):
        return row[1]

    def step(self, state, row):
        after = S.obey(row[0], state)
        return (after or state), (state, after)


def judge_commands(jobs: DataFrame, commands: DataFrame) -> DataFrame:
    """Every command with the status it met and the one it led to (NULL when refused).

    ``commands`` has command_id, job_id, issued_at, command and, when the caller is bound to a tenant,
    tenant_id; a command for another tenant's job, or for no job at all, is refused.
    """
    on = ["job_id", "tenant_id"] if "tenant_id" in commands.columns else ["job_id"]
    known = jobs.select(*on, F.col("status").alias("initial_status"))
    return ordered_fold(
        commands.join(known, on, "left"), "job_id", ["issued_at", "command_id"], CommandFold()
    )


def judge_single_commands(jobs: DataFrame, commands: DataFrame) -> DataFrame:
    """The same for batches with at most one command per job: one join, no ordering needed.

    A job with several fails the run.
    """
    on = ["job_id", "tenant_id"] if "tenant_id" in commands.columns else ["job_id"]
    known = jobs.select(*on, F.col("status").alias("initial_status"))
    allowed = R.command_allowed(F.col("command"), F.col("initial_status"))
    # The join has brought the commands of a job together already.
    several = F.count(F.lit(1)).over(Window.partitionBy(*on)) > 1
    return commands.join(known, on, "left").withColumn("__several", several).withColumns({
        "status_before": F.col("initial_status"),
        "status_after": F.when(F.col("__several"), F.raise_error(F.lit("a job has several commands")).cast("string"))
        .when(allowed, R.command_target(F.col("command"))),
    }).drop("__several")


def apply_commands(jobs: DataFrame, attempts: DataFrame, commands: DataFrame, as_of: R.Instant,
                   single: bool = False) -> ChangeSet:
    """Apply operator commands; refused ones are rejected with the move they would have been.

    Cancelling also closes the job's open attempts. ``single=True`` states that no job has more than
    one command in the batch and skips the ordered pass.
    """
    now = R.instant_like(as_of, jobs, "run_at")
    judged = (judge_single_commands if single else judge_commands)(jobs, commands)
    accepted = judged.filter(F.col("status_after").isNotNull())
    reason = F.concat(
        F.lit("cannot transition "), F.coalesce(F.col("status_before"), F.lit("?")),
        F.lit(" to "), F.coalesce(R.command_target(F.col("command")), F.lit("?")),
    )
    rejects = judged.filter(F.col("status_after").isNull()).withColumn(
        "reason", F.when(F.col("initial_status").isNull(), "NOT_FOUND").otherwise(reason)
    ).drop("initial_status", "status_before", "status_after")

    def changed_jobs(d: DataFrame) -> DataFrame:
        final = last_per(d.select("job_id", "issued_at", "command_id", "status_after"),
                         ["job_id"], ["issued_at", "command_id"])
        rows = jobs.select(F.struct(*jobs.columns).alias("job")).join(final, F.col("job.job_id") == F.col("job_id"))
        had = F.col("job.cancelled_at") if "cancelled_at" in jobs.columns else F.lit(None).cast(jobs.schema["run_at"].dataType)
        return revise(
            rows, "job", status=F.col("status_after"),
            cancelled_at=F.when(F.col("status_after") == S.CANCELLED, now).otherwise(had),
            locked_by=F.lit(None).cast("string"),
            locked_until=F.lit(None).cast(jobs.schema["run_at"].dataType), updated_at=now,
        )

    def closed_attempts(d: DataFrame) -> DataFrame:
        # A job can be cancelled only once, so this side is unique on the job.
        cancelled = d.filter(F.col("status_after") == S.CANCELLED).select(F.col("job_id").alias("__job"))
        rows = attempts.filter(F.col("status") == S.RUNNING).select(F.struct(*attempts.columns).alias("row")).join(
            cancelled, F.col("row.job_id") == F.col("__job")
        )
        return revise(
            rows, "row", status=F.lit(S.CANCELLED), failed_at=now,
            error_message=F.lit("cancelled by operator"), error_code=F.lit("CANCELLED"), retryable=F.lit(False),
        )

    def emitted(d: DataFrame) -> DataFrame:
        tenants = d if "tenant_id" in d.columns else d.join(jobs.select("job_id", "tenant_id"), "job_id")
        return event_rows(
            tenants,
            [(R.lifecycle_event(F.col("status_after")), None, payload_text(status=F.col("status_after")))],
            "scheduler-api", now, F.col("job_id"), F.col("tenant_id"), F.col("command_id"),
        )

    return ChangeSet(accepted, {"jobs": changed_jobs, "attempts": closed_attempts, "events": emitted}, rejects)
