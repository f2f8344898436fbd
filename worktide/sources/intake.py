"""Create requests as JSON texts: parse, and set aside what cannot be read."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S

# Fixed value: the fields a create request may have.
FIELDS = ("name", "job_type", "payload", "run_at", "priority", "max_retries", "retry_backoff_seconds",
          "timeout_seconds")

# Texts are read as variants first, because a number must not pass for a text.
_SCHEMA = (
    "name variant, job_type variant, payload string, run_at variant, priority int, max_retries int, "
    "retry_backoff_seconds int, timeout_seconds int, _bad string"
)
_RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def parse_requests(lines: DataFrame, body: str = "body") -> DataFrame:
    """Decode a column of JSON bodies. Adds the request fields and ``error``.

    ``error`` is INVALID_JSON for a body over 1 MiB, broken JSON, a field of the wrong type, an unknown
    field or an unreadable time; numbers not given come out as 0, and texts as empty or NULL.
    """
    text = F.col(body)
    # Steps of their own, so that the text is read once for the fields and once for their names.
    parsed = lines.withColumn("__keys", F.json_object_keys(text)).withColumn("__r", F.from_json(text, _SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    unknown = F.size(F.array_except("__keys", F.array(*[F.lit(f) for f in FIELDS]))) > 0
    texts = {name: F.try_variant_get(F.col(f"__r.{name}"), "$", "string") for name in ("name", "job_type", "run_at")}
    mistyped = reduce(or_, [
        ~F.schema_of_variant(F.col(f"__r.{name}")).isin("STRING", "VOID") for name in texts
    ])
    at = texts["run_at"]
    unreadable_time = at.isNotNull() & (~at.rlike(_RFC3339) | at.try_cast("timestamp").isNull())
    bad = (
        text.isNull() | (F.octet_length(text) > S.BODY_BYTES) | F.col("__r._bad").isNotNull()
        | F.col("__keys").isNull() | unknown
        | F.coalesce(mistyped, F.lit(False)) | unreadable_time
    )
    numbers = ("priority", "max_retries", "retry_backoff_seconds", "timeout_seconds")
    return parsed.withColumn("error", F.when(F.coalesce(bad, F.lit(True)), "INVALID_JSON")).select(
        *lines.columns, "error",
        *[F.coalesce(texts[name], F.lit("")).alias(name) for name in ("name", "job_type")],
        R.json_field(text, "payload", R.empty_to_null(F.col("__r.payload"))).alias("payload"),
        at.try_cast("timestamp").alias("run_at"),
        *[F.coalesce(f"__r.{name}", F.lit(0)).alias(name) for name in numbers],
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def quarantine(parsed: DataFrame, *keep: str) -> DataFrame:
    """The bodies that could not be read, with the reason."""
    return parsed.filter(F.col("error").isNotNull()).select(*keep, "error")
