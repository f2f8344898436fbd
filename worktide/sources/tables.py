"""Fixed table schemas, typed scans, and moving rows between schema versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktide.functions import states as S

_S, _I, _L, _B, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


JOBS = _schema(
    ("job_id", _S, False), ("name", _S, False), ("job_type", _S, False), ("payload", _S, False),
    ("status", _S, False), ("priority", _I, False), ("run_at", _TS, False), ("locked_until", _TS),
    ("locked_by", _S), ("retry_count", _I, False), ("max_retries", _I, False),
    ("retry_backoff_seconds", _I, False), ("timeout_seconds", _I, False), ("last_error", _S),
    ("created_by", _S), ("created_at", _TS, False), ("updated_at", _TS, False), ("completed_at", _TS),
    ("failed_at", _TS), ("cancelled_at", _TS), ("tenant_id", _S), ("idempotency_key", _S),
    ("request_hash", _S), ("source_dead_letter_id", _S),
)

ATTEMPTS = _schema(
    ("attempt_id", _S, False), ("job_id", _S, False), ("worker_id", _S, False),
    ("attempt_number", _I, False), ("status", _S, False), ("started_at", _TS, False),
    ("completed_at", _TS), ("failed_at", _TS), ("error_message", _S), ("execution_duration_ms", _L),
    ("created_at", _TS, False), ("tenant_id", _S), ("result", _S), ("error_code", _S), ("retryable", _B),
)

DEAD_LETTERS = _schema(
    ("dead_letter_id", _S, False), ("original_job_id", _S, False), ("name", _S, False),
    ("job_type", _S, False), ("payload", _S, False), ("final_error", _S, False),
    ("retry_count", _I, False), ("failed_at", _TS, False), ("created_at", _TS, False),
    ("tenant_id", _S), ("requeued_at", _TS), ("requeued_job_id", _S),
)

EVENTS = _schema(
    ("event_id", _S, False), ("job_id", _S, False), ("event_type", _S, False), ("source", _S, False),
    ("payload", _S, False), ("created_at", _TS, False), ("tenant_id", _S), ("schema_version", _I),
    ("correlation_id", _S), ("causation_id", _S), ("published_at", _TS), ("publish_attempts", _I),
    ("next_publish_at", _TS), ("last_publish_error", _S), ("claimed_by", _S), ("claimed_until", _TS),
)

TENANTS = _schema(
    ("tenant_id", _S, False), ("slug", _S, False), ("name", _S, False), ("created_at", _TS, False),
)

API_CLIENTS = _schema(
    ("client_id", _S, False), ("tenant_id", _S, False), ("name", _S, False), ("key_prefix", _S, False),
    ("key_hash", _S, False), ("role", _S, False), ("enabled", _B, False), ("created_at", _TS, False),
    ("last_used_at", _TS), ("revoked_at", _TS),
)

HEARTBEATS = _schema(("worker_id", _S, False), ("ts", _TS, False))

TABLES = {
    "jobs": JOBS,
    "attempts": ATTEMPTS,
    "dead_letters": DEAD_LETTERS,
    "events": EVENTS,
    "tenants": TENANTS,
    "api_clients": API_CLIENTS,
    "heartbeats": HEARTBEATS,
}

KEYS = {"jobs": "job_id", "attempts": "attempt_id", "dead_letters": "dead_letter_id", "events": "event_id"}

# Columns that schema version 2 added (tenancy, publication state), with the value old rows get.
_ADDED: dict[str, dict[str, object]] = {
    "jobs": {"tenant_id": S.DEFAULT_TENANT, "idempotency_key": None, "request_hash": None,
             "source_dead_letter_id": None},
    "attempts": {"tenant_id": S.DEFAULT_TENANT, "result": None, "error_code": None, "retryable": None},
    "dead_letters": {"tenant_id": S.DEFAULT_TENANT, "requeued_at": None, "requeued_job_id": None},
    "events": {"tenant_id": S.DEFAULT_TENANT, "schema_version": 1, "correlation_id": None,
               "causation_id": None, "published_at": None, "publish_attempts": 0,
               "next_publish_at": None, "last_publish_error": None, "claimed_by": None,
               "claimed_until": None},
}


def load_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a stored table with its fixed schema; nothing is inferred."""
    return spark.read.schema(TABLES[name]).format(fmt).load(path)


def upgrade(df: DataFrame, table: str, default_tenant: object = S.DEFAULT_TENANT) -> DataFrame:
    """Add the version 2 columns a table lacks, filled the way old rows are backfilled.

    Events without a next publication time are due from their creation on.
    """
    kinds = {field.name: field.dataType for field in TABLES[table]}
    missing = {}
    for name, value in _ADDED[table].items():
        if name in df.columns:
            continue
        if name == "tenant_id":
            missing[name] = F.lit(default_tenant)
        elif name == "next_publish_at":
            missing[name] = F.col("created_at")
        else:
            missing[name] = F.lit(value).cast(kinds[name])
    return df.withColumns(missing) if missing else df


def downgrade(df: DataFrame, table: str) -> DataFrame:
    """Drop the version 2 columns again."""
    return df.drop(*_ADDED[table])


def scope(df: DataFrame, tenant_id: object) -> DataFrame:
    """Only one tenant's rows."""
    return df.filter(F.col("tenant_id") == F.lit(tenant_id))
