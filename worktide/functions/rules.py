"""Lifecycle rules as pure Column expressions; everything here stays inside codegen.

``now`` is always an explicit instant, never the wall clock, so results can be repeated.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worktide.functions import states as S

Instant = Column | datetime | str


def moment(value: datetime | str) -> datetime:
    """A given instant in UTC, its zone taken off; one without a zone is taken as UTC."""
    value = datetime.fromisoformat(value) if isinstance(value, str) else value
    return value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


def instant(value: Instant, kind: str | T.DataType = "timestamp_ntz") -> Column:
    """A timestamp column from a datetime, a text or a column, independent of local time zones."""
    if isinstance(value, Column):
        return value
    return F.lit(moment(value).isoformat(sep=" ") if isinstance(value, (datetime, str)) else value).cast(kind)


def instant_like(value: Instant, df: DataFrame, column: str) -> Column:
    """An instant of the same timestamp type as ``df[column]``."""
    return instant(value, df.schema[column].dataType)


def add_seconds(moment: Column, seconds: Column | int) -> Column:
    amount = F.lit(seconds) if isinstance(seconds, int) else seconds
    return F.timestamp_add("SECOND", amount.cast("bigint"), moment)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- which rows are ready -----------------------------------------------------------------


def lease_free(lease: Column, now: Column) -> Column:
    """No lease, or one that ended strictly before ``now``."""
    return lease.isNull() | (lease < now)


def is_due(now: Column) -> Column:
    return (
        F.col("status").isin(*S.CLAIMABLE)
        & (F.col("run_at") <= now)
        & lease_free(F.col("locked_until"), now)
    )


def is_expired(now: Column) -> Column:
    """A RUNNING job past its lease; one without a lease end never expires."""
    return (F.col("status") == S.RUNNING) & (F.col("locked_until") < now)


def is_publishable(now: Column) -> Column:
    return (
        F.col("published_at").isNull()
        & (F.col("next_publish_at") <= now)
        & lease_free(F.col("claimed_until"), now)
    )


def is_live(now: Column, ttl_seconds: int, seen: Column | str = "last_heartbeat") -> Column:
    """A heartbeat key written at ``seen`` is gone once a full TTL has passed."""
    return (_col(seen) <= now) & (add_seconds(_col(seen), ttl_seconds) > now)


# --- requests -----------------------------------------------------------------------------


def with_defaults(df: DataFrame) -> DataFrame:
    """Zero means "not given": fill in the default before anything is checked."""
    filled = {
        "priority": S.DEFAULT_PRIORITY,
        "max_retries": S.DEFAULT_RETRIES,
        "retry_backoff_seconds": S.DEFAULT_BACKOFF_SECONDS,
        "timeout_seconds": S.DEFAULT_TIMEOUT_SECONDS,
    }
    return df.withColumns(
        {name: F.coalesce(F.nullif(F.col(name), F.lit(0)), F.lit(value)) for name, value in filled.items()}
    )


# The characters of Unicode white space.
_WHITE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")


def trimmed(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.trim(text, F.lit(_WHITE))


_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_json(text: Column) -> Column:
    """Whether a text is one JSON value; repeated keys are allowed, which a variant does not take.

    What is no variant is read as the only element of an array and as the only field of an object: a text that closes
    either early, or holds more than one value, fails in one of them.
    """
    element = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _STRICT)
    field = F.from_json(F.concat(F.lit('{"a":'), text, F.lit("}")), "a string, bad string",
                        _STRICT | {"columnNameOfCorruptRecord": "bad"})
    alone = (F.size(element) == 1) & field["bad"].isNull()
    return F.coalesce(F.when(F.try_parse_json(text).isNotNull(), True).otherwise(alone), F.lit(False))


def is_json_document(payload: Column) -> Column:
    return is_json(payload) & F.coalesce(payload != "null", F.lit(False))


def json_field(document: Column, name: str, text: Column) -> Column:
    """A field as JSON text, where ``text`` is the field read as a string: strings get their quotes back."""
    value = F.try_variant_get(F.try_parse_json(document), f"$.{name}", "variant")
    quoted = F.when(F.schema_of_variant(value) == "STRING", F.to_json(value))
    return F.coalesce(F.when(document.rlike(rf'"{name}"\s*:\s*"'), quoted), text)


def is_supported_type(job_type: Column) -> Column:
    return F.coalesce(job_type.isin(*S.JOB_TYPES), F.lit(False))


def is_known_status(status: Column) -> Column:
    return F.coalesce(status.isin(*S.STATUSES), F.lit(False))


def validation_error() -> Column:
    """The message of the first broken rule of a create request, NULL when it is valid."""
    blank = F.coalesce(trimmed(F.col("name")), F.lit("")) == ""
    return (
        F.when(F.octet_length(trimmed(F.col("idempotency_key"))) > S.KEY_BYTES,
               "Idempotency-Key exceeds 255 characters")
        .when(blank, "name is required")
        .when(~is_supported_type(F.col("job_type")), "unsupported job type")
        .when(~is_json_document(F.col("payload")), "payload must be valid JSON")
        .when(F.col("run_at").isNull(), "run_at is required")
        .when(~F.col("priority").between(0, S.HIGHEST_PRIORITY), "priority must be between 0 and 10")
        .when(F.col("max_retries") < 0, "max_retries must not be negative")
        .when(F.col("retry_backoff_seconds") < 0, "retry_backoff_seconds must not be negative")
        .when(F.col("timeout_seconds") < 0, "timeout_seconds must not be negative")
    )


def initial_status(run_at: Column, now: Column) -> Column:
    return F.when(run_at > now, S.SCHEDULED).otherwise(S.PENDING)


def request_hash() -> Column:
    """A fingerprint over the fields that change what a job does; only equality matters."""
    fields = ("name", "job_type", "payload", "run_at", "priority", "max_retries",
              "retry_backoff_seconds", "timeout_seconds")
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


# --- failures and retries -----------------------------------------------------------------


def backoff_seconds(base: Column, attempt: Column) -> Column:
    """``base * 2^(attempt-1)``, held at the longest delay that can be represented."""
    base = F.when(base <= 0, S.DEFAULT_BACKOFF_SECONDS).otherwise(base)
    doublings = F.greatest(attempt, F.lit(1)) - 1
    raw = base.cast("double") * F.pow(F.lit(2.0), doublings.cast("double"))
    return F.least(raw, F.lit(float(S.BACKOFF_CEILING_SECONDS))).cast("bigint")


def next_retry_at(now: Column, base: Column, attempt: Column) -> Column:
    return add_seconds(now, backoff_seconds(base, attempt))


def budget_spent(retry_count: Column, max_retries: Column) -> Column:
    return retry_count >= max_retries


def decide_failure(
    now: Column,
    retryable: Column | None = None,
    retry_after: Column | None = None,
) -> Column:
    """What a failed attempt leads to: struct(status, retry_count, run_at).

    A permanent error goes straight to the dead letters, still counting the attempt. A positive
    ``retry_after`` replaces the backoff, on the retry branch only.
    """
    count = F.col("retry_count") + 1
    dead = count > F.col("max_retries")
    if retryable is not None:
        dead = dead | ~F.coalesce(retryable, F.lit(True))
    at = next_retry_at(now, F.col("retry_backoff_seconds"), count)
    if retry_after is not None:
        at = F.when(retry_after > 0, add_seconds(now, retry_after)).otherwise(at)
    return F.struct(
        F.when(dead, S.DEAD_LETTERED).otherwise(S.RETRY_SCHEDULED).alias("status"),
        count.alias("retry_count"),
        F.when(~dead, at).alias("run_at"),
    )


def publish_delay_seconds(attempts: Column) -> Column:
    """Seconds before the next publication try, from the number of tries already made."""
    return F.least(
        F.lit(float(S.PUBLISH_BACKOFF_CEILING_SECONDS)), F.pow(F.lit(2.0), attempts.cast("double"))
    ).cast("bigint")


# --- state machine ------------------------------------------------------------------------


def can_move(before: Column, after: Column) -> Column:
    allowed = [(before == start) & after.isin(*ends) for start, ends in S.MOVES.items()]
    return F.coalesce(reduce(or_, allowed), F.lit(False))


def command_target(command: Column) -> Column:
    return reduce(lambda expr, item: expr.when(command == item[0], item[1][0]),
                  list(S.COMMANDS.items())[1:],
                  F.when(command == "cancel", S.COMMANDS["cancel"][0]))


def command_allowed(command: Column, status: Column) -> Column:
    """Both guards: the command's own list of statuses and the table of moves."""
    listed = [(command == name) & status.isin(*sources) for name, (_, sources) in S.COMMANDS.items()]
    return F.coalesce(reduce(or_, listed), F.lit(False)) & can_move(status, command_target(command))


def lifecycle_event(status: Column) -> Column:
    return F.concat(F.lit("job."), F.lower(status))


def event_status(event_type: Column) -> Column:
    pairs = [F.lit(part) for pair in S.EVENT_STATUS.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), event_type)


# --- outcomes -----------------------------------------------------------------------------


def classify_error(kind: Column, code: Column, retryable: Column, message: Column) -> Column:
    """struct(error_code, retryable, message) of an error.

    ``kind`` is 'typed' for an error that carries its own code, 'timeout', 'cancelled' or anything else.
    """
    typed = F.coalesce(kind == "typed", F.lit(False))
    return F.struct(
        F.when(typed, code).when(kind == "timeout", "TIMEOUT").when(kind == "cancelled", "CANCELLED")
        .otherwise("HANDLER_ERROR").alias("error_code"),
        F.when(typed, retryable).otherwise(True).alias("retryable"),
        message.alias("message"),
    )


def http_succeeded(status: Column) -> Column:
    return status.between(200, 299)


def http_retryable(status: Column) -> Column:
    return ~http_succeeded(status) & (status.isin(408, 429) | (status >= 500))


def retry_after_seconds(header: Column) -> Column:
    """A Retry-After header in whole seconds: unreadable or negative counts as 0, capped at 15 minutes."""
    text = trimmed(header)
    number = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    # All digits but too long for a number is unreadable, like any other bad header.
    return F.least(F.lit(S.RETRY_AFTER_CEILING_SECONDS), F.greatest(F.lit(0), F.coalesce(number, F.lit(0)))).cast("int")


def http_outcome(status: Column, retry_after: Column) -> Column:
    """struct(succeeded, error_code, retryable, message, retry_after_seconds) of a webhook response.

    No status means that no response came: a network error, which may be retried.
    """
    ok, silent = F.coalesce(http_succeeded(status), F.lit(False)), status.isNull()
    return F.struct(
        ok.alias("succeeded"),
        F.when(silent, "WEBHOOK_NETWORK_ERROR").when(~ok, "WEBHOOK_HTTP_ERROR").alias("error_code"),
        F.when(silent, True).when(~ok, http_retryable(status)).alias("retryable"),
        F.when(silent, "webhook gave no response")
        .when(~ok, F.concat(F.lit("webhook returned HTTP "), status.cast("string"))).alias("message"),
        F.when(ok, 0).otherwise(retry_after_seconds(retry_after)).alias("retry_after_seconds"),
    )


def execution_outcome(kind: Column, status: Column, retry_after: Column, message: Column) -> Column:
    """The same struct for an execution: an error of ``kind`` with its message, or the response's outcome where kind is null."""
    by_kind = list(S.ERROR_KINDS.items())

    def of(index: int) -> Column:
        other = F.lit(S.OTHER_ERROR[index])
        return reduce(lambda expr, item: expr.when(kind == item[0], F.lit(item[1][index])), by_kind[1:],
                      F.when(kind == by_kind[0][0], F.lit(by_kind[0][1][index]))).otherwise(other)

    failed = F.struct(F.lit(False).alias("succeeded"), of(0).alias("error_code"), of(1).alias("retryable"), message.alias("message"),
                      F.lit(0).alias("retry_after_seconds"))
    return F.when(kind.isNotNull(), failed).otherwise(http_outcome(status, retry_after))


def attempt_result(status: Column, duration_ms: Column, body: Column) -> Column:
    """What an attempt keeps of a response, as JSON: null without one. At most the excerpt's bytes of the body are kept."""
    text = F.coalesce(body, F.lit(""))
    kept = F.struct(duration_ms.cast("bigint").alias("duration_ms"), clip_bytes(text, S.EXCERPT_BYTES).alias("response_excerpt"),
                    is_clipped(text, S.EXCERPT_BYTES).alias("response_truncated"), status.cast("int").alias("status_code"))
    return F.when(status.isNotNull(), F.to_json(kept, {"ignoreNullFields": "false"}))


# --- text, keys and roles -----------------------------------------------------------------


def clip_bytes(text: Column, limit: int) -> Column:
    """The first ``limit`` bytes of a text; a character cut in half becomes the replacement mark."""
    return F.when(F.octet_length(text) <= limit, text).otherwise(
        F.make_valid_utf8(F.substring(F.encode(text, "UTF-8"), 1, limit).cast("string"))
    )


def is_clipped(text: Column, limit: int) -> Column:
    return F.octet_length(text) > limit


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def key_digest(key: Column) -> Column:
    return F.sha2(trimmed(key), 256)


def key_prefix(key: Column) -> Column:
    return F.substring(trimmed(key), 1, S.KEY_PREFIX_CHARS)


def role_rank(role: Column) -> Column:
    pairs = [F.lit(part) for pair in S.ROLES.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), role), F.lit(0))


def role_allows(role: Column, required: Column) -> Column:
    """An unknown required role admits nobody."""
    return (role_rank(required) > 0) & (role_rank(role) >= role_rank(required))


def derived_id(*parts: Column | str) -> Column:
    """An id that is the same on every retry of a task and in every part of one change set.

    Separators within the parts are escaped, so that different parts never meet in one text.
    """
    texts = [F.replace(F.replace(F.coalesce(_col(part).cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
             for part in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)
