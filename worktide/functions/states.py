"""The lifecycle vocabulary: statuses, allowed moves, operator commands, roles, limits."""

from __future__ import annotations

# The names and numbers below are part of the data contract.
PENDING = "PENDING"
SCHEDULED = "SCHEDULED"
RUNNING = "RUNNING"
SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
RETRY_SCHEDULED = "RETRY_SCHEDULED"
DEAD_LETTERED = "DEAD_LETTERED"
CANCELLED = "CANCELLED"
PAUSED = "PAUSED"

STATUSES = (
    PENDING, SCHEDULED, RUNNING, SUCCEEDED, FAILED,
    RETRY_SCHEDULED, DEAD_LETTERED, CANCELLED, PAUSED,
)

CLAIMABLE = (PENDING, SCHEDULED, RETRY_SCHEDULED)

MOVES: dict[str, tuple[str, ...]] = {
    PENDING: (RUNNING, CANCELLED, PAUSED),
    SCHEDULED: (RUNNING, CANCELLED, PAUSED),
    RUNNING: (SUCCEEDED, FAILED, RETRY_SCHEDULED, DEAD_LETTERED, CANCELLED),
    FAILED: (RETRY_SCHEDULED, DEAD_LETTERED),
    RETRY_SCHEDULED: (RUNNING, CANCELLED, DEAD_LETTERED),
    PAUSED: (SCHEDULED,),
    DEAD_LETTERED: (RETRY_SCHEDULED,),
}

# command -> (resulting status, statuses it may start from)
COMMANDS: dict[str, tuple[str, tuple[str, ...]]] = {
    "cancel": (CANCELLED, (PENDING, SCHEDULED, RETRY_SCHEDULED, RUNNING)),
    "pause": (PAUSED, (PENDING, SCHEDULED)),
    "resume": (SCHEDULED, (PAUSED,)),
    "retry": (RETRY_SCHEDULED, (FAILED,)),
}

JOB_TYPES = ("CALL_WEBHOOK",)

ROLES = {"viewer": 1, "operator": 2, "admin": 3}

# The status a lifecycle event leaves its job in; job.failed is followed by the event that
# says what the failure led to.
EVENT_STATUS = {
    "job.created": PENDING,
    "job.requeued": PENDING,
    "job.started": RUNNING,
    "job.completed": SUCCEEDED,
    "job.failed": FAILED,
    "job.retry_scheduled": RETRY_SCHEDULED,
    "job.dead_lettered": DEAD_LETTERED,
    "job.cancelled": CANCELLED,
    "job.paused": PAUSED,
    "job.scheduled": SCHEDULED,
}

DEFAULT_PRIORITY = 5
DEFAULT_RETRIES = 3
DEFAULT_BACKOFF_SECONDS = 30
DEFAULT_TIMEOUT_SECONDS = 300
DEFAULT_TENANT = "00000000-0000-0000-0000-000000000001"
HIGHEST_PRIORITY = 10
KEY_BYTES = 255
BODY_BYTES = 1 << 20
EXCERPT_BYTES = 4096
ERROR_BYTES = 1000
RETRY_AFTER_CEILING_SECONDS = 900
PUBLISH_BACKOFF_CEILING_SECONDS = 300
KEY_PREFIX_CHARS = 14
HEARTBEAT_TTL_SECONDS = 30
RATE_PER_MINUTE = 120
# The longest delay a signed 64-bit nanosecond duration can hold, in whole seconds.
BACKOFF_CEILING_SECONDS = 9_223_372_036

HTTP_METHODS = ("GET", "POST", "PUT", "PATCH", "DELETE")
RESERVED_HEADERS = (
    "Host", "Content-Length", "X-Scheduler-Job-Id", "X-Scheduler-Attempt", "Idempotency-Key",
)
# Upper bounds, in seconds, of the duration histograms.
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)


def may_move(before: str | None, after: str | None) -> bool:
    return after in MOVES.get(before, ())


def obey(command: str, status: str | None) -> str | None:
    """The status after ``command``, or None when it is refused."""
    target, sources = COMMANDS.get(command, (None, ()))
    return target if status in sources and may_move(status, target) else None

# What an execution that brought no response is reported as: error code, and whether it may be retried. Fixed values.
ERROR_KINDS = {
    "timeout": ("TIMEOUT", True),
    "cancelled": ("CANCELLED", True),
    "network": ("WEBHOOK_NETWORK_ERROR", True),
    "read": ("WEBHOOK_READ_ERROR", True),
    "build": ("REQUEST_BUILD_FAILED", False),
    "method": ("INVALID_METHOD", False),
    "target": ("UNSAFE_WEBHOOK_TARGET", False),
}
OTHER_ERROR = ("HANDLER_ERROR", True)
