"""API access: who a request comes from, client registration and revocation, last use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.functions import states as S


def digest_clients(clients: DataFrame) -> DataFrame:
    """Clients with the digest and display prefix of their key instead of the key itself."""
    return clients.withColumns({
        "key_hash": R.key_digest(F.col("api_key")), "key_prefix": R.key_prefix(F.col("api_key")),
    }).drop("api_key")


def _active(clients: DataFrame) -> DataFrame:
    revoked = F.col("revoked") if "revoked" in clients.columns else F.col("revoked_at").isNotNull()
    return clients.filter(F.col("enabled") & ~revoked)


def resolve_principals(requests: DataFrame, clients: DataFrame, tenants: DataFrame) -> DataFrame:
    """Requests with a valid key, the client and tenant behind it, and whether the role suffices.

    ``requests`` has api_key and required_role; ``access`` is OK or FORBIDDEN. Client digests are
    unique, so the join keeps the number of requests; whether a side is broadcast is left to its size.
    """
    known = _active(clients).join(tenants.select("tenant_id", "slug"), "tenant_id").select(
        "key_hash", F.col("client_id").alias("principal_id"), F.col("tenant_id").alias("principal_tenant_id"),
        F.col("slug").alias("tenant_slug"), F.col("name").alias("client_name"), "role",
    )
    keyed = requests.withColumn("key_hash", R.key_digest(F.col("api_key")))
    allowed = R.role_allows(F.col("role"), F.col("required_role"))
    return keyed.join(known, "key_hash").withColumn(
        "access", F.when(allowed, "OK").otherwise("FORBIDDEN")
    ).drop("key_hash", "api_key")


def unauthorized(requests: DataFrame, clients: DataFrame, tenants: DataFrame) -> DataFrame:
    """Requests whose key belongs to no active client."""
    usable = _active(clients).join(tenants.select("tenant_id"), "tenant_id", "left_semi").select("key_hash")
    keyed = requests.withColumn("key_hash", R.key_digest(F.col("api_key")))
    return keyed.join(usable, "key_hash", "left_anti").drop("key_hash", "api_key").withColumn(
        "access", F.lit("UNAUTHORIZED")
    )


def client_last_used(principals: DataFrame) -> DataFrame:
    """When each client was last seen with a valid key."""
    return principals.groupBy(F.col("principal_id").alias("client_id")).agg(F.max("ts").alias("last_used_at"))


def register_clients(registrations: DataFrame, clients: DataFrame, as_of: R.Instant) -> DataFrame:
    """Register clients by key; a key already known gives back the client that holds it.

    ``registrations`` has registration_id, tenant_id, name, role, api_key. Adds client_id, key_hash,
    key_prefix and ``is_new``; a role outside the three known ones is refused with ``error``.
    """
    now = R.instant(as_of)
    hashed = digest_clients(registrations).withColumn(
        "error", F.when(~F.coalesce(F.col("role").isin(*S.ROLES), F.lit(False)), "unknown role")
    )
    owners = hashed.filter(F.col("error").isNull()).groupBy("key_hash").agg(
        F.min("registration_id").alias("__first")
    )
    taken = clients.select("key_hash", F.col("client_id").cast("string").alias("__taken"))
    joined = hashed.join(owners, "key_hash", "left").join(taken, "key_hash", "left")
    fresh = R.derived_id(F.lit("client"), "key_hash")
    valid = F.col("error").isNull()
    return joined.withColumns({
        "client_id": F.when(valid, F.coalesce(F.col("__taken"), fresh)),
        "is_new": valid & F.col("__taken").isNull() & (F.col("registration_id") == F.col("__first")),
        "created_at": now,
    }).drop("__first", "__taken")


def revoke_clients(clients: DataFrame, requested: DataFrame, as_of: R.Instant) -> tuple[DataFrame, DataFrame]:
    """Disable clients for good; returns (changed clients, requests for unknown clients)."""
    wanted = requested.select("client_id").distinct()
    changed = clients.join(wanted, "client_id", "left_semi").withColumns({
        "enabled": F.lit(False), "revoked_at": R.instant(as_of),
    })
    missing = wanted.join(clients.select("client_id"), "client_id", "left_anti").withColumn(
        "reason", F.lit("NOT_FOUND")
    )
    return changed, missing
