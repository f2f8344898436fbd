"""Checks on webhook targets: address safety, request method, headers. No network is touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.functions import states as S
from worktide.functions.rules import json_field, trimmed

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def _with_target(rows: DataFrame, url: str) -> DataFrame:
    """Add the pieces of a URL step by step, each a column of its own.

    Separate steps matter: an expression used several times by the next step is computed once per row
    instead of being copied into every use.
    """
    link = F.col(url)
    hextets = r"^(?:0{0,4}:){1,6}ffff:([0-9a-f]{1,4}):([0-9a-f]{1,4})$"

    def half(index: int) -> Column:
        return F.conv(F.regexp_extract("__bare", hextets, index), 16, 10).try_cast("bigint")

    both = half(1) * 65536 + half(2)
    dotted = F.concat_ws(".", *[
        F.shiftright(both, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)
    ])
    return (
        # Generic URI syntax; Java's parser refuses addresses that web clients accept.
        rows.withColumns({
            "__scheme": F.lower(F.regexp_extract(link, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)),
            "__authority": F.regexp_extract(link, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1),
        })
        .withColumn("__server", F.regexp_replace("__authority", "^.*@", ""))
        .withColumn("__unreadable", _unreadable(link))
        # No port, no credentials, no brackets.
        .withColumn("host", F.lower(F.btrim(F.regexp_extract("__server", r"^(\[[^\]]*\]|[^:]*)", 1), F.lit("[]"))))
        .withColumn("__bare", F.substring_index("host", "%", 1))
        # The dotted form of an IPv4 address, also of one written inside an IPv6 address.
        .withColumn("__v4", F.when(F.col("__bare").rlike(rf"^{_DOTTED}$"), F.col("__bare"))
                    .when(F.col("__bare").rlike(rf"^(?:0{{0,4}}:){{1,6}}ffff:{_DOTTED}$"),
                          F.substring_index("__bare", ":", -1))
                    .when(F.col("__bare").rlike(hextets), dotted))
        .withColumn("__octets", F.split("__v4", r"\.").cast("array<int>"))
        .withColumn("__kind", _address_kind())
    )


def _unreadable(link: Column) -> Column:
    """Control characters, a colon before any scheme, a broken escape, or a host or port that cannot be."""
    colon_first = (F.col("__scheme") == "") & link.rlike(r"^[^/?#]*:")
    broken_escape = F.regexp_replace(link, r"\?[^#]*", "").rlike(r"%(?![0-9A-Fa-f]{2})")
    bad_server = ~F.col("__server").rlike(r"^(?:\[[^\]]*\]|[^\s^`{|}\\\[\]:]*)(?::[0-9]*)?$")
    return F.coalesce(link.rlike(r"[\x00-\x1f\x7f]") | colon_first | broken_escape | bad_server, F.lit(False))


def _address_kind() -> Column:
    """PRIVATE or PUBLIC for a literal address, NAME for anything that would have to be resolved."""
    first, second, third = (F.col("__octets")[i] for i in range(3))
    private_v4 = (
        first.isin(10, 127)
        | ((first == 172) & second.between(16, 31))
        | ((first == 192) & (second == 168))
        | ((first == 169) & (second == 254))
        | ((first == 224) & (second == 0) & (third == 0))
        | (F.col("__v4") == "0.0.0.0")
    )
    private_v6 = F.col("__bare").rlike(
        r"^(?:0{0,4}:){1,7}:?0{0,3}1$"      # loopback
        r"|^[0:]+$"                         # unspecified
        r"|^f[cd][0-9a-f]{2}:"              # private
        r"|^fe[89ab][0-9a-f]:"              # link-local
        r"|^ff[0-9a-f]2:"                   # link-local multicast
    )
    v6 = F.col("__bare").rlike(r"^[0-9a-f]*:[0-9a-f:.]*$")
    return (
        F.when(F.col("__v4").isNotNull(), F.when(private_v4, "PRIVATE").otherwise("PUBLIC"))
        .when(v6, F.when(private_v6, "PRIVATE").otherwise("PUBLIC"))
        .otherwise("NAME")
    )


def classify_targets(rows: DataFrame, allowlist: Sequence[str] | DataFrame = (), url: str = "url",
                     allow_private: bool = False) -> DataFrame:
    """Add host, verdict and reason to rows with a URL.

    The allowlist is a few names or a table ``host``. Listed hosts skip the address check; names that
    are not listed stay UNRESOLVED, never SAFE, because nothing is looked up.
    """
    parsed = _with_target(rows, url)
    if isinstance(allowlist, DataFrame):
        listed = allowlist.select(F.lower(trimmed(F.col("host"))).alias("host")).distinct().withColumn("__listed", F.lit(True))
        parsed = parsed.join(listed, "host", "left")
    else:
        names = sorted({name.strip().lower() for name in allowlist})
        parsed = parsed.withColumn("__listed", F.col("host").isin(*names) if names else F.lit(False))
    allowed = F.coalesce("__listed", F.lit(False))
    unreadable = F.col("__unreadable")
    private = (F.col("__kind") == "PRIVATE") & F.lit(not allow_private)
    reason = (
        F.when(unreadable, "webhook URL is invalid")
        .when(~F.coalesce(F.col("__scheme").isin("http", "https"), F.lit(False)), "webhook URL must use http or https")
        .when(F.contains(F.col("__authority"), F.lit("@")), "webhook URL must not contain credentials")
        .when(F.coalesce("host", F.lit("")) == "", "webhook URL requires a host")
        .when(private & ~allowed, "webhook target resolves to a private or local address")
    )
    verdict = (
        F.when(unreadable, "INVALID_URL").when(F.col("reason").isNotNull(), "UNSAFE_WEBHOOK_TARGET")
        .when(allowed, "ALLOWED").when(F.col("__kind") == "NAME", "UNRESOLVED").otherwise("SAFE")
    )
    return parsed.withColumn("reason", reason).withColumn("verdict", verdict).select(
        *rows.columns, "host", "verdict", "reason"
    )


def normal_method(method: Column) -> Column:
    """The request method in upper case, POST when empty, NULL when it is not allowed."""
    cleaned = F.upper(trimmed(F.coalesce(method, F.lit(""))))
    chosen = F.when(cleaned == "", "POST").otherwise(cleaned)
    return F.when(chosen.isin(*S.HTTP_METHODS), chosen)


def canonical_header(name: Column) -> Column:
    """Header-Case; a name with characters no header may have is left as it is."""
    cased = F.replace(F.initcap(F.replace(name, F.lit("-"), F.lit(" "))), F.lit(" "), F.lit("-"))
    return F.when(name.rlike(r"^[!#$%&'*+\-.^_`|~0-9A-Za-z]+$"), cased).otherwise(name)


def clean_headers(headers: Column) -> Column:
    """A header map in canonical case without the reserved ones. Of names that differ only in case the
    last in sort order wins."""
    named = F.transform(F.map_entries(headers), lambda e: F.struct(
        canonical_header(e["key"]).alias("name"), e["key"].alias("key"), e["value"].alias("value")))
    kept = F.sort_array(F.filter(named, lambda e: ~e["name"].isin(*S.RESERVED_HEADERS)))
    # Each next to its successor, so that only the last of equal names stays. The outer transform over
    # a one-element array gives the sorted list a name, so it is computed once.
    paired = F.transform(F.array(kept), lambda k: F.zip_with(
        k, F.slice(k, F.lit(2), F.size(k)), lambda e, after: F.struct(
            e["name"].alias("name"), e["value"].alias("value"),
            after["name"].eqNullSafe(e["name"]).alias("shadowed"))))[0]
    last = F.filter(paired, lambda e: ~e["shadowed"])
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["name"].alias("key"), e["value"].alias("value"))))


_PAYLOAD = "url string, method string, headers map<string,string>, body string, _bad string"


def webhook_calls(jobs: DataFrame, allowlist: Sequence[str] | DataFrame = (), allow_private: bool = False) -> DataFrame:
    """The HTTP call each job's payload describes, or why it cannot be made. Nothing is sent.

    ``jobs`` has job_id, attempt_number and payload. Adds url, method, headers, body, and for refused
    payloads error_code, message and retryable (always false). The headers that identify the job are set
    by the system and cannot be overridden.
    """
    parsed = jobs.withColumn("__call", F.from_json("payload", _PAYLOAD, {"columnNameOfCorruptRecord": "_bad"}))
    unreadable = F.coalesce(F.col("__call").isNull() | F.col("__call._bad").isNotNull(), F.lit(True))
    opened = parsed.select(
        *jobs.columns, unreadable.alias("__bad_payload"), F.col("__call.url").alias("url"),
        F.col("__call.method").alias("__method"), F.col("__call.headers").alias("__headers"), json_field(F.col("payload"), "body", F.col("__call.body")).alias("body"),
    )
    checked = classify_targets(opened, allowlist, allow_private=allow_private).withColumn(
        "method", normal_method(F.col("__method")))
    refused = F.col("verdict").isin("INVALID_URL", "UNSAFE_WEBHOOK_TARGET")
    error = (
        F.when(F.col("__bad_payload"), "INVALID_PAYLOAD").when(refused, F.col("verdict"))
        .when(F.col("method").isNull(), "INVALID_METHOD")
    )
    message = (
        F.when(F.col("__bad_payload"), "webhook payload must be valid JSON").when(refused, F.col("reason"))
        .when(F.col("method").isNull(), "unsupported webhook method")
    )
    own = F.create_map(
        F.lit("X-Scheduler-Job-Id"), F.col("job_id").cast("string"),
        F.lit("X-Scheduler-Attempt"), F.col("attempt_number").cast("string"),
        F.lit("Idempotency-Key"), F.col("job_id").cast("string"),
    )
    # The content type is a default the payload may replace.
    given = F.col("__given")
    typed = F.when(F.map_contains_key(given, "Content-Type"), given).otherwise(
        F.map_concat(given, F.create_map(F.lit("Content-Type"), F.lit("application/json"))))
    empty = F.create_map().cast("map<string,string>")
    usable = ~F.col("__bad_payload")
    return checked.withColumns({
        "error_code": error, "message": message, "__given": F.coalesce(clean_headers(F.col("__headers")), empty),
    }).select(
        *jobs.columns, "url", "host", F.when(usable, F.col("method")).alias("method"),
        F.when(usable, F.map_concat(own, typed)).alias("headers"), "body", "error_code", "message",
        F.when(F.col("error_code").isNotNull(), False).alias("retryable"),
    )
