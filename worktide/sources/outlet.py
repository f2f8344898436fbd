"""Publishing events: the wire envelope, its key, and the sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.functions import rules as R

Writer = Callable[[DataFrame, int], None]

_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def compact(document: Column) -> Column:
    """JSON text without the white space outside its strings; the possessive loops need no stack for long strings."""
    return F.regexp_replace(document, r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|[ \t\r\n]+', "$1")


def can_be_sent(payload: Column) -> Column:
    """No payload at all, or one that is JSON."""
    return payload.isNull() | R.is_json(payload)


def unsendable(events: DataFrame) -> DataFrame:
    """(event_id, reason) of the events that ``envelope`` leaves out."""
    return events.filter(~can_be_sent(F.col("payload"))).select("event_id", F.lit("payload is not valid JSON").alias("reason"))


def envelope(events: DataFrame) -> DataFrame:
    """(key, value) records: the job id, and the event as JSON without empty optional fields.

    The payload stands in it as it was given, but for white space between its parts. Events whose payload is not JSON are left out; see
    ``unsendable``.
    """
    def optional(name: str):
        return F.nullif(F.col(name).cast("string"), F.lit("")) if name in events.columns else F.lit(None).cast("string")

    version = F.col("schema_version") if "schema_version" in events.columns else F.lit(1)
    record = F.struct(
        F.col("event_id").cast("string").alias("event_id"), version.alias("schema_version"),
        F.col("tenant_id").cast("string").alias("tenant_id"), "event_type", "source",
        F.lit("job").alias("entity_type"), F.col("job_id").cast("string").alias("entity_id"),
        F.date_format(F.col("created_at").cast("timestamp"), _TIME).alias("occurred_at"),
        optional("correlation_id").alias("correlation_id"), optional("causation_id").alias("causation_id"),
    )
    head = F.to_json(record)
    value = F.when(F.col("payload").isNull(), head).otherwise(
        F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"payload":'), compact(F.col("payload")), F.lit("}")))
    return events.filter(can_be_sent(F.col("payload"))).select(
        F.col("job_id").cast("string").alias("key"), value.alias("value"), "event_id", "created_at"
    )


def publish(events: DataFrame, writer: Writer, batch_id: int = 0) -> None:
    """Hand the events to a sink, sorted by entity and time.

    An entity with very many events is cut into ranges that are written in parallel: order holds within
    each range, and the records carry occurred_at and event_id for consumers that need all of it.
    """
    records = envelope(events)
    ordered = records.repartitionByRange("key", "created_at", "event_id").sortWithinPartitions(
        "key", "created_at", "event_id"
    )
    writer(ordered.select("key", "value"), batch_id)


def file_writer(path: str, fmt: str = "parquet") -> Writer:
    """Each batch goes to its own folder, so a repeated batch replaces itself."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch={batch_id}")
    return write


def noop_writer(df: DataFrame, batch_id: int) -> None:
    df.write.format("noop").mode("overwrite").save()


def broker_writer(servers: str, topic: str) -> Writer:
    """Write to a message broker with full acknowledgement; needs Spark's Kafka connector on the class path."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option(
            "kafka.acks", "all"
        ).save()
    return write
