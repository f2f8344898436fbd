"""Change sets: the rows a batch of changes adds or replaces, and how they are applied.

A row-locking store updates one row at a time and reports "0 rows affected" as a conflict. Here a
batch is one guarded join: what passes the guard is applied, the rest lands in ``rejects``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from worktide.functions import rules as R
from worktide.session import checkpoint_dir
from worktide.sources.tables import KEYS

Projection = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ChangeSet:
    """What one batch decided. ``decisions`` has a row per accepted change; each table's changed rows
    are a projection of it, so writing several tables never decides twice once it is materialized."""

    decisions: DataFrame
    tables: Mapping[str, Projection] = field(default_factory=dict)
    rejects: DataFrame | None = None

    def _table(self, name: str) -> DataFrame | None:
        return self.tables[name](self.decisions) if name in self.tables else None

    @property
    def jobs(self) -> DataFrame | None:
        return self._table("jobs")

    @property
    def attempts(self) -> DataFrame | None:
        return self._table("attempts")

    @property
    def dead_letters(self) -> DataFrame | None:
        return self._table("dead_letters")

    @property
    def events(self) -> DataFrame | None:
        return self._table("events")

    def materialize(self) -> ChangeSet:
        """Fix the decisions in the shared checkpoint folder before several tables are written from them."""
        checkpoint_dir(self.decisions.sparkSession)
        rejects = self.rejects.checkpoint() if self.rejects is not None else None
        return ChangeSet(self.decisions.checkpoint(), self.tables, rejects)

    def observe(self, observation: Observation) -> ChangeSet:
        """Count accepted changes while they are written; the numbers arrive in ``observation.get``."""
        counted = self.decisions.observe(observation, F.count(F.lit(1)).alias("accepted"))
        return ChangeSet(counted, self.tables, self.rejects)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key. An aggregate rather than a window: rows of a hot key are combined
    before the shuffle, so no task ever holds all of them."""
    rest = [name for name in df.columns if name not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("first")).select(*keys, "first.*")


def last_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [name for name in df.columns if name not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("last")).select(*keys, "last.*")


def guarded_join(
    changes: DataFrame,
    base: DataFrame,
    on: Mapping[str, str],
    change_id: str,
    guard: Column | None = None,
    base_alias: str = "base",
) -> tuple[DataFrame, DataFrame]:
    """Match changes to base rows; return (applied, rejects).

    ``on`` maps change columns to base columns that identify the base row together with its owner, so
    at most one base row answers. Of several changes with the same identity the first wins and the
    rest conflict, whether or not the first one passed the guard of another owner. Applied rows carry
    the change's columns and the base row as a struct named ``base_alias``.
    """
    contenders = first_per(changes, list(on), [change_id])
    target = base if guard is None else base.filter(guard)
    right = target.select(
        F.struct(*target.columns).alias(base_alias),
        *[F.col(theirs).alias(f"__{mine}") for mine, theirs in on.items()],
    )
    condition = [contenders[mine] == right[f"__{mine}"] for mine in on]
    applied = contenders.join(right, condition, "inner").drop(*[f"__{mine}" for mine in on])
    rejects = changes.join(applied.select(change_id), change_id, "left_anti").withColumn(
        "reason", F.lit("CONFLICT")
    )
    return applied, rejects


def apply_changes(base: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """The next snapshot: rows not changed, plus the changed and new ones."""
    kept = base.join(changed.select(key), key, "left_anti")
    return kept.unionByName(changed, allowMissingColumns=True)


def apply_change_set(tables: Mapping[str, DataFrame], change: ChangeSet) -> dict[str, DataFrame]:
    """Apply every table of a change set; tables it does not touch stay as they are."""
    after = dict(tables)
    for name in change.tables:
        changed = change._table(name)
        after[name] = apply_changes(after[name], changed, KEYS[name]) if name in after else changed
    return after


def revise(df: DataFrame, row: str, **updates: Column) -> DataFrame:
    """Rows of the struct column ``row`` with some fields replaced or added."""
    return df.select(
        *[
            (updates[name] if name in updates else F.col(row)[name]).alias(name)
            for name in df.schema[row].dataType.names
        ],
        *[value.alias(name) for name, value in updates.items() if name not in df.schema[row].dataType.names],
    )


def event_rows(
    df: DataFrame,
    emitted: Sequence[tuple[Column, Column | None, Column]],
    source: str,
    now: Column,
    job_id: Column,
    tenant_id: Column,
    discriminator: Column,
) -> DataFrame:
    """Outbox rows for every change; ``emitted`` lists (event type, condition, payload text)."""
    entries = [
        F.when(F.lit(True) if condition is None else condition,
               F.struct(kind.alias("event_type"), payload.alias("payload")))
        for kind, condition, payload in emitted
    ]
    exploded = df.select(
        job_id.alias("job_id"), tenant_id.alias("tenant_id"), discriminator.alias("__mark"),
        now.alias("created_at"),
        F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("__event"),
    )
    return exploded.select(
        R.derived_id("job_id", "__mark", F.col("__event.event_type"), "created_at").alias("event_id"),
        "job_id", "tenant_id", "__event.event_type", F.lit(source).alias("source"),
        F.lit(1).alias("schema_version"), "__event.payload", "created_at",
        F.lit(None).cast(exploded.schema["created_at"].dataType).alias("published_at"),
        F.lit(0).alias("publish_attempts"), F.col("created_at").alias("next_publish_at"),
        F.lit(None).cast(exploded.schema["created_at"].dataType).alias("claimed_until"),
        F.lit(None).cast("string").alias("claimed_by"),
    )


def payload_text(**fields: Column) -> Column:
    return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))
