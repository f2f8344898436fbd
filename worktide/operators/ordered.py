"""Ordered folds that survive hot keys.

A fold over the rows of a key in order (token bucket, command sequence) is
sequential, yet a single key may hold a large part of all rows. So the rows are range-partitioned on
(key, order) - which cuts a hot key into many chunks - and every chunk is summarized as a function
from the state it starts in to the state it ends in. Composing those functions along the chunks is
tiny work (one row per chunk) and yields the true start state of each chunk, after which all chunks
run in parallel. The sorted rows are checkpointed once so both passes see the same chunks.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from worktide.session import checkpoint_dir


class Fold:
    """A state machine over ordered rows. States and summaries must be JSON-serializable."""

    inputs: Sequence[str] = ()
    outputs: Sequence[T.StructField] = ()

    def start(self, row: tuple):
        """The state before a key's first row."""
        raise NotImplementedError

    def step(self, state, row: tuple) -> tuple[object, tuple]:
        """The state after a row, and the row's output values."""
        raise NotImplementedError

    def unknown(self):
        """The summary of no rows at all: end state equals start state."""
        raise NotImplementedError

    def extend(self, summary, row: tuple):
        """The summary with one more row."""
        raise NotImplementedError

    def resolve(self, summary, state):
        """The end state for a given start state."""
        raise NotImplementedError


class FiniteFold(Fold):
    """A fold whose possible states are known: a run of rows is summarized by trying all of them."""

    states: Sequence[str] = ()

    def unknown(self):
        return {state: state for state in self.states}

    def extend(self, summary, row):
        ends = {end: self.step(end, row)[0] for end in set(summary.values())}
        return {start: ends[end] for start, end in summary.items()}

    def resolve(self, summary, state):
        return summary.get(state, state)


_CHUNK, _KEY, _VALUE, _INSIDE = "__chunk", "__key", "__value", "__inside"


def _rows(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple]:
    return zip(*[batch.column(name).to_pylist() for name in names])


def _summarize(fold: Fold):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = first_key = last_key = None
        opening = None      # state before the first row of the key the chunk ends with
        summary = None      # effect of that key's rows in this chunk
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys = batch.column(_KEY).to_pylist()
            if chunk is None:
                chunk, first_key = batch.column(_CHUNK)[0].as_py(), keys[0]
            # Only the key the chunk ends with can reach into the next chunk.
            begin = len(keys) - 1
            while begin > 0 and keys[begin - 1] == keys[-1]:
                begin -= 1
            fresh = keys[-1] != last_key or begin > 0
            last_key = keys[-1]
            tail = batch.slice(begin)
            for row in _rows(tail, fold.inputs):
                if fresh:
                    opening, summary, fresh = fold.start(row), fold.unknown(), False
                summary = fold.extend(summary, row)
        if chunk is not None:
            yield pa.RecordBatch.from_pydict({
                _CHUNK: pa.array([chunk], pa.int32()), "first_key": [first_key], "last_key": [last_key],
                "opening": [json.dumps(opening)], "summary": [json.dumps(summary)],
            })
    return task


def _chain(fold: Fold):
    def task(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = state = None
        for frame in frames:
            carries = []
            for row in frame.itertuples(index=False):
                carries.append((row[0], key, json.dumps(state)))
                whole = row.first_key == row.last_key == key
                begin = state if whole else json.loads(row.opening)
                key, state = row.last_key, fold.resolve(json.loads(row.summary), begin)
            yield pd.DataFrame(carries, columns=[_CHUNK, "carry_key", "carry_state"])
    return task


def _replay(fold: Fold, names: Sequence[str]):
    types = [to_arrow_type(field.dataType) for field in fold.outputs]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = state = None
        begun = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if not begun:
                key = batch.column("carry_key")[0].as_py()
                state = json.loads(batch.column("carry_state")[0].as_py() or "null")
                begun = True
            produced = []
            for row_key, row in zip(batch.column(_KEY).to_pylist(), _rows(batch, fold.inputs)):
                if row_key != key:
                    key, state = row_key, fold.start(row)
                state, values = fold.step(state, row)
                produced.append(values)
            columns = list(zip(*produced))
            arrays = [batch.column(name) for name in names]
            arrays += [pa.array(values, kind) for values, kind in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *[f.name for f in fold.outputs]])
    return task


def ordered_fold(df: DataFrame, key: str, order: Sequence[str], fold: Fold,
                 chunks: int | None = None) -> DataFrame:
    """Run ``fold`` over the rows of each ``key`` in ``order`` and append its output columns.

    ``order`` must end in something unique per key. Rows whose key is NULL form one group.
    """
    checkpoint_dir(df.sparkSession)
    columns = [key, *order]
    # Never NULL, so that "no key before this chunk" cannot be mistaken for a NULL key.
    keyed = df.withColumn(_KEY, F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")))
    ranged = keyed.repartitionByRange(chunks, *columns) if chunks else keyed.repartitionByRange(*columns)
    sorted_rows = (
        ranged.sortWithinPartitions(*columns)
        .withColumn(_CHUNK, F.spark_partition_id())
        .checkpoint()
    )
    needed = list(dict.fromkeys([_CHUNK, _KEY, *fold.inputs]))
    summaries = sorted_rows.select(*needed).mapInArrow(
        _summarize(fold), f"{_CHUNK} int, first_key string, last_key string, opening string, summary string"
    )
    # One row per chunk, so one task can walk them and the result is safe to broadcast. The exchange
    # keeps the summaries themselves parallel.
    carries = summaries.repartition(1).sortWithinPartitions(_CHUNK).mapInPandas(
        _chain(fold), f"{_CHUNK} int, carry_key string, carry_state string"
    )
    started = sorted_rows.join(F.broadcast(carries), _CHUNK)
    schema = T.StructType([*df.schema.fields, *fold.outputs])
    return started.mapInArrow(_replay(fold, df.columns), schema)


def with_earlier(df: DataFrame, key: str, order: Sequence[str], value: Column, name: str, largest: bool = False,
                 chunks: int | None = None) -> DataFrame:
    """Append ``value`` as it was on the key's previous row in ``order``, or the largest it was on any earlier row.

    NULL on a key's first row. Windows see one chunk of a key at a time; what a chunk hands on to the next is one row
    per key and chunk. ``order`` must end in something unique per key; rows whose key is NULL form one group.
    """
    checkpoint_dir(df.sparkSession)
    columns = [key, *order]
    keyed = df.withColumns({_KEY: F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")), _VALUE: F.struct(value.alias("v"))})
    ranged = keyed.repartitionByRange(chunks, *columns) if chunks else keyed.repartitionByRange(*columns)
    rows = ranged.withColumn(_CHUNK, F.spark_partition_id()).checkpoint()

    def earlier(column: str, window):
        if largest:
            return F.max(column).over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.lag(column).over(window)

    handed = F.max(_VALUE) if largest else F.max_by(_VALUE, F.struct(*order))
    carries = rows.groupBy(_CHUNK, _KEY).agg(handed.alias("handed")).select(
        _CHUNK, _KEY, earlier("handed", Window.partitionBy(_KEY).orderBy(_CHUNK)).alias("carry")
    ).filter(F.col("carry").isNotNull())
    inside = rows.withColumn(_INSIDE, earlier(_VALUE, Window.partitionBy(_CHUNK, _KEY).orderBy(*order)))
    both = F.greatest(_INSIDE, "carry") if largest else F.coalesce(_INSIDE, "carry")
    found = inside.join(carries, [_CHUNK, _KEY], "left").withColumn(_VALUE, both)
    return found.select(*df.columns, F.col(_VALUE)["v"].alias(name))
