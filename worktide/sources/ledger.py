"""A sink that holds each record of a stream once, whatever tasks, batches or drivers are repeated.

Tasks write Parquet files of their own names. A batch becomes visible with one manifest that lists the files of its committed
tasks; readers follow the manifests. What a killed task or an aborted batch has left is in no manifest, and a batch that comes again
after its manifest was written - from a checkpoint that was not - finds the manifest and leaves its new files out. Manifests are named by
writer and batch, so that several streams may share a ledger.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from worktide.functions import rules as R
from worktide.sources.outlet import envelope

FORMAT = "worktide_ledger"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: a file and its rows; no file where there were no rows."""

    file: str | None
    rows: int


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str):
        self.path, self.writer = path.rstrip("/"), writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _place(self.path)
        name, out, rows = f"parts/{self.writer}-{uuid.uuid4().hex}.parquet", None, 0
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                system.create_dir(f"{root}/parts", recursive=True)
                out = pq.ParquetWriter(system.open_output_stream(f"{root}/{name}"), batch.schema)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is None:
            return Written(None, 0)
        out.close()
        return Written(name, rows)

    def commit(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        system, root = _place(self.path)
        manifest = f"{root}/commits/{self.writer}-{batchId}.json"
        if system.get_file_info(manifest).type != pafs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        system.create_dir(f"{root}/commits", recursive=True)
        kept = [m for m in messages if m and m.file]
        body = json.dumps({"writer": self.writer, "batch": batchId, "files": [m.file for m in kept], "rows": sum(m.rows for m in kept)})
        # Written aside and moved, so that no reader sees half a manifest. Only the stream's driver commits.
        aside = f"{root}/commits/_{uuid.uuid4().hex}"
        with system.open_output_stream(aside) as out:
            out.write(body.encode())
        system.move(aside, manifest)

    def abort(self, messages: list[Written | None], batchId: int) -> None:  # noqa: N803
        system, root = _place(self.path)
        for m in messages:
            if m and m.file and system.get_file_info(f"{root}/{m.file}").type != pafs.FileType.NotFound:
                system.delete_file(f"{root}/{m.file}")


class Ledger(DataSource):
    """``writeStream.format("worktide_ledger")`` with the options path and writer."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> _Writer:  # noqa: N802
        if "path" not in self.options:
            raise ValueError("the ledger needs a path")
        return _Writer(self.options["path"], self.options.get("writer", "stream"))


def write_ledger(stream: DataFrame, path: str, checkpoint: str, writer: str = "stream") -> StreamingQuery:
    """Write an append stream to the ledger, until it has caught up."""
    stream.sparkSession.dataSource.register(Ledger)
    return stream.writeStream.format(FORMAT).option("path", path).option("writer", writer).option("checkpointLocation", checkpoint).outputMode(
        "append").trigger(availableNow=True).start()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(writer, batch, files, rows): the batches of a ledger."""
    return spark.read.schema("writer string, batch bigint, files array<string>, rows bigint").json(f"{path.rstrip('/')}/commits")


def read_ledger(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The records of the committed batches."""
    files = [r["file"] for r in manifests(spark, path).select(F.explode("files").alias("file")).collect()]
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in files]) if files else spark.createDataFrame([], schema)


def relay_ledger(events: DataFrame, path: str, checkpoint: str, ready: Column | None = None, writer: str = "relay") -> StreamingQuery:
    """Publish a stream of outbox rows into a ledger, each once: those not published, and ``ready`` if that is given.

    Rows that are not ready have to be offered by another stream: this one passes over them.
    """
    due = events.filter(F.col("published_at").isNull())
    records = envelope(due if ready is None else due.filter(F.coalesce(ready, F.lit(False))))
    return write_ledger(records.select("key", "value"), path, checkpoint, writer)


def publish_ready(events: DataFrame, as_of: R.Instant) -> Column:
    return R.is_publishable(R.instant_like(as_of, events, "created_at"))
