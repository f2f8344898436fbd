"""What running streams report, kept as a table: one row a micro-batch.

A listener on the driver writes each progress report as a line of JSON into a file of its own in a shared folder; reports are small, and there
is one a micro-batch. ``progress`` reads them as a table: rows read, rows dropped for being later than the watermark, rows in state,
the watermark, and what the stream itself observes (``DataFrame.observe``).
"""

from __future__ import annotations

import threading

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_REPORT = (
    "id string, runId string, name string, batchId bigint, timestamp string, numInputRows bigint, batchDuration bigint, "
    "eventTime map<string, string>, stateOperators array<struct<operatorName: string, numRowsTotal: bigint, numRowsUpdated: bigint, "
    "numRowsDroppedByWatermark: bigint, memoryUsedBytes: bigint>>, observedMetrics map<string, map<string, bigint>>"
)


class Monitor(StreamingQueryListener):
    """Keeps the reports of the session's streams while it is entered: ``with Monitor(spark, path): ...``"""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.running: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> Monitor:
        system, root = pafs.FileSystem.from_uri(self.path)
        system.create_dir(root, recursive=True)
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *problem) -> None:
        # Reports come a little later than the batches; the end of a stream comes after all of its reports.
        with self.changed:
            self.changed.wait_for(lambda: not self.running, timeout=60)
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self.changed:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:  # noqa: N802
        report = event.progress
        system, root = pafs.FileSystem.from_uri(self.path)
        # A repeated batch of another run is another row.
        with system.open_output_stream(f"{root}/{report.runId}-{report.batchId}.json") as out:
            out.write(report.json.replace("\n", " ").encode())

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """Nothing to keep."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.running.discard(str(event.runId))
            self.changed.notify_all()


def progress(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, run_id, name, batch, at, input_rows, dropped_rows, state_rows, watermark, observed) of the reports kept under ``path``.

    ``dropped_rows`` and ``state_rows`` are summed over the stateful operators; a stream without any has 0.
    """
    rows = spark.read.schema(_REPORT).json(path)

    def total(field: str):
        return F.aggregate(F.coalesce("stateOperators", F.array()), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x[field], F.lit(0)))

    return rows.select(
        F.col("id").alias("query_id"), F.col("runId").alias("run_id"), "name", F.col("batchId").alias("batch"), F.col("timestamp").cast("timestamp").alias("at"),
        F.coalesce("numInputRows", F.lit(0)).alias("input_rows"), total("numRowsDroppedByWatermark").alias("dropped_rows"),
        total("numRowsTotal").alias("state_rows"), F.try_element_at("eventTime", F.lit("watermark")).cast("timestamp").alias("watermark"),
        F.col("observedMetrics").alias("observed"))


def per_query(reports: DataFrame) -> DataFrame:
    """(query_id, batches, input_rows, dropped_rows): what came in and what came too late, over all runs of a stream."""
    return reports.groupBy("query_id").agg(F.count_distinct("batch").alias("batches"), F.sum("input_rows").alias("input_rows"),
                                           F.sum("dropped_rows").alias("dropped_rows"))
