"""Reading growing tables as streams, and running a stream until it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from worktide.session import scratch_path

# Files per micro-batch: bounds what one batch - and so one key within it - can hold.
FILES_PER_BATCH = 64


def stream_table(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A folder (or a glob) of files as a stream with a fixed schema."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def drain(stream: DataFrame, name: str = "stream", then: Callable[[], None] | None = None) -> DataFrame:
    """Run an append stream over everything there is now, into files, and return them as a table.

    ``then`` may add to what the stream reads, such as a last row that moves the watermark; the stream goes on with that.
    """
    spark = stream.sparkSession
    target, state = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    for more in (None, then) if then else (None,):
        if more:
            more()
        running = stream.writeStream.outputMode("append").format("parquet").option("path", target).option(
            "checkpointLocation", state
        ).trigger(availableNow=True).start()
        running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def zoned(df: DataFrame, *columns: str) -> DataFrame:
    """Watermarks need zoned timestamps."""
    return df.withColumns({name: df[name].cast("timestamp") for name in columns})


def unzoned(df: DataFrame) -> DataFrame:
    """Zoned timestamps back to plain ones (the session runs in UTC)."""
    return df.withColumns({name: df[name].cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"})
