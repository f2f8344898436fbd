"""Snapshots of the lifecycle tables: all tables of a batch become visible together.

Files of one batch go below one folder; the manifest naming that folder is written last. Readers only
follow manifests, so a batch that died half-way is never seen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktide.sources.tables import TABLES, load_table


_MANIFEST = "batch string, tables array<string>"


def is_committed(spark: SparkSession, root: str, batch: str) -> bool:
    try:
        return not spark.read.schema(_MANIFEST).json(f"{root.rstrip('/')}/manifests/batch={batch}").isEmpty()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def write_snapshot(spark: SparkSession, root: str, batch: str, tables: Mapping[str, DataFrame],
                   partition_by: Mapping[str, Sequence[str]] | None = None) -> None:
    """Write every table of a batch, then its manifest. A committed batch, which readers may hold, is refused."""
    if is_committed(spark, root, batch):
        raise ValueError(f"batch {batch} is committed already")
    base = f"{root.rstrip('/')}/batches/{batch}"
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format("parquet")
        columns = (partition_by or {}).get(name)
        (writer.partitionBy(*columns) if columns else writer).save(f"{base}/{name}")
    manifest = spark.createDataFrame([(batch, sorted(tables))], _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/manifests/batch={batch}")


def latest_batch(spark: SparkSession, root: str) -> str | None:
    """The newest committed batch; batches are named so that text order is age order."""
    manifests = spark.read.schema(_MANIFEST).option(
        "recursiveFileLookup", "true"
    ).json(f"{root.rstrip('/')}/manifests")
    return manifests.agg(F.max("batch")).first()[0]


def read_snapshot(spark: SparkSession, root: str, table: str, batch: str | None = None,
                  fixed_schema: bool = False) -> DataFrame:
    chosen = batch or latest_batch(spark, root)
    if chosen is None:
        raise FileNotFoundError(f"no committed batch below {root}")
    path = f"{root.rstrip('/')}/batches/{chosen}/{table}"
    return load_table(spark, table, path) if fixed_schema and table in TABLES else spark.read.parquet(path)
