"""Dropping repeated events however late they come: every id ever seen is kept, and hardly any has to be looked up.

Ids are dealt into hash buckets. Each bucket has its ids, in files, and a Bloom filter in 512-bit blocks, as rows: an id sets six bits
of one block. The ids of a micro-batch meet the filters' rows by (bucket, block); those with a bit that is not set are new. Only
the others are looked up exactly, in the files of their buckets, so that no id is lost and none is dropped wrongly. A bucket's filter
has ``blocks`` blocks for good: beyond their capacity more ids are looked up, and ``rebuild`` makes larger ones.

A micro-batch reads what earlier batches have stored and overwrites its own part, so that a repeated batch gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from worktide.operators.changes import first_per

_WORDS = [f"w{k}" for k in range(8)]
_BITS = 6


class SeenIds:
    """The ids of one kind of event, in a shared folder.

    ``buckets * blocks * 64`` bytes of filters are read by a micro-batch: with the default 64 MB, for about 30 million ids at one look-up in a
    hundred new ids.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, blocks: int = 16_384, compact_every: int = 32):
        if min(buckets, blocks, compact_every) < 1:
            raise ValueError("buckets, blocks and compact_every must be at least 1")
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets, self.blocks, self.compact_every = buckets, blocks, compact_every

    def _placed(self, ids: DataFrame) -> DataFrame:
        """With the bucket, the block, and per word of the block the bits that the id sets."""
        where, bits = F.xxhash64("id"), F.xxhash64("id", F.lit(1))
        place = [F.shiftrightunsigned(bits, 9 * k).bitwiseAND(F.lit(511)).cast("int") for k in range(_BITS)]

        def mask(word: int) -> Column:
            one = F.lit(1).cast("long")
            of = [F.when(F.shiftright(p, 6) == word, F.call_function("shiftleft", one, p.bitwiseAND(F.lit(63)))).otherwise(F.lit(0).cast("long")) for p in place]
            return reduce(lambda a, b: a.bitwiseOR(b), of)

        return ids.select("id", F.pmod(where, F.lit(self.buckets)).cast("int").alias("bucket"),
                          F.pmod(F.shiftright(where, 20), F.lit(self.blocks)).cast("int").alias("block"),
                          *[mask(k).alias(w) for k, w in enumerate(_WORDS)])

    def _stored(self, kind: str, schema: str, before: int) -> DataFrame:
        """What batches before ``before`` have stored."""
        self._make(kind, schema)
        return self.spark.read.schema(f"{schema}, batch bigint").parquet(f"{self.path}/{kind}").filter(F.col("batch") < before)

    def _make(self, kind: str, schema: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)

    _IDS = "id string, bucket int"
    _FILTERS = "bucket int, block int, " + ", ".join(f"{w} bigint" for w in _WORDS)

    def filters(self, before: int) -> DataFrame:
        """The merged filters: one row a block that has a bit."""
        parts = self._stored("filters", self._FILTERS, before)
        # A batch whose number is a multiple of compact_every also stores all filters before it, under the negative of it.
        base = -((before - 1) // self.compact_every) * self.compact_every if before > self.compact_every else 0
        if base < 0:
            parts = self.spark.read.schema(f"{self._FILTERS}, batch bigint").parquet(f"{self.path}/filters").filter(
                (F.col("batch") == base) | ((F.col("batch") >= -base) & (F.col("batch") < before)))
        else:
            parts = parts.filter("batch >= 0")
        return parts.groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])

    def admit(self, rows: DataFrame, id_column: str, order: str, batch: int) -> DataFrame:
        """The rows of the batch whose id was never seen, one for each id (the first by ``order``); null ids pass. Their ids are stored."""
        ids = rows.select(F.col(id_column).cast("string").alias("id")).filter("id IS NOT NULL").distinct()
        placed = self._placed(ids).persist(StorageLevel.DISK_ONLY)
        known = self.filters(batch)
        if batch > 0 and batch % self.compact_every == 0:
            known.write.mode("overwrite").parquet(f"{self.path}/filters/batch={-batch}")
            known = self.spark.read.schema(self._FILTERS).parquet(f"{self.path}/filters/batch={-batch}")
        known = known.select(F.col("bucket").alias("b"), F.col("block").alias("c"), *[F.col(w).alias(f"k{w}") for w in _WORDS])
        met = placed.join(known, (F.col("bucket") == F.col("b")) & (F.col("block") == F.col("c")), "left")
        missing = reduce(lambda a, b: a | b, [F.col(w).bitwiseAND(F.coalesce(f"k{w}", F.lit(0).cast("long"))) != F.col(w) for w in _WORDS])
        judged = met.select("id", "bucket", missing.alias("sure")).persist(StorageLevel.DISK_ONLY)
        maybe = judged.filter(~F.col("sure"))
        needed = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # at most the number of buckets
        stored = self._stored("ids", self._IDS, batch).filter(F.col("bucket").isin(needed)).select("bucket", "id")
        fresh = judged.filter("sure").select("id", "bucket").unionByName(
            maybe.select("id", "bucket").join(stored, ["bucket", "id"], "left_anti") if needed else maybe.select("id", "bucket"))
        target = f"{self.path}/ids/batch={batch}"
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(target)
        # Read back, so that what is stored, what the filter knows and what is returned agree.
        fresh = self.spark.read.schema(self._IDS).parquet(target)
        self._placed(fresh.select("id")).groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS]).write.mode(
            "overwrite").parquet(f"{self.path}/filters/batch={batch}")
        placed.unpersist()
        judged.unpersist()
        named = rows.withColumn("__id", F.col(id_column).cast("string"))
        first = first_per(named.filter("__id IS NOT NULL"), ["__id"], [order])
        new = first.join(fresh.select(F.col("id").alias("__new")), F.col("__id") == F.col("__new"), "left_semi")
        return new.select(*rows.columns).unionByName(rows.filter(F.col(id_column).isNull()))

    def rebuild(self, path: str, blocks: int, batch: int) -> SeenIds:
        """The ids of the batches before ``batch`` under another path with filters of ``blocks`` blocks; it goes on with ``batch``."""
        larger = SeenIds(self.spark, path, self.buckets, blocks, self.compact_every)
        ids = self._stored("ids", self._IDS, batch)
        ids.select("id", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{larger.path}/ids/batch={batch - 1}")
        filters = larger._placed(ids.select("id")).groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])
        base = -((batch - 1) // self.compact_every) * self.compact_every if batch > self.compact_every else batch - 1
        filters.write.mode("overwrite").parquet(f"{larger.path}/filters/batch={base}")
        return larger


def dedupe_forever(events: DataFrame, seen: SeenIds, writer: Callable[[DataFrame, int], None], checkpoint: str,
                   id_column: str = "event_id", order: str = "created_at") -> StreamingQuery:
    """Hand each event of a stream to ``writer`` once, however long after the first a repeat comes; until the stream has caught up."""
    def deliver(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            writer(seen.admit(batch, id_column, order, number), number)
        finally:
            batch.unpersist()

    return events.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
