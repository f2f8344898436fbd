"""A corpus prepared for training: each stage takes the documents that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worktide.llm import decontam, mixing, quality, secrets, simhash
from worktide.llm.common import scratch, table
from worktide.session import prepare


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limit go from those that stay."""
    rows, name = quality.judge(docs)
    text = F.col(f"{name}.text")
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return rows.filter(F.col(f"{name}.kept")).select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints (four-word shingles, 4 bits) the document of the smallest id stays."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blacked out; every document stays."""
    clean = secrets.redact(docs)
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Domain, rate and copies of each document; those without a copy go."""
    return mixing.admit(docs, table(spark, sf_dir, "labels"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secret_scan", secret_scan), ("mix", mix)]

#: Mixing fits a classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
