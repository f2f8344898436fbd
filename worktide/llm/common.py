"""Text helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worktide.session import checkpoint_dir, scratch_path

#: The six characters that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\f\r"
_SPACES = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole(text: Column | str) -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def split_words(text: Column) -> Column:
    """The words of a text, in order; none for a blank one."""
    bare = F.trim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _SPACES, -1))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Texts that ``lower`` changes in no other way take the fast path."""
    return F.when(~text.rlike(r"[^\x00-\x7F]"), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def span_words(words: Column, start: Column, n: int) -> list[Column]:
    """``n`` consecutive words from position ``start`` (from 0)."""
    return [F.get(words, start + k) for k in range(n)]


def repeat_word_count(words: Column, n: int = 3) -> Column:
    """How many words stand in an ``n``-word window that the text holds twice or more, the first included.

    Each window becomes one long: hash bits above, position below. The longs are sorted; equal neighbours above the
    position bits are repeats. Nothing leaves the row.
    """
    count = F.size(words)
    bits = F.length(F.bin(count.cast("long")))
    keys = F.sort_array(F.transform(
        F.sequence(F.lit(0), count - n),
        lambda i: F.call_function("shiftleft", F.call_function("shiftright", F.xxhash64(*span_words(words, i, n)), bits), bits).bitwiseOR(i.cast("long"))))

    def repeats(sorted_keys: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            return F.call_function("shiftright", F.get(sorted_keys, i), bits) == F.call_function("shiftright", F.get(sorted_keys, j), bits)

        hit = F.filter(F.sequence(F.lit(0), F.size(sorted_keys) - 1),
                       lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        starts = F.transform(hit, lambda i: F.get(sorted_keys, i).bitwiseAND(low))
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(*[p + k for k in range(n)])))))

    # A one-element array carries the sorted keys, so that they are made once.
    return F.when(count < n, F.lit(0)).otherwise(F.get(F.transform(F.array(keys), repeats), F.lit(0))).cast("long")


def free_name(df: DataFrame, base: str) -> str:
    """A column name starting with ``base`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def fence() -> Column:
    """A value of at least 0 that keeps the optimizer from moving a filter on it below the projection that makes it.

    Without it, a filter would carry the splitting of the text into lambdas and run it for each word.
    """
    return F.monotonically_increasing_id()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: for what is too wide for a checkpoint."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
