"""Quality rules: base statistics per document, and lines that too many documents of a host share.

Lines are normalised (lower case, white space folded) and hashed. Per host, the distinct documents of each line are
counted; exact copies of a text count once. Lines above the limit are removed, and a document that loses more than half
of its words so is rejected. The limit of a host is 5 % of its distinct documents, but 20 at least, so that a few pages of a small
site are no evidence, and 5,000 at most, so that a line on very many pages goes however large the site is. Up to there
the share tells what a site repeats from a text that it holds in many near copies, which a later stage has to judge.

Null texts are empty (and fail the base rules), null hosts are one host, repeated rows get the same verdict, an empty
table gives no rows, and other columns pass through whatever their names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import SPACE, fence, free_name, repeat_word_count, saved, split_words, whole

#: A line is boilerplate when more documents of its host hold it than the share of them, within these bounds.
MIN_DOCUMENTS = 20
HOST_SHARE = 0.05
MAX_DOCUMENTS = 5000
#: Share of its words that a document may lose.
MOST_REMOVED = 0.5
#: The base rules.
MIN_WORDS = 50
MOST_REPEATED_PERCENT = 50


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: F.trim(x, F.lit(SPACE)) != "")


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.lower(F.regexp_replace(F.trim(line, F.lit(SPACE)), r"[\x20\x09-\x0D]+", " ")))


def document_lines(rows: DataFrame, key: Column, host: Column, text: Column) -> DataFrame:
    """One row per different document: (key, host, digest, hashes, sizes), the last two by line.

    Checkpointed: the counts and the marks both read it, and it is small beside the texts.
    """
    body = rows.select(key.alias("key"), host.alias("host"), F.xxhash64(text).alias("digest"), lines_with_words(text).alias("lines"))
    return saved(body.select("key", "host", "digest", F.transform("lines", line_hash).alias("hashes"),
                             F.transform("lines", lambda x: F.size(split_words(x))).alias("sizes"))
                 .dropDuplicates(["key", "host", "digest"]))


def frequent_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS, host_share: float = HOST_SHARE, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(host, line) of the lines above the limit. A hot line is combined before each shuffle."""
    texts = lines.filter(F.size("hashes") > 0).groupBy("host", "digest").agg(F.first("hashes").alias("hashes"))
    each = texts.select("host", F.explode(F.array_distinct("hashes")).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > min_documents)
    hosts = texts.groupBy("host").agg(F.least(F.count("*") * host_share, F.lit(float(max_documents))).alias("limit"))
    hosts = hosts.select(F.col("host").alias("host_"), "limit")
    return (counts.join(hosts, F.col("host").eqNullSafe(F.col("host_"))).filter(F.col("n") > F.col("limit"))
            .select("host", "line"))


def marked_documents(lines: DataFrame, min_documents: int, host_share: float, max_documents: int) -> DataFrame:
    """(at, removed_lines, removed_words, removed) for the documents that lose lines; at: (key, host, digest)."""
    frequent = frequent_lines(lines, min_documents, host_share, max_documents)
    frequent = frequent.select(F.col("host").alias("host_"), F.col("line").alias("line_"))
    each = lines.select("key", "host", "digest", F.explode(F.arrays_zip("hashes", "sizes")).alias("x"))
    each = each.select("key", "host", "digest", F.col("x.hashes").alias("line"), F.col("x.sizes").alias("words"))
    found = each.join(frequent, (F.col("line") == F.col("line_")) & F.col("host").eqNullSafe(F.col("host_")))
    # A set per document: bounded by its own lines.
    return found.groupBy("key", "host", "digest").agg(
        F.count("*").alias("removed_lines"), F.sum("words").alias("removed_words"), F.collect_set("line").alias("removed"),
    ).select(F.struct("key", "host", "digest").alias("at"), "removed_lines", "removed_words", "removed")


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_lines",
          "removed_words")


def judge(docs: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id", min_documents: int = MIN_DOCUMENTS,
          host_share: float = HOST_SHARE, max_documents: int = MAX_DOCUMENTS, name: str = "quality", carry: list[str] | None = None) -> tuple[DataFrame, str]:
    """The columns ``carry`` of ``docs`` (all when not given) with one more, a struct, and that column's name.

    Its fields are ``FIELDS`` and, when the text is carried, text: the text without the removed lines (null stays
    null). Texts that are not carried are not shuffled.
    """
    carry = docs.columns if carry is None else carry
    name, work, marks, at_ = (free_name(docs, x) for x in (name, "work_", "marks_", "at_"))
    body = whole(docs[text])
    marked = marked_documents(document_lines(docs, docs[key], docs[host], body), min_documents, host_share, max_documents)
    marked = marked.select(F.col("at").alias(at_), F.struct("removed_lines", "removed_words", *(["removed"] if text in carry else [])).alias(marks))

    rows = docs.withColumn(work, F.struct(body.alias("b")))
    b = F.col(f"{work}.b")
    rows = rows.withColumn(work, F.struct(b.alias("b"), split_words(b).alias("w"), lines_with_words(b).alias("l")))
    w, ls = F.col(f"{work}.w"), F.col(f"{work}.l")
    rows = rows.select(*[docs[c] for c in dict.fromkeys([*carry, key, host])], F.struct(
        F.xxhash64(b).alias("digest"),
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(b, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        repeat_word_count(w).alias("n_repeat_words"),
        fence().alias("fence"),
    ).alias(work))
    at = F.struct(F.col(key).alias("key"), F.col(host).alias("host"), F.col(f"{work}.digest").alias("digest"))
    # No document is marked twice, so repeated rows stay as many as they are.
    rows = rows.join(marked, F.col(at_).eqNullSafe(at), "left")

    of = {c: F.col(f"{work}.{c}") for c in FIELDS[:5]}
    failed = (of["n_words"] < MIN_WORDS) | (100 * of["n_repeat_words"] > MOST_REPEATED_PERCENT * of["n_words"])
    gone = F.coalesce(F.col(f"{marks}.removed_words"), F.lit(0))
    of |= {"base_failed": failed, "kept": ~failed & (gone <= MOST_REMOVED * of["n_words"]) & (F.col(f"{work}.fence") >= 0),
           "removed_lines": F.coalesce(F.col(f"{marks}.removed_lines"), F.lit(0)), "removed_words": gone}
    if text in carry:
        left = F.filter(F.split(F.col(text), "\n", -1), lambda x: (F.trim(x, F.lit(SPACE)) == "")
                        | ~F.array_contains(F.col(f"{marks}.removed"), line_hash(x)))
        of["text"] = F.when(F.col(marks).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return rows.select(*carry, F.struct(*[v.alias(c) for c, v in of.items()]).alias(name)), name


def quality_report(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id and ``FIELDS``."""
    rows, name = judge(docs, key=key, carry=[key], **options)
    return rows.select(F.col(key).alias("doc_id"), *[F.col(f"{name}.{c}").alias(c) for c in FIELDS])
