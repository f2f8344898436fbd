"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle check.

A window of an item's number of words is looked at where it shares a five-word shingle with an item at the item's
own offset; no other window can pass the check. Windows and items get a 128-bit SimHash over their words. The
fingerprints are cut into eight blocks: within radius 31 at least one block differs in three bits at most, so items are
indexed under every block value within three bits and windows look up their own eight blocks - no fingerprint within the
radius is missed. What the fingerprints let through is checked exactly: the IDF weight of the distinct shingles both have,
over the larger of the two weights, must reach 0.8. Weights are whole numbers of 2^-40, so that sums do not depend on order.

Near copies of short items can differ in more bits than any radius that is worth an index. So the windows' shingles are
looked up too, and pairs with a common shingle that lie outside the radius take the same check: nothing of similarity 0.8 is lost.

Words are split at ASCII white space, with A-Z in lower case. Items of fewer than five words have their whole sequence
as one shingle. Null or wordless items match nothing, null texts are empty, repeated rows get the same result, empty
tables give no leaks, and other columns are not touched.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import ascii_lower, free_name, saved, span_words, split_words, whole

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 16, 3
#: Every pair within so many bits has a block within BLOCK_RADIUS: 8 * (3 + 1) - 1.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Item tables of up to so many rows, narrow ones but for one shingle each, and so many characters of shingles are broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 16 << 20
#: Up to so many windows (two short numbers each; a document counts as four more) are broadcast.
BROADCAST_WINDOWS = 1_000_000
#: Units of a weight.
UNIT = 1 << 40


def fingerprint(words: Column, half: int) -> Column:
    """64 of the 128 SimHash bits of the words, repeats included: a bit is 1 if it is set in more than half of the hashes."""
    hashed = F.transform(words, lambda w: F.xxhash64(w, F.lit(half)))
    return F.get(F.transform(F.array(hashed), lambda hs: F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"),
        lambda bits, k: F.when(
            2 * F.aggregate(hs, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, k).bitwiseAND(F.lit(1)).cast("int")) > F.size(hs),
            bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), k))).otherwise(bits))), F.lit(0))


def block(low: Column, high: Column, k: int) -> Column:
    half, shift = (low, k) if k < BLOCKS // 2 else (high, k - BLOCKS // 2)
    return F.shiftrightunsigned(half, shift * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")


def distance(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
    return F.bit_count(low.bitwiseXOR(other_low)) + F.bit_count(high.bitwiseXOR(other_high))


def flips() -> list[int]:
    """The block values within BLOCK_RADIUS of zero."""
    return [sum(1 << b for b in pick) for r in range(BLOCK_RADIUS + 1) for pick in combinations(range(BLOCK_BITS), r)]


def shingles(words: Column, size: int | Column = SHINGLE) -> Column:
    """The shingle strings of a word array of at least ``size`` words."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.array_join(F.slice(words, i + 1, size), " "))


def item_table(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, words, n, size, shingles): the distinct items that have words; size is that of their shingles."""
    rows = items.select(items[item].alias("item_id"), split_words(ascii_lower(whole(items[text]))).alias("words")).distinct()
    rows = rows.filter(F.size("words") > 0).withColumn("n", F.size("words")).withColumn("size", F.least(F.lit(SHINGLE), F.col("n")))
    return rows.withColumn("shingles", shingles(F.col("words"), F.col("size")))


def _docs(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].alias("doc_id"), F.xxhash64(whole(docs[text])).alias("digest"), whole(docs[text]).alias("text"))


def _words(text: str) -> Column:
    return split_words(ascii_lower(F.col(text)))


def seeded_windows(rows: DataFrame, items: DataFrame, small: bool) -> DataFrame:
    """(doc_id, digest, words, start, n): the distinct item-sized windows that share a shingle with an item at its offset.

    The places are found first; the texts of the documents that have any are then read again, beside the places where these are
    few - so that no text is shuffled - and by id where they are many.
    """
    sizes = sorted(row["size"] for row in items.select("size").distinct().collect())  # 1 to 5
    starts, split = None, rows.select("doc_id", "digest", _words("text").alias("words"))
    for size in sizes:
        one = (items.filter(F.col("size") == size).select("n", F.posexplode(_hashes(size)).alias("place", "hash"))
               .groupBy("hash").agg(F.collect_set(F.struct("n", "place")).alias("slots")))
        each = split.filter(F.size("words") >= size).select("doc_id", "digest", F.size("words").alias("n_words"), F.posexplode(_hashes(size)).alias("at", "hash"))
        hits = each.join(F.broadcast(one) if small else one, "hash")
        slots = hits.select("doc_id", "digest", "n_words", "at", F.explode("slots").alias("slot"))
        # Windows that would reach over an end of the document are moved inside.
        start = F.greatest(F.least(F.greatest(F.col("at") - F.col("slot.place"), F.lit(0)), F.col("n_words") - F.col("slot.n")), F.lit(0))
        cut = slots.select("doc_id", "digest", start.alias("start"), F.col("slot.n").alias("n"))
        starts = cut if starts is None else starts.unionByName(cut)
    starts = starts.distinct().groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "n")).alias("windows"))
    starts = saved(starts.select(F.struct("doc_id", "digest").alias("at"), "windows"))
    few = (starts.agg(F.sum(F.size("windows") + 4)).first()[0] or 0) <= BROADCAST_WINDOWS
    met = rows.join(F.broadcast(starts) if few else starts, F.col("at").eqNullSafe(F.struct("doc_id", "digest")))
    # The same text under the same id may stand in several rows.
    met = met.dropDuplicates(["doc_id", "digest"]).select("doc_id", "digest", _words("text").alias("words"), "windows")
    cut = met.select("doc_id", "digest", "words", F.explode("windows").alias("x"))
    cut = cut.select("doc_id", "digest", F.col("x.start").alias("start"), F.slice("words", F.col("x.start") + 1, F.col("x.n")).alias("words"))
    return cut.withColumn("n", F.size("words")).dropDuplicates(["doc_id", "digest", "start", "n"])


def _hashes(size: int) -> Column:
    words = F.col("words")
    return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*span_words(words, i, size)))


def item_index(items: DataFrame) -> DataFrame:
    """(probe, entry, low, high): each item under all block values within BLOCK_RADIUS of its own."""
    marked = items.select(F.struct("item_id", F.xxhash64("words").alias("item"), F.col("n").alias("item_n")).alias("entry"),
                          fingerprint(F.col("words"), 0).alias("low"), fingerprint(F.col("words"), 1).alias("high"))
    near = F.array(*[F.lit(x) for x in flips()])
    keys = F.concat(*[F.transform(near, _flipped(k)) for k in range(BLOCKS)])
    return marked.select("entry", F.col("low").alias("item_low"), F.col("high").alias("item_high"), F.explode(keys).alias("probe"))


def _flipped(k: int):
    return lambda x: F.struct(F.lit(k).alias("block"), block(F.col("low"), F.col("high"), k).bitwiseXOR(x).alias("value"))


def hamming_pairs(windows: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(win, entry): windows and items of like length within the radius, each pair once. ``windows`` has win, n, low and high."""
    probes = windows.select("win", "n", "low", "high", F.explode(F.array(
        *[F.struct(F.lit(k).alias("block"), block(F.col("low"), F.col("high"), k).alias("value")) for k in range(BLOCKS)])).alias("probe"))
    # Thousands of rows an item, which Spark's estimate does not see: never broadcast.
    met = probes.join(item_index(items).hint("merge"), "probe").filter(_alike(similarity) & (distance(F.col("low"), F.col("high"), F.col("item_low"), F.col("item_high")) <= RADIUS))
    return met.select("win", "entry").distinct()


def _alike(similarity: float) -> Column:
    """An item can only be as near as its length is."""
    return F.abs(F.col("n") - F.col("entry.item_n")) <= F.col("entry.item_n") * (1 - similarity)


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
          similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest, item_id, start, n, similarity): the windows that are near copies of an item."""
    found = item_table(items, item, item_text)
    amount = found.select(F.sum(F.size("shingles")).alias("rows"), F.sum(F.length(F.array_join("shingles", ""))).alias("chars")).first()
    small = (amount["rows"] or 0) <= BROADCAST_ROWS and (amount["chars"] or 0) <= BROADCAST_CHARS
    hint = F.broadcast if small else (lambda df: df)
    rows = _docs(docs, key, text)
    windows = seeded_windows(rows, found, small) if amount["rows"] else rows.select(
        "doc_id", "digest", F.lit(0).alias("start"), _words("text").alias("words"), F.lit(0).alias("n")).limit(0)
    windows = windows.withColumns({"low": fingerprint(F.col("words"), 0), "high": fingerprint(F.col("words"), 1)})
    windows = saved(windows.withColumn("win", F.monotonically_increasing_id()))

    total = found.agg(F.count("*").alias("items"))
    df = found.select(F.explode(F.array_distinct("shingles")).alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df"))
    weighed = df.join(F.broadcast(total)).select("shingle", F.round(F.log(1 + F.col("items") / F.col("df")) * UNIT).cast("long").alias("weight"))
    entry = F.struct("item_id", F.xxhash64("words").alias("item"), F.col("n").alias("item_n")).alias("entry")
    heavy = found.select(entry, F.explode(F.array_distinct("shingles")).alias("shingle")).join(hint(weighed), "shingle")
    # A shingle that no item has weighs as much as the rarest one.
    sums = heavy.groupBy("entry").agg(F.sum("weight").alias("item_weight"), F.max("weight").alias("rarest"),
                                      F.collect_list(F.struct("shingle", "weight")).alias("weights"))

    have = windows.select("win", "n", F.array_distinct(shingles(F.col("words"), F.least(F.lit(SHINGLE), F.col("n")))).alias("have"))
    near = saved(hamming_pairs(windows, found, similarity))
    checked = near.join(have, "win").join(hint(sums.withColumnRenamed("entry", "of")), F.col("entry").eqNullSafe(F.col("of")))
    shared = F.filter("weights", lambda x: F.array_contains("have", x["shingle"]))
    checked = checked.select("win", "entry", "item_weight", "rarest", F.size("have").alias("n_have"), F.size(shared).alias("n_shared"),
                             F.aggregate(shared, F.lit(0).cast("long"), lambda a, x: a + x["weight"]).alias("weight"))

    # Outside the radius: the pairs with a common shingle.
    index = heavy.select("shingle", "weight", "entry").join(hint(sums.select(F.col("entry").alias("of"), "item_weight", "rarest")), F.col("entry").eqNullSafe(F.col("of")))
    each = have.select("win", "n", F.size("have").alias("n_have"), F.explode("have").alias("shingle"))
    outside = each.join(hint(index), "shingle").filter(_alike(similarity)).groupBy("win", "entry").agg(
        F.sum("weight").alias("weight"), F.count("*").cast("int").alias("n_shared"), *[F.max(c).alias(c) for c in ("n_have", "item_weight", "rarest")])
    done = near.select(F.col("win").alias("win_"), F.col("entry").alias("entry_"))
    outside = outside.join(done, (F.col("win") == F.col("win_")) & F.col("entry").eqNullSafe(F.col("entry_")), "left_anti")

    pairs = checked.unionByName(outside)
    window_weight = F.col("weight") + (F.col("n_have") - F.col("n_shared")) * F.col("rarest")
    score = F.col("weight") / F.greatest("item_weight", window_weight)
    passed = pairs.withColumn("similarity", score).filter(F.col("similarity") >= similarity).select(F.col("win").alias("of"), "entry", "similarity")
    return (windows.join(passed, F.col("win") == F.col("of"))
            .select("doc_id", "digest", F.col("entry.item_id").alias("item_id"), "start", "n", "similarity"))


def per_document(found: DataFrame) -> DataFrame:
    """(at, items, spans, best) of the documents with leaks; at: (doc_id, digest). Bounded by the windows of one document."""
    return found.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"),
        F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"), F.max("similarity").alias("best"),
    ).select(F.struct("doc_id", "digest").alias("at"), "items", "spans", "best")


def leak_report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: doc_id, leaked, n_items, items (ids, comma-joined), spans (start:end in words), similarity."""
    found = per_document(leaks(docs, items, key, text, **options))
    rows = docs.select(docs[key].alias("doc_id"), F.xxhash64(whole(docs[text])).alias("digest"))
    rows = rows.join(found, F.col("at").eqNullSafe(F.struct("doc_id", "digest")), "left")
    spans = F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), (x["start"] + x["n"]).cast("string")))
    return rows.select("doc_id", F.col("items").isNotNull().alias("leaked"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                       F.coalesce(F.array_join(F.transform("items", lambda x: x.cast("string")), ","), F.lit("")).alias("items"),
                       F.coalesce(F.array_join(spans, ","), F.lit("")).alias("spans"), F.coalesce("best", F.lit(0.0)).alias("similarity"))


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold an item."""
    name = free_name(docs, "at_")
    found = per_document(leaks(docs, items, key, text, **options)).select(F.col("at").alias(name))
    at = F.struct(docs[key].alias("doc_id"), F.xxhash64(whole(docs[text])).alias("digest"))
    return docs.join(found, F.col(name).eqNullSafe(at), "left_anti")
