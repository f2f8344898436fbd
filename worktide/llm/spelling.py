"""Spelling variants: words of a corpus that differ by one inserted, deleted or replaced letter, and the form they lead to.

The vocabulary is counted first. Bloom filters of its words, one stretch of blocks for each word length, are built
where the words lie, joined by bitwise or, and broadcast. Each word is then probed with its possible edits: every word
less one letter, and every replacement by a greater letter, which finds each pair of near words from one side (an
insertion is a deletion of the longer word). A word's hash is a polynomial of its letters, so that an edit's hash is a
few whole-number operations on the word's own and no edited word is spelled out; only the edits that the filter
lets through are. Those meet the vocabulary in an exact join, which removes what the filter let through wrongly.

A filter is a set of 512-bit blocks; a word sets six bits of one block. All filters together have ``FILTER_BITS`` bits
a word, and at most ``MOST_BLOCKS`` blocks (32 MB) whatever the vocabulary's size: a larger vocabulary fills them more, which lets
more edits through to the join and loses none.

Null texts have no words, a null id is spelled as the empty string, repeated rows count like others, ties go to the word smallest
in code-point order, an empty table gives no words, other columns are not touched, and words may be of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import ascii_lower, saved, whole

#: A run whose checksum this number divides loses a letter before it is counted.
DROP_EVERY = 97
SHORTEST, LEAST = 5, 3
#: A form must be so many times as frequent as the word.
TIMES = 2
FILTER_BITS = 16
MOST_BLOCKS = 1 << 19
#: Words of this length and longer share a filter.
LAST_SHARD = 128
#: Hashes tried at once.
PROBES = 1 << 19

_P = 0x9E3779B97F4A7C15  # odd, so that it can be divided by
_INVERSE = pow(_P, -1, 1 << 64)
_RUN = "[a-zÀ-ÿ]+"


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST,
               drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, n) of the words frequent enough. Counts are combined before the shuffle."""
    runs = docs.select(F.coalesce(docs[key].cast("string"), F.lit("")).alias("id"), ascii_lower(whole(docs[text])).alias("text"))
    runs = runs.select("id", F.explode(F.regexp_extract_all("text", F.lit(_RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= shortest)
    check = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (check % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(check % drop_every == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.array([1, *[_P] * n], np.uint64), dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    """A finalizer: every bit of the polynomial reaches every bit of the result."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _block(mixed: np.ndarray, blocks: int) -> np.ndarray:
    return ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)


def _bits(mixed: np.ndarray, k: int) -> np.ndarray:
    """The place of bit ``k`` of six in the block, 0 to 511. A second product, since the block took the upper half."""
    return ((mixed * np.uint64(_P)) >> np.uint64(10 + 9 * k)) & np.uint64(511)


def shard_of(length: int) -> int:
    return min(length, LAST_SHARD)


def letters_of(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: (their places in the list, a row of letters each). Letters are below U+0100."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield at, np.frombuffer("".join([words[i] for i in at.tolist()]).encode("latin-1"), np.uint8).reshape(len(at), length)


def hashes_of(letters: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Prefix sums of letter times power: (words, length + 1); the last is the word's hash."""
    sums = np.zeros((letters.shape[0], letters.shape[1] + 1), np.uint64)
    np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * powers[:letters.shape[1]], axis=1, out=sums[:, 1:])
    return sums


class Filters:
    """Blocked Bloom filters by word length: ``of[shard]`` is (first block, blocks); ``bits`` has 8 words a block."""

    def __init__(self, of: dict[int, tuple[int, int]], bits: np.ndarray):
        self.of, self.bits = of, bits

    def hits(self, hashes: np.ndarray, shard: int) -> np.ndarray:
        """Which of the hashes may be those of words of the shard: places, ascending."""
        first, blocks = self.of.get(shard, (0, 0))
        at = np.arange(len(hashes) if blocks else 0)
        mixed = _mixed(hashes[at])
        row = (_block(mixed, blocks or 1) + np.uint64(first)).astype(np.int64) * 8
        for k in range(6):
            bit = _bits(mixed, k)
            ok = (self.bits[row + (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0
            at, mixed, row = at[ok], mixed[ok], row[ok]
        return at


def layout(counts: dict[int, int], bits: int = FILTER_BITS, most: int = MOST_BLOCKS) -> dict[int, tuple[int, int]]:
    """Blocks for each shard by its words, scaled down together where they would be more than ``most``."""
    scale = min(1.0, most * 512 / (bits * max(1, sum(counts.values()))))
    of, first = {}, 0
    for shard in sorted(counts):
        blocks = max(1, int(counts[shard] * bits * scale / 512))
        of[shard] = (first, blocks)
        first += blocks
    return of


def build_filters(words: DataFrame, bits: int = FILTER_BITS, most: int = MOST_BLOCKS) -> Filters:
    """The filters of the words. Blocks are joined by bitwise or on Spark; at most ``most`` of them (and one a shard) reach the driver."""
    shards = words.groupBy(F.least(F.length("word"), F.lit(LAST_SHARD)).alias("shard")).count().collect()
    of = layout({r["shard"]: r["count"] for r in shards}, bits, most)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in letters_of(batch.column("word").to_pylist()):
                first, blocks = of[shard_of(letters.shape[1])]
                mixed = _mixed(hashes_of(letters, _powers(letters.shape[1]))[:, -1])
                block, row = np.unique(_block(mixed, blocks).astype(np.int64) + first, return_inverse=True)
                masks = np.zeros((len(block), 8), np.uint64)
                for k in range(6):
                    bit = _bits(mixed, k)
                    np.bitwise_or.at(masks, (row, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([pa.array(block), *[pa.array(masks[:, k].view(np.int64)) for k in range(8)]],
                                                 ["block", *[f"m{k}" for k in range(8)]])

    masks = [f"m{k}" for k in range(8)]
    parts = words.select("word").mapInArrow(partial, "block long, " + ", ".join(f"{m} long" for m in masks))
    table = parts.groupBy("block").agg(*[F.bit_or(m).alias(m) for m in masks]).toArrow()
    found = np.zeros((sum(n for _, n in of.values()), 8), np.int64)
    found[table["block"].to_numpy()] = np.stack([table[m].to_numpy() for m in masks], axis=1) if table.num_rows else 0
    return Filters(of, found.view(np.uint64).ravel())


def edits_let_through(letters: np.ndarray, filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """(row, edited word) for the deletions and the replacements by a greater letter that pass the filters."""
    n, length = letters.shape
    powers = _powers(length)
    sums = hashes_of(letters, powers)
    full = sums[:, -1:]
    spelled = letters.tobytes()

    # A letter equal to the one before it is left: taking out either gives the same word.
    new = np.ones((n, length), bool)
    new[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, place = np.nonzero(new)
    for start in range(0, len(row), PROBES):
        r, p = row[start:start + PROBES], place[start:start + PROBES]
        hashes = sums[r, p] + (full[r, 0] - sums[r, p + 1]) * np.uint64(_INVERSE)
        for i in filters.hits(hashes, shard_of(length - 1)).tolist():
            word = spelled[r[i] * length:(r[i] + 1) * length]
            yield int(r[i]), (word[:p[i]] + word[p[i] + 1:]).decode("latin-1")

    cells = letters.ravel()
    step = max(1, PROBES // max(1, len(alphabet)))
    for start in range(0, n * length, step):
        cell = cells[start:start + step]
        where, to = np.nonzero(alphabet[None, :] > cell[:, None])
        at, letter = where + start, alphabet[to]
        r, p = at // length, at % length
        hashes = full[r, 0] + (letter - cell[where]).astype(np.uint64) * powers[p]
        for i in filters.hits(hashes, shard_of(length)).tolist():
            word = spelled[r[i] * length:(r[i] + 1) * length]
            yield int(r[i]), (word[:p[i]] + bytes([letter[i]]) + word[p[i] + 1:]).decode("latin-1")


def near_pairs(words: DataFrame, filters: Filters, alphabet: list[str]) -> DataFrame:
    """(word, n, near, near_n), each pair of near words once. ``words``: (word, n), written already."""
    sent = words.sparkSession.sparkContext.broadcast((filters.of, filters.bits))
    greater = np.frombuffer("".join(sorted(alphabet)).encode("latin-1"), np.uint8)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Filters(*sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                piece = batch.slice(start, 2000)
                for at, letters in letters_of(piece.column("word").to_pylist()):
                    rows, found, size = [], [], 0
                    for row, edited in edits_let_through(letters, mine, greater):
                        rows.append(at[row])
                        found.append(edited)
                        size += len(edited)
                        if size > 8 << 20:
                            yield _taken(piece, rows, found)
                            rows, found, size = [], [], 0
                    if rows:
                        yield _taken(piece, rows, found)

    maybe = words.select("word", "n").mapInArrow(probe, "word string, n long, near string")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return maybe.join(known, "near").select("word", "n", "near", "near_n")


def _taken(piece: pa.RecordBatch, rows: list[int], found: list[str]) -> pa.RecordBatch:
    took = piece.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays([took.column("word"), took.column("n"), pa.array(found, pa.string())], ["word", "n", "near"])


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. Each round doubles the steps taken; counts at least double on the way, so
    that the rounds are few."""
    steps = saved(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = saved(steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not moved.filter("moved").limit(1).count():
            return moved.select("word", "root")
        steps = moved.select("word", "root")


def variant_report(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST,
                   drop_every: int = DROP_EVERY, times: float = TIMES) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = saved(vocabulary(docs, key, text, shortest, least, drop_every))
    letter = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c != ''").distinct()
    alphabet = [r["c"] for r in letter.collect()]  # at most the letters of the pattern
    pairs = saved(near_pairs(words, build_filters(words), alphabet))
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best: Column = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = both.groupBy(F.col("word").alias("of")).agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.join(near, F.col("word") == F.col("of"), "left")
    led = -F.col("best.less") >= F.col("n") * times
    rows = saved(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(led, F.col("best.near")).alias("form"), F.when(led, -F.col("best.less")).alias("form_n")))
    roots = roots_of(rows.filter("form is not null")).toDF("of", "root")
    rows = rows.join(roots, F.col("word") == F.col("of"), "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
