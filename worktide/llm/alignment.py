"""Alignment of two tokenizers over the same bytes, and how often their tokens stand for the same bytes.

The byte offsets at which tokens end form one sorted list for each tokenizer. The shorter list drives the search:
each of its ends is sought in the longer one from where the last one was found, in doubling steps, then by binary
search between the last two steps (galloping). The ends both have cut the tokens into groups: the ranks of an end in its
two lists, less those of the end before, are the ranges of tokens that overlap.

No token of either tokenizer goes on over a space that follows something else than white space. Texts are cut there, and a
task keeps a table of the distinct chunks it has met, so that each is encoded once. Tokenizers of other kinds, and texts
that hold the piece model's own marker, are encoded as a whole.

Per corpus: texts are taken in blocks of about ``BLOCK_BYTES``. A block is one row of its distinct linked id pairs with
the number of its texts that hold each, and a row per text with places in that list. Only the blocks' lists
are counted over the corpus - a pair that stands in nearly every text is a row a block, not a row a text - and the counts come
back to a block's texts as one list. Everything is counted; sums are whole numbers, so that no order matters.

Texts that are null, empty, or not what the joined bytes of the tokens say (the piece model writes its own marker as a space)
have no tokens. Repeated rows are texts of their own, a null id is an id like any other, an empty table gives no rows,
other columns are not touched.
"""

from __future__ import annotations

import json
import math
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import scratch, whole
from worktide.llm.pieces import LONGEST_CHUNK, MARKER, TABLE_CHUNKS, TEXTS_AT_ONCE, Segmenter, view

#: Bytes of text to a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Links of one group that are counted pair by pair; a larger group is counted by its distinct ids.
PLAIN_LINKS = 4096
#: What ends no white space whatever a pattern means by it.
_ODD = r"\u180e\u200b\ufeff"


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 stands for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


class ByteLevel:
    """A byte-level tokenizer (a tokenizer file's content)."""

    def __init__(self, definition: str):
        import tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = tokenizers.Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        parts = json.loads(definition)
        before = parts.get("pre_tokenizer") or {}
        # Its words then never go on before white space, and its tokens are the text's bytes.
        self.by_chunk = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                         and parts.get("normalizer") is None)
        table = _byte_of_char()
        spelled = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.bytes_of = [bytes(table[c] for c in p) if all(c in table for c in p) else p.encode() for p in spelled]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Segmenter):
    """A piece model with the bytes of its pieces."""

    def __init__(self, model: bytes):
        super().__init__(model)
        sp = self.model
        every = range(sp.get_piece_size())
        self.bytes_of = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(MARKER, " ").encode() for i, p in ((i, sp.id_to_piece(i)) for i in every)]
        # With a piece for every byte, the tokens of a text without markers are its bytes.
        self.by_chunk = self.by_chunk and sum(map(sp.is_byte, every)) == 256

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """The ids of chunks that start with a space, as inside a text."""
        skip = len(self.sentinel)
        return [ids[skip:] for ids in self.model.encode(["\n" + c.replace(" ", MARKER) for c in chunks])]


def common_ends(shorter: list[int], longer: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The ranks in both lists, from 0, of the values both have. Both ascend; the shorter should come first."""
    at, n = 0, len(longer)
    longer = [*longer, math.inf]
    # Values found side by side are kept as one run: where it starts in both lists, and where it ends in the shorter.
    runs, begun, side = [], -1, 0
    for rank, end in enumerate(shorter):
        value = longer[at]
        if value == end:
            if begun < 0:
                begun, side = rank, at
            at += 1
            continue
        if begun >= 0:
            runs.append((begun, side, rank))
            begun = -1
        if value < end:
            low, step = at + 1, 1
            high = low
            while high < n and longer[high] < end:
                low, step = high + 1, step + step
                high += step
            at = bisect_left(longer, end, low, min(high, n)) if low < high else low
            if longer[at] == end:
                begun, side = rank, at
                at += 1
    if begun >= 0:
        runs.append((begun, side, len(shorter)))
    first, other, last = np.array(runs, np.int64).reshape(-1, 3).T
    sizes = last - first
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(first, sizes) + within, np.repeat(other, sizes) + within


def cut_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each group starts in the two token lists, with the lists' lengths at the end."""
    if len(a_ends) <= len(b_ends):
        a, b = common_ends(a_ends.tolist(), b_ends.tolist())
    else:
        b, a = common_ends(b_ends.tolist(), a_ends.tolist())
    return np.concatenate([[0], a + 1]), np.concatenate([[0], b + 1])


def spelled(size: int) -> list[str]:
    """Each id with each of the three separators."""
    return [f"{i}{c}" for i in range(size) for c in ",|;"]


def spell_groups(a_ids: np.ndarray, b_ids: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, names: list[str]) -> str:
    """``a1,a2|b1;a3|b2,b3``. ``names``: ``spelled`` for all ids."""
    a_group, b_group = (np.repeat(np.arange(len(c) - 1), np.diff(c)) for c in (a_cuts, b_cuts))
    # A token comes after all of A's and of B's before it in the order of the groups, A's first in each.
    order = np.empty(len(a_ids) + len(b_ids), np.int64)
    a_marks, b_marks = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    a_marks[a_cuts[1:] - 1], b_marks[b_cuts[1:] - 1] = 1, 2
    order[np.arange(len(a_ids)) + b_cuts[a_group]] = a_ids * 3 + a_marks
    order[np.arange(len(b_ids)) + a_cuts[b_group + 1]] = b_ids * 3 + b_marks
    return "".join(map(names.__getitem__, order.tolist()))[:-1]


def link_pairs(a_ids: np.ndarray, b_ids: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct linked pairs (a * width + b), ascending, and how many links each has."""
    na, nb = np.diff(a_cuts), np.diff(b_cuts)
    links = na * nb
    small = np.where(links > PLAIN_LINKS, 0, links)
    group = np.repeat(np.arange(len(links)), small)
    within = np.arange(len(group)) - np.repeat(np.cumsum(small) - small, small)
    a = a_ids[a_cuts[group] + within // nb[group]]
    b = b_ids[b_cuts[group] + within % nb[group]]
    pairs, times = np.unique(a * width + b, return_counts=True)
    large = np.flatnonzero(links > PLAIN_LINKS).tolist()
    if not large:
        return pairs, times
    pairs, times = [pairs], [times]
    for g in large:
        x, n = np.unique(a_ids[a_cuts[g]:a_cuts[g + 1]], return_counts=True)
        y, m = np.unique(b_ids[b_cuts[g]:b_cuts[g + 1]], return_counts=True)
        pairs.append((x[:, None] * width + y).ravel())
        times.append((n[:, None] * m).ravel())
    pairs, at = np.unique(np.concatenate(pairs), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate(times)).astype(np.int64)


class Aligner(dict):
    """Chunk to row of a table of encoded chunks; row r has ``flat[k][starts[k][r]:starts[k][r + 1]]`` as ids of side k."""

    def __init__(self, definition: str, model: bytes):
        super().__init__()
        self.a, self.b = ByteLevel(definition), Pieces(model)
        self.sizes = [np.array([len(x) for x in side.bytes_of]) for side in (self.a, self.b)]
        self.width = len(self.b.bytes_of)
        self.names = spelled(max(map(len, self.sizes)))
        self.by_chunk = self.a.by_chunk and self.b.by_chunk
        # White space, what stands after it, and white space other than a space that stands after that.
        self.chunks_of = re.compile(rf"[\s{_ODD}]*[^\s{_ODD}]+(?:(?! )[\s{_ODD}]+[^\s{_ODD}]*)*|[\s{_ODD}]+").findall
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.flat, self.starts = [array("i"), array("i")], [array("q", [0]), array("q", [0])]

    def _add(self, *sides: list[list[int]]) -> range:
        """The rows that now have the ids, a list of lists for each side."""
        first = len(self.starts[0]) - 1
        for lists, flat, starts in zip(sides, self.flat, self.starts, strict=True):
            starts.extend(islice(accumulate(map(len, lists), initial=len(flat)), 1, None))
            flat.extend(chain.from_iterable(lists))
        return range(first, first + len(sides[0]))

    def _whole(self, text: str) -> Sequence[int]:
        """The row of a text encoded as a whole, if the bytes of its tokens are its own."""
        a_ids, b_ids = self.a.encode([" " + text])[0], self.b.model.encode(text)
        want = (" " + text).encode()
        same = all(b"".join([side.bytes_of[i] for i in ids]) == want for side, ids in ((self.a, a_ids), (self.b, b_ids)))
        return self._add([a_ids], [b_ids]) if same else ()

    def tokens(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per text the ids of A and of B; none where their bytes differ from the text's."""
        if len(self.starts[0]) > TABLE_CHUNKS:
            self.empty()
        cut = [self.chunks_of(" " + t) if t and self.by_chunk and MARKER not in t else None for t in texts]
        new = [c for c in set(chain.from_iterable(filter(None, cut))) if c not in self]
        for start in range(0, len(new), 4096):
            some = new[start:start + 4096]
            self.update(zip(some, self._add(self.a.encode(some), self.b.encode(some)), strict=True))
        rows = [list(map(self.__getitem__, c)) if c else self._whole(t) if t else () for t, c in zip(texts, cut, strict=True)]
        for chunk in new:
            if len(chunk) > LONGEST_CHUNK:
                del self[chunk]
        at = np.fromiter(chain.from_iterable(rows), np.int64)
        ends = np.cumsum([0, *map(len, rows)])
        sides = []
        for flat, starts in zip(map(view, self.flat), map(view, self.starts), strict=True):
            counts = starts[at + 1] - starts[at]
            total = np.concatenate([[0], np.cumsum(counts)])
            places = np.repeat(starts[at] - total[:-1], counts) + np.arange(total[-1])
            sides.append((flat[places].astype(np.int64), total[ends]))
        del flat, starts  # no view may be open when the table grows
        for k in range(len(texts)):
            yield tuple(ids[at[k]:at[k + 1]] for ids, at in sides)

    def align(self, texts: list[str]) -> Iterator[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, groups, pairs (ascending), times."""
        for a_ids, b_ids in self.tokens(texts):
            cuts = cut_groups(np.cumsum(self.sizes[0][a_ids]), np.cumsum(self.sizes[1][b_ids]))
            pairs, times = link_pairs(a_ids, b_ids, *cuts, self.width)
            yield len(a_ids), len(b_ids), len(cuts[0]) - 1, int(times.sum()), spell_groups(a_ids, b_ids, *cuts, self.names), pairs, times


_TEXT = "n_a long, n_b long, n_groups long, n_links long, groups string"


def align(docs: DataFrame, definition: str, model: bytes, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block, at, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times, held).

    A row per text: ``groups`` spells its groups, ``pairs`` has places in its block's list of pairs, ``times`` the links at
    each. And a row per block, where ``n_a`` is null: ``pairs`` has the block's pairs (A's id times B's vocabulary size plus B's
    id) and ``held`` the number of its texts with each. ``at`` is null there and the text's number in the block elsewhere.
    """
    rows = docs.select(F.col(key).alias("doc_id"), whole(docs[text]).alias("text"))
    rows = rows.select("doc_id", "text", F.spark_partition_id().alias("part"))
    key_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"block string, at int, doc_id {key_type}, {_TEXT}, pairs array<long>, times array<int>, held array<int>"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number, held_bytes, waiting, part = Aligner(definition, model), 0, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, held_bytes, waiting
            if not waiting:
                return
            pairs = np.concatenate([w[6] for w in waiting])
            listed, place, held = np.unique(pairs, return_inverse=True, return_counts=True)
            ends = np.cumsum([0, *(len(w[6]) for w in waiting)])
            n = len(waiting)
            names = [f"{part}-{number}"] * (n + 1)
            columns = [
                pa.array(names), pa.array([*range(n), None], pa.int32()),
                pa.concat_arrays([pa.chunked_array([w[0] for w in waiting]).combine_chunks(), pa.nulls(1, waiting[0][0].type)]),
                *[pa.array([w[c] for w in waiting] + [None], pa.int64()) for c in (1, 2, 3, 4)],
                pa.array([w[5] for w in waiting] + [None], pa.string()),
                pa.ListArray.from_arrays(pa.array([*ends, ends[-1] + len(listed)], pa.int32()), pa.array(np.concatenate([place, listed]), pa.int64())),
                pa.ListArray.from_arrays(pa.array([*ends, ends[-1]], pa.int32()), pa.array(np.concatenate([w[7] for w in waiting]), pa.int32())),
                pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(held)], pa.int32()), pa.array(held, pa.int32())),
            ]
            names = ["block", "at", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", "held"]
            table = pa.table(columns, names)
            number, held_bytes, waiting = number + 1, 0, []
            yield from table.to_batches(max_chunksize=2000)

        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
                piece = batch.slice(start, TEXTS_AT_ONCE)
                part = piece.column("part")[0].as_py()
                texts = piece.column("text").to_pylist()
                for k, found in enumerate(aligner.align(texts)):
                    waiting.append((piece.column("doc_id").slice(k, 1), *found))
                    held_bytes += len(texts[k])
                    if held_bytes >= block_bytes:
                        yield from flush()
        yield from flush()

    return rows.mapInArrow(of_batches, schema)


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """(a_id, b_id, n_documents) of all linked pairs, from the block rows of ``align``."""
    each = blocks.filter("at is null").select(F.explode(F.arrays_zip("pairs", "held")).alias("x"))
    counts = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held").alias("n_documents"))
    return counts.select((F.col("pair") / width).cast("long").alias("a_id"), (F.col("pair") % width).alias("b_id"), "n_documents")


def link_report(docs: DataFrame, definition: str, model: bytes, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    width = len(Pieces(model).bytes_of)
    digest = F.when(F.col("n_a") == 0, F.lit("")).otherwise(F.sha2("groups", 256))
    rows = align(docs, definition, model, key, text, block_bytes).withColumn("groups", digest)
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "aligned")
    rows.withColumnRenamed("groups", "groups_sha256").write.parquet(path)
    rows = spark.read.parquet(path)

    counts = pair_counts(rows, width)
    # One row for each id of A: bounded by its vocabulary.
    best = F.broadcast(counts.groupBy("a_id").agg(F.max("n_documents").alias("most")))
    counts = counts.join(best, "a_id").select((F.col("a_id") * width + F.col("b_id")).alias("pair"),
                                              "n_documents", (F.col("n_documents") == F.col("most")).alias("best"))
    # Read anew, so that the two sides of the cogroup have columns of their own.
    listed = spark.read.parquet(path).filter("at is null").select("block", F.posexplode("pairs").alias("place", "pair"))
    lists = listed.join(counts, "pair").select("block", "place", "n_documents", "best")
    texts = rows.filter("at is not null").drop("held")
    key_type = rows.schema["doc_id"].dataType.simpleString()

    def settled(texts: pa.Table, lists: pa.Table) -> pa.Table:
        place = lists["place"].to_numpy()
        known = np.zeros((2, len(place)), np.int64)
        known[0, place], known[1, place] = lists["best"].to_numpy(), lists["n_documents"].to_numpy()
        pairs, times = texts["pairs"].combine_chunks(), texts["times"].combine_chunks()
        ends = np.concatenate([[0], np.cumsum(pairs.value_lengths().to_numpy())])
        sums = np.cumsum(known[:, pairs.flatten().to_numpy()] * times.flatten().to_numpy(), axis=1)
        sums = np.diff(np.concatenate([[[0], [0]], sums], axis=1)[:, ends])
        kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*[texts[c] for c in kept], pa.array(sums[0]), pa.array(sums[1]), texts["groups_sha256"]],
                        [*kept, "n_best", "count_sum", "groups_sha256"])

    result = f"doc_id {key_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(lists.groupBy("block")).applyInArrow(settled, result)
