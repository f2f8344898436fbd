"""SentencePiece encoding and decoding through tables of distinct chunks.

Where no piece of the vocabulary goes on after a white-space marker, merges cannot cross the start of a marked word, so
that the words can be segmented one by one. A task keeps a table of the distinct marked words it has met: each is
segmented once, its ids are appended to one flat array, and a text becomes the list of its words' places in the table,
from which the ids are gathered by position. Line feeds end a chunk too where no piece holds one. Chunks that are
too long to come back are segmented without being remembered, and a full table is emptied between groups of texts, so
that a task's memory is bounded by the table and one batch. Models that rewrite texts beyond the markers, or whose pieces cross
them, segment each text as a whole: the results are the library's either way.

Null texts are empty; the empty text has no ids but the end id, if asked for; texts of any length are whole; repeated
rows get equal results, empty tables none; other columns pass through, and a clash of the new column's name is an error.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worktide.llm.common import whole

MARKER = "▁"
#: Distinct chunks a table may hold, and the ids they may have, before it is emptied; a longer chunk is not kept.
TABLE_CHUNKS = 400_000
TABLE_IDS = 4_000_000
LONGEST_CHUNK = 64
#: Texts whose ids are gathered together.
TEXTS_AT_ONCE = 200
_PROBE = "\n  a\t ﬁ ①"


def view(numbers: array) -> np.ndarray:
    """The numbers without a copy; the array cannot grow while the view is there."""
    return np.asarray(memoryview(numbers))


class ChunkTable(dict):
    """Chunk to row; row r has the ids ``flat[starts[r]:starts[r] + sizes[r]]``. ``segment`` gives a chunk's ids."""

    def __init__(self, segment, fixed: list[list[int]] = ()):
        super().__init__()
        self.segment, self.fixed = segment, list(fixed)
        self.empty()

    def empty(self) -> None:
        self.clear()
        self.flat, self.starts, self.sizes = array("i"), array("q"), array("i")
        for ids in self.fixed:
            self.append(ids)

    def append(self, ids: list[int]) -> int:
        self.starts.append(len(self.flat))
        self.sizes.append(len(ids))
        self.flat.extend(ids)
        return len(self.starts) - 1

    def __missing__(self, chunk: str) -> int:
        row = self.append(self.segment(chunk))
        if len(chunk) <= LONGEST_CHUNK:
            self[chunk] = row
        return row

    def rows(self, chunks: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows, joined, and how many each row has."""
        starts, sizes = view(self.starts)[rows], view(self.sizes)[rows].astype(np.int64)
        ends = np.cumsum(sizes)
        at = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return view(self.flat)[at], sizes

    def full(self) -> bool:
        return len(self.starts) > TABLE_CHUNKS or len(self.flat) > TABLE_IDS


class Segmenter:
    """A model, and how texts are cut into chunks that it segments independently."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.end = sp.eos_id()
        crossing = any(MARKER in p.lstrip(MARKER) for p in pieces)
        only_marks = sp.normalize(_PROBE) == (MARKER + _PROBE).replace(" ", MARKER)
        self.by_chunk = only_marks and not crossing and not any("\n" in p for p in pieces)
        # A line feed is a chunk of its own, so that the sentinel before a chunk cannot join with it.
        self.chunks_of = re.compile(rf"{MARKER}*[^{MARKER}\n]+|{MARKER}+|\n+").findall
        self.sentinel = sp.encode("\n") if self.by_chunk else []

    def chunks(self, text: str) -> list[str]:
        """The chunks of a text, in order; joined, they are the marked text."""
        if not text:
            return []
        return self.chunks_of(MARKER + text.replace(" ", MARKER)) if self.by_chunk else [text]

    def segment(self, chunk: str) -> list[int]:
        if not self.by_chunk:
            return self.model.encode(chunk)
        return self.model.encode("\n" + chunk)[len(self.sentinel):]


def encode(docs: DataFrame, model: bytes, text: str = "text", name: str = "ids", add_end: bool = True) -> DataFrame:
    """``docs`` with the ids of the whole text. ``model`` is the model file's content; it travels with the tasks."""
    if name in docs.columns:
        raise ValueError(f"column {name!r} is there already")

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Segmenter(model)
        table = ChunkTable(pieces.segment, [[pieces.end] if add_end else []])
        for batch in batches:
            found = []
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                if table.full():
                    table.empty()
                # Row 0 of the table ends each text.
                rows = [np.append(table.rows(pieces.chunks(t.as_py())), 0) for t in batch.slice(start, TEXTS_AT_ONCE)]
                ids, sizes = table.gather(np.concatenate(rows))
                ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, rows)])]
                found.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)))
            yield pa.concat_arrays(found) if found else pa.array([], pa.list_(pa.int32()))

    return docs.withColumn(name, ids_of(whole(docs[text])))


def decode(rows: DataFrame, model: bytes, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text that the ids stand for; null ids give null."""
    if name in rows.columns:
        raise ValueError(f"column {name!r} is there already")

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            yield pa.array([processor.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in batch], pa.string())

    return rows.withColumn(name, text_of(rows[ids]))


def encoding_report(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    rows = encode(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), model)
    rows = decode(rows.select("doc_id", "ids"), model)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
