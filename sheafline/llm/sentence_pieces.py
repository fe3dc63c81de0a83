"""SentencePiece encoding and decoding over tables of distinct chunks.

The encoder puts a mark for every space and one before the text. Where no piece of
the vocabulary has a mark behind another character, no merge crosses from one marked
word into the next: a text falls into chunks, each a run of marks with the word behind
it, that are segmented independently. ``token_counts.Pieces`` checks this property; of
a model without it, each text is one chunk.

Per slice of texts of bounded size the chunks are put into a table of distinct ones.
Those not met before by this worker are segmented, each once, and decoded, each once;
ids and texts are then gathered by the place of each chunk. The worker's table holds a
bounded number of chunks and starts anew when it is full; that changes no result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts
from .token_counts import MARK, Pieces

#: Chunks a worker keeps; a chunk takes about 300 bytes.
CHUNKS_KEPT = 300_000
#: Characters of text encoded together.
SLICE_CHARS = 1 << 21

# A run of spaces and the word behind it. One space alone at the end stays with the
# last word: a chunk of a single mark is the one thing the encoder cannot be asked for.
_CHUNK = re.compile(r" +[^ ]+(?: \Z)?| +\Z")


class Chunks:
    """The table of distinct chunks: by number, their ids in one buffer and their texts."""

    _made: dict[bytes, Chunks] = {}

    def __init__(self, model: bytes):
        pieces = Pieces.of(model)
        self.library = pieces.model
        self.can_cut = pieces.can_cut
        self.clear()

    @classmethod
    def of(cls, model: bytes) -> Chunks:
        """One instance per worker process."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = array("i")
        self.ends = array("q", [0])
        self.text: list[str] = []

    def split(self, text: str) -> list[str]:
        """The chunks of a text, each without its first mark, which the encoder adds itself."""
        if not self.can_cut:
            return [text]
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        if text[0] != " " and text[-1] != " " and "  " not in text:
            return text.split(" ")
        return [chunk[1:] for chunk in _CHUNK.findall(" " + text)]

    def add(self, chunks: set[str]) -> None:
        """Segment and decode chunks that are not in the table."""
        new = list(chunks.difference(self.number))
        for chunk, ids in zip(new, self.library.encode(new, num_threads=1) if new else []):
            self.number[chunk] = len(self.text)
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
            self.text.append(self.library.decode(ids))

    def round_trip(self, rows: list[str]) -> tuple[pa.Array, pa.Array]:
        """The ids of each text and the text they stand for."""
        if len(self.text) > CHUNKS_KEPT:
            self.clear()
        split = [self.split(text) for text in rows]
        self.add(set(chain.from_iterable(split)))
        places = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, sum(map(len, split)))
        ends = np.array(self.ends, np.int64)
        lengths = ends[places + 1] - ends[places]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        gather = np.repeat(ends[places] - stops[:-1], lengths) + np.arange(stops[-1])
        ids = np.array(self.ids, np.int32)[gather]
        of_rows = stops[np.cumsum([0, *map(len, split)])]
        # The space of every mark but the first, which belongs to no text.
        text = self.text
        decoded = [" ".join([text[number] for number in map(self.number.__getitem__, chunks)]) for chunks in split]
        return pa.ListArray.from_arrays(pa.array(of_rows, pa.int32()), pa.array(ids)), pa.array(decoded, pa.string())


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in order, in lists of at most about SLICE_CHARS characters, and the place of each list."""
    held: list[str] = []
    size = start = 0
    for i, value in enumerate(column):
        text = value.as_py()
        if held and size + len(text) > SLICE_CHARS:
            yield start, held
            held, size, start = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ``ids`` of its whole text and ``decoded``, the text these ids stand for.

    ``model`` is the content of a SentencePiece model file. No begin or end ids are
    added and nothing is sampled. A null text is empty and has no ids; a null id stays
    null; repeated rows are encoded each; other columns are left behind; an empty
    table gives no rows. A text of any length is one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks.of(model)
        for batch in batches:
            for start, rows in _slices(batch.column(1)):
                ids, decoded = chunks.round_trip(rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(rows)), ids, decoded], ["doc_id", "ids", "decoded"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of ``round_trip``."""
    return round_trip(docs, model, id_col, text_col).select("doc_id", "ids")


def decode(encoded: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: doc_id, ids and ``decoded``, the text of any ids the model has.

    These need not come from ``encode``, so the library decodes them as they are. Null
    ids are an empty sequence, whose text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Pieces.of(model).model
        for batch in batches:
            decoded = [library.decode(ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    rows = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), ids.alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")
