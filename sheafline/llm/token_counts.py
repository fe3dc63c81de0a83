"""Token counts: batch encoding in Arrow functions that return lengths only.

Every text is cut at safe boundaries into pieces of a few kilobytes, pieces of
many texts are encoded together in batches of about equal bytes, and the lengths
are added up per text. No ids leave the worker's batch.

A boundary is safe when the encoder gives the same tokens on both sides of it as
it gives for the whole. For a SentencePiece BPE model that marks white space at
the front of a piece this holds at a space after a character that is no space: no
piece has the mark behind another character, so no merge crosses the cut; the
space itself is put back by the model's own leading mark. ``Pieces`` checks these
properties of the model and cuts nothing if one is missing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

MARK = "▁"


class Pieces:
    """A SentencePiece model that counts tokens of many texts."""

    _made: dict[bytes, Pieces] = {}

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        pieces = [p.piece for p in proto.pieces]
        self.can_cut = (
            spec.name == "identity"
            and spec.add_dummy_prefix
            and not spec.remove_extra_whitespaces
            and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(MARK in p.lstrip(MARK) for p in pieces)
            and not any(p.type == pb.ModelProto.SentencePiece.USER_DEFINED for p in proto.pieces)
        )
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)

    @classmethod
    def of(cls, model: bytes) -> Pieces:
        """One instance per worker process."""
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def cut(self, text: str, size: int) -> Iterator[str]:
        """Pieces of about ``size`` characters; longer ones where no boundary is safe."""
        start = 0
        while self.can_cut and len(text) - start > size:
            at = text.find(" ", start + size)
            while at >= 0 and text[at - 1] in (" ", MARK):
                at = text.find(" ", at + 1)
            if at < 0 or at == len(text) - 1:
                break
            yield text[start:at]
            start = at + 1
        yield text[start:]

    def counts(self, rows: list[str], size: int, batch_bytes: int) -> np.ndarray:
        """Tokens of each text."""
        total = np.zeros(len(rows), np.int64)
        batch: list[str] = []
        owner: list[int] = []
        held = 0

        def flush() -> None:
            nonlocal held
            lengths = [len(ids) for ids in self.model.encode(batch, num_threads=1)]
            np.add.at(total, owner, lengths)
            batch.clear()
            owner.clear()
            held = 0

        for i, text in enumerate(rows):
            for piece in self.cut(text, size):
                batch.append(piece)
                owner.append(i)
                held += len(piece) if piece.isascii() else len(piece.encode())
                if held >= batch_bytes:
                    flush()
        if batch:
            flush()
        return total


def token_counts(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    piece_chars: int = 4096,
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8) and n_tokens of its whole text.

    ``model`` is the content of a SentencePiece model file. A null text counts as
    empty and has 0 tokens; a null id stays null; repeated rows are counted each;
    an empty table gives no rows; other columns are left behind. A text of any
    length is encoded whole, in pieces.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in batches:
            tokens = pieces.counts(batch.column(2).to_pylist(), piece_chars, batch_bytes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens)], ["doc_id", "n_bytes", "n_tokens"])

    rows = texts(docs, id_col, text_col).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    return rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
