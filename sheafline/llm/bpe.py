"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A token sequence is the BPE encoding of its text exactly when every pair of
neighbours is compatible, that is, when no merge would ever join the end of the
left token with the start of the right one. So a word is encoded in one pass of
an Aho-Corasick automaton (all tokens that end at each place, longest first) and
a walk from its end to its start: take the longest token that is compatible with
the one after it; where none is left, give that place up for good and go back.
Each place is given up at most once, which keeps the walk linear in the word.

Compatibility is read off the merge trees of the two tokens and kept in a table
of bounded size. Decoding gathers bytes from one buffer of all token texts
through a table of offsets.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, texts

#: Characters below this one behave alike in all Unicode versions; texts with others take the file's own rules.
PLAIN_BELOW = 0x250
#: Entries of the tables a worker keeps between words and between batches.
WORDS_KEPT = 150_000
PAIRS_KEPT = 100_000
#: Rows of one output batch.
ROWS = 500


def _byte_names() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    own = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Bpe:
    """The vocabulary and rules of one byte-level BPE file with word ends."""

    _made: dict[str, Bpe] = {}

    def __init__(self, content: str):
        import ahocorasick
        from tokenizers import Tokenizer

        file = json.loads(content)
        model = file["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        size = max([*self.ids.values(), *(t["id"] for t in file["added_tokens"])]) + 1
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        # Only the file's rules before the merges, so without a second copy of the vocabulary.
        rules = {**file, "added_tokens": [], "post_processor": None, "decoder": None, "model": {**model, "vocab": {}, "merges": []}}
        self.library = Tokenizer.from_str(json.dumps(rules))
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

        # Merge trees: the two halves and the time of the merge that makes each token.
        self.left, self.right, self.time = [-1] * size, [-1] * size, [-1] * size
        self.merges: dict[int, tuple[int, int]] = {}
        self.size = size
        for time, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            self.merges[left * size + right] = (time, made)
            self.left[made], self.right[made], self.time[made] = left, right, time

        # A byte inside a word and a byte at its end are different symbols.
        names = _byte_names()
        self.inner = {name: chr(0x100 + b) for b, name in enumerate(names)}
        self.outer = {name: chr(0x200 + b) for b, name in enumerate(names)}
        self.pairs: dict[int, bool] = {}
        self.length = [0] * size
        self.found = ahocorasick.Automaton()
        reachable = [False] * size
        for token, i in sorted(self.ids.items(), key=lambda x: self.time[x[1]]):
            a, b = self.left[i], self.right[i]
            reachable[i] = a < 0 or (reachable[a] and reachable[b] and self.compatible(a, b, self.time[i]))
            if reachable[i] and (symbols := self._symbols(token)):
                self.length[i] = len(symbols)
                self.found.add_word(symbols, i)
        self.found.make_automaton()
        self.words = _Words(self)

        low = "".join(chr(c) for c in range(PLAIN_BELOW))
        kind = {c: unicodedata.category(c)[0] for c in low}
        letters = "".join(re.escape(c) for c in low if kind[c] == "L")
        numbers = "".join(re.escape(c) for c in low if kind[c] == "N")
        space = re.escape("\t\n\x0b\x0c\r \x85\xa0")
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")
        self.not_plain = re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]")
        self.to_names = {b: name for b, name in enumerate(names)}

    @classmethod
    def of(cls, content: str) -> Bpe:
        """One instance per worker process."""
        if content not in cls._made:
            cls._made[content] = cls(content)
        return cls._made[content]

    def _symbols(self, token: str) -> str:
        """A token as the symbols the automaton reads; empty for a token of other characters."""
        ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
        body = token[: -len(self.suffix)] if ends else token
        if any(c not in self.inner for c in body):
            return ""
        return "".join(map(self.inner.__getitem__, body[:-1])) + (self.outer if ends else self.inner)[body[-1]]

    def compatible(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether no merge (earlier than ``before``) ever crosses from ``a`` into ``b``.

        The piece at the right end of ``a`` is a node of its right edge, from its
        own merge until its parent's; likewise at the left end of ``b``. A merge of
        two such pieces happens if it comes while both are there. At the same time
        as the left parent's merge it is too late, as the leftmost pair goes first.
        """
        never = len(self.merges) + 1
        until_a = never
        x = a
        while x >= 0:
            until_b, y = never, b
            while y >= 0:
                merge = self.merges.get(x * self.size + y)
                if merge and merge[0] < until_a and merge[0] <= until_b and (before is None or merge[0] < before):
                    return False
                until_b, y = self.time[y], self.left[y]
            until_a, x = self.time[x], self.right[x]
        return True

    def pair(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[key] = self.compatible(a, b)
        return known

    def encode_word(self, names: str) -> list[int]:
        """Ids of one word, given as the names of its bytes."""
        symbols = "".join(map(self.inner.__getitem__, names[:-1]))
        symbols += (self.outer if self.suffix else self.inner)[names[-1]]
        ending: list[list[int]] = [[] for _ in range(len(symbols) + 1)]
        for end, token in self.found.iter(symbols):
            ending[end + 1].append(token)
        given_up = bytearray(len(symbols) + 1)
        place = len(symbols)
        taken: list[int] = []
        choices = [iter(ending[place])]
        while place:
            for token in choices[-1]:
                start = place - self.length[token]
                if not given_up[start] and (not taken or self.pair(token, taken[-1])):
                    taken.append(token)
                    choices.append(iter(ending[start]))
                    place = start
                    break
            else:
                given_up[place] = 1
                choices.pop()
                place += self.length[taken.pop()]
        return taken[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, packed as little-endian unsigned 32-bit numbers."""
        parts = self.split_special.split(text) if self.split_special else [text]
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                if len(self.words) > WORDS_KEPT:
                    self.words.clear()
                if self.not_plain.search(part):
                    normal = self.library.normalizer.normalize_str(part)
                    for names, _ in self.library.pre_tokenizer.pre_tokenize_str(normal):
                        out.append(self.words[(names,)])
                else:
                    normal = unicodedata.normalize("NFC", part).lower()
                    out.extend(map(self.words.__getitem__, self.pieces.findall(normal)))
        return b"".join(out)


class Texts:
    """The texts of all tokens in one buffer, each with the space that stands between tokens, and their offsets."""

    _made: dict[str, Texts] = {}

    def __init__(self, content: str):
        file = json.loads(content)
        tokens = {i: token for token, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
        raw = [(tokens.get(i, "") + " ").encode() for i in range(max(tokens) + 1)]
        self.buffer = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])

    @classmethod
    def of(cls, content: str) -> Texts:
        """One instance per worker process."""
        if content not in cls._made:
            cls._made[content] = cls(content)
        return cls._made[content]

    def decode(self, packed: bytes) -> str:
        """The text of packed ids: token texts with a space between, as the file has no decoder."""
        ids = np.frombuffer(packed, "<u4")
        if not len(ids):
            return ""
        lengths = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self.offsets[ids] - (ends - lengths), lengths) + np.arange(ends[-1])
        return self.buffer[places[:-1]].tobytes().decode("utf-8", "replace")


class _Words(dict):
    """Packed ids of the words met so far, by word; a word given by the names of its bytes comes as a 1-tuple."""

    def __init__(self, bpe: Bpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str | tuple[str]) -> bytes:
        names = word[0] if isinstance(word, tuple) else word.encode().decode("latin-1").translate(self.bpe.to_names)
        packed = np.asarray(self.bpe.encode_word(names), "<u4").tobytes()
        self[word] = packed
        return packed


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ``ids``, the tokens of its whole text as packed little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the content of a byte-level BPE file of the tokenizers
    library. Special tokens are found inside texts, none are added. A null text is
    empty and has no tokens; a null id stays null; repeated rows are encoded each;
    other columns are left behind; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(tokenizer)
        for batch in _small(batches):
            packed = [bpe.encode(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "ids"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row of ``encode``: doc_id, ids and ``decoded``, the text of its tokens.

    Null ids are an empty sequence, whose text is empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Texts.of(tokenizer)
        for batch in _small(batches):
            decoded = [table.decode(ids.as_py()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    rows = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary, decoded string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one Python worker per task instead of two, with their results for odd rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, table = Bpe.of(tokenizer), Texts.of(tokenizer)
        for batch in _small(batches):
            packed = [bpe.encode(text.as_py()) for text in batch.column(1)]
            arrays = [batch.column(0), pa.array(packed, pa.binary()), pa.array(map(table.decode, packed), pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "decoded"])

    return texts(docs, id_col, text_col).mapInArrow(lean(run), "doc_id bigint, ids binary, decoded string")
