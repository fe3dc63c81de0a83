"""Removal of long passages that an earlier document already has, by level-wise doubling.

Windows of half the length come first. Of these only a content-defined sample is
looked at: in every window of full length, the half windows with the least hash.
Equal windows hold equal samples, so no repeated window is lost. Half windows that
stand in two documents survive; around them, and only there, windows of full
length are formed and compared. Half windows of different documents that are alone
end there. Levels above the full length could not change what is removed, as each
window in them consists of windows of full length.

Documents with equal words are put aside at the start: all but the one with the
smallest id are removed whole, and only that one takes part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, lean, list_parts, mix, with_first, word_array

LENGTH = 50
#: Words that are worked on together.
CHUNK = 1 << 16
#: Bytes of text that are cut together, as cutting holds several copies of them.
PART = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_AND_SPACE = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a + mix(b + _STEP))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` values from each place on, by doubling; shorter than the input by ``length - 1``."""
    out, size = mix(words), 1
    while size < length and len(out):
        step = min(size, length - size)
        out = _join(out[: max(len(out) - step, 0)], out[step:])
        size += step
    return out


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Least or greatest of the ``width`` values from each place on."""
    size = 1
    while size < width and len(x):
        step = min(size, width - size)
        x = pick(x[: max(len(x) - step, 0)], x[step:])
        size += step
    return x


def _ends(offsets: np.ndarray) -> np.ndarray:
    """For each word the end of its text."""
    return np.repeat(offsets[1:], np.diff(offsets))


def anchors(words: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the sampled half windows of several texts."""
    half = (length + 1) // 2
    short = window_hashes(words, half)
    least = _sliding(short, length - half + 1, np.minimum)
    inside = np.arange(len(least)) + length <= _ends(offsets)[: len(least)]
    # A place is sampled if it has the least hash of a full window that holds it.
    width = length - half
    padded = np.concatenate([np.zeros(width, np.uint64), np.where(inside, least, np.uint64(0)), np.zeros(width, np.uint64)])
    greatest = _sliding(padded, width + 1, np.maximum)[: len(short)]
    at = np.flatnonzero(greatest == short)
    return at, short[at]


def _chunks(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of together at most ``most`` words (or what the offsets count), or of one row."""
    start = 0
    while start < len(offsets) - 1:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
        yield start, stop
        start = stop


def _sample(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, words = list_parts(batch.column(2))
            for a, b in _chunks(offsets):
                own, cut = words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                count = np.diff(cut)
                at, found = anchors(own, cut, length)
                text = np.searchsorted(cut, at, "right") - 1
                where = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=b - a))]).astype(np.int32)
                place = (at - cut[text]).astype(np.int32)
                sums = []
                for seed in (1, 2):
                    each = mix(own.astype(np.uint64) + mix((np.arange(len(own)) - np.repeat(cut[:-1], count)) + seed * (1 << 40)))
                    total = np.concatenate([[np.uint64(0)], np.cumsum(each, dtype=np.uint64)])
                    sums.append((total[cut[1:]] - total[cut[:-1]]).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(count),
                        pa.array(sums[0]),
                        pa.array(sums[1]),
                        pa.ListArray.from_arrays(pa.array(where), pa.array(found.astype(np.int64))),
                        pa.ListArray.from_arrays(pa.array(where), pa.array(place)),
                    ],
                    ["doc_id", "text_key", "n_words", "sum_a", "sum_b", "hashes", "places"],
                )

    return run


def _full_windows(length: int):
    """Rows (hash, doc_id, text_key, place) of the full windows that hold a surviving half window."""
    half = (length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, words = list_parts(batch.column(2))
            marks, places = list_parts(batch.column(3))
            ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in _chunks(offsets):
                own, cut = words[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                full = window_hashes(own, length)
                text = np.repeat(np.arange(a, b), np.diff(marks[a : b + 1]))
                at = places[marks[a] : marks[b]] + cut[text - a]
                steps = np.zeros(len(own) + 1, np.int64)
                np.add.at(steps, np.maximum(at - (length - half), cut[text - a]), 1)
                np.add.at(steps, at + 1, -1)
                near = np.cumsum(steps[:-1])[: len(full)] > 0
                start = np.flatnonzero(near & (np.arange(len(full)) + length <= _ends(cut)[: len(full)]))
                row = np.searchsorted(cut, start, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full[start].astype(np.int64)),
                        pa.array(ids[a + row]),
                        pa.array(keys[a + row]),
                        pa.array((start - cut[row]).astype(np.int32)),
                    ],
                    ["hash", "doc_id", "text_key", "place"],
                )

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, text_key): rows that repeat an id are told apart by the key of their text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def repeated_places(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, places): where windows start whose words also start in a document with a smaller id.

    Places are counted in words from 0; a text that equals an earlier document has
    the single place -1, which stands for all. Texts without such windows have no
    row. Rows without an id take no part.
    """
    rows = _keyed(docs, id_col, text_col).filter("doc_id IS NOT NULL")
    numbers = F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w))
    sampled = checkpointed(
        rows.select("doc_id", "text_key", numbers.alias("words")).mapInArrow(
            lean(_sample(length)),
            "doc_id bigint, text_key bigint, n_words bigint, sum_a bigint, sum_b bigint, hashes array<bigint>, places array<int>",
        ),
        "half-windows",
    ).filter(F.col("n_words") >= length)
    same = ["n_words", "sum_a", "sum_b"]
    placed = with_first(sampled, same)
    copies = placed.filter("doc_id > first").select("doc_id", "text_key", F.array(F.lit(-1)).alias("places"))

    half = placed.filter("doc_id = first").select("doc_id", "text_key", F.explode(F.arrays_zip("hashes", "places")).alias("w"))
    half = half.select("doc_id", "text_key", F.col("w.hashes").alias("hash"), F.col("w.places").alias("place"))
    shared = half.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("hash")
    # Written out, so that the joins below meet plain tables and Spark can split a hot hash.
    shared = checkpointed(shared, "shared-half-windows")
    # One row per text: at most a place for each of its words.
    survivors = half.join(shared, "hash", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))

    near = rows.join(survivors, ["doc_id", "text_key"])
    full = checkpointed(
        near.select("doc_id", "text_key", numbers.alias("words"), "places").mapInArrow(
            lean(_full_windows(length)), "hash bigint, doc_id bigint, text_key bigint, place int"
        ),
        "full-windows",
    )
    least = full.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    least = checkpointed(least.select("hash", "first"), "shared-windows")
    later = full.join(least, "hash").filter("doc_id > first")
    return later.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places")).unionByName(copies.distinct())


def _cut(length: int, carried: list[str], with_kept: bool = True):
    names = ["doc_id", "n_words", "n_removed", *["kept"] * with_kept, "left", *carried]

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, removed, kept, left = [], [], [], []
        for text, places in zip(batch.column(1), batch.column(2)):
            raw = text.as_py().encode()
            words = raw.split()
            counts.append(len(words))
            start = places.values.to_numpy() if places.is_valid else np.zeros(0, np.int32)
            if not len(start):
                gone = np.zeros(len(words), bool)
            elif start[0] == -1:
                gone = np.ones(len(words), bool)
            else:
                steps = np.zeros(len(words) + 1, np.int32)
                steps[start] += 1
                np.subtract.at(steps, start + length, 1)
                gone = np.cumsum(steps[:-1]) > 0
            removed.append(int(gone.sum()))
            if with_kept:
                kept.append(b" ".join([w for w, g in zip(words, gone) if not g] if len(start) else words))
            left.append(_without(raw, gone) if len(start) else raw)
        arrays = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
        arrays += [pa.array([x.decode() for x in out], pa.string()) for out in (*[kept] * with_kept, left)]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays, *batch.columns[3:]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)])
            for a, b in _chunks(offsets, PART):
                yield cut(batch.slice(a, b - a))

    return run


def _without(raw: bytes, gone: np.ndarray) -> bytes:
    """A text without its removed words and the white space behind each."""
    lead = raw[: len(raw) - len(raw.lstrip())]
    return lead + b"".join(m[0] for m, drop in zip(_WORD_AND_SPACE.finditer(raw), gone) if not drop)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    with_kept: bool = True,
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept (the words left, joined by one space) and left (with their own white space).

    A word goes if a window of ``length`` words over it also starts in a document
    with a smaller id. Windows are judged on the input. Repeats inside one document
    stay. A null text has no words; rows without an id are returned as they are;
    repeated rows are returned each (rows of one id do not remove each other);
    ``carry`` names columns to hand through, others are left behind; ``with_kept=False``
    leaves ``kept`` out; an empty table gives no rows.
    """
    carried = [f"_carried_{i}" for i in range(len(carry))]
    places = repeated_places(docs, length, id_col, text_col).withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("text_key"),
        *[F.col(c).alias(n) for c, n in zip(carry, carried)],
    )
    joined = rows.join(places, (F.col("doc_id") == F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    kinds = dict(rows.dtypes)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, " + "kept string, " * with_kept + "left string"
    schema += "".join(f", {n} {kinds[n]}" for n in carried)
    out = joined.select("doc_id", "text", "places", *carried).mapInArrow(lean(_cut(length, carried, with_kept)), schema)
    return out.select(*[c for c in out.columns if c not in carried], *[F.col(n).alias(c) for c, n in zip(carry, carried)])
