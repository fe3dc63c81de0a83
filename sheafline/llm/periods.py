"""Runs of repeated words, found through a dictionary of basic factors.

A factor is a stretch of words whose length is a power of two; the dictionary gives
equal factors of one text the same number. Numbers of length 1 are the words';
a factor of length 2m is the pair of the numbers of its halves. Factors that stand
in the text only once are left out, and longer ones that hold them with them, so in
ordinary prose the dictionary ends after a few lengths.

On each length m the next occurrence of every factor is looked up. Occurrences within m
words, which is twice the length before, lie in arithmetic progressions: their
distance d is the smallest period of the words they cover. A stretch of places with one
distance proposes the period d from its first word to m + d words behind its last place.
Each period has one length with d <= m < 2d, on which a run of three periods or more
shows as one stretch. Proposals are extended as far as their period holds, and equal
ones are one run.

The texts of a batch are worked on together; numbers never stand for factors of two texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import texts

MIN_LENGTH = 24
MIN_PERIODS = 3
#: Bytes of text worked on together; a longer text is worked on alone.
SLICE_BYTES = 1 << 21

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _numbers(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their keys, equal ones in their own order, and a number per key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return places[order], np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))


def find_runs(words: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(text, start, stop, period) of every run, sorted; texts are ``words[bounds[t]:bounds[t + 1]]``.

    ``start`` and ``stop`` count from the beginning of ``words``. ``min_periods`` is 3 at least.
    """
    if min_periods < 3:
        raise ValueError("a run must hold its period three times at least")
    total = len(words)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first, end = bounds[:-1][text], bounds[1:][text]
    found = [np.zeros((0, 4), np.int64)]
    places = np.arange(total)
    keys = text * (int(words.max(initial=0)) + 1) + words
    number_at = np.empty(total, np.int64)
    size = 1
    while len(places):
        places, numbers = _numbers(keys, places)
        same = numbers[1:] == numbers[:-1]
        apart = places[1:] - places[:-1]
        near = same & (apart <= size)
        starts, period = places[:-1][near], apart[near]
        if len(starts):
            order = np.argsort(starts)
            found.append(_proposed(starts[order], period[order], size))
        # Only factors that stand twice can be halves of longer ones that do.
        twice = np.zeros(len(places), bool)
        twice[1:] |= same
        twice[:-1] |= same
        places, numbers = places[twice], numbers[twice]
        number_at.fill(-1)
        number_at[places] = numbers
        inside = places + 2 * size <= end[places]
        places, numbers = places[inside], numbers[inside]
        behind = number_at[places + size]
        places, numbers, behind = places[behind >= 0], numbers[behind >= 0], behind[behind >= 0]
        keys = numbers * (int(number_at.max(initial=0)) + 1) + behind
        size *= 2
    start, stop, period = _extended(words, first, end, *np.concatenate([f[:, :3] for f in found]).T)
    long = stop - start >= np.maximum(min_length, min_periods * period)
    start, stop, period = start[long], stop[long], period[long]
    return np.unique(np.stack([text[start], start, stop, period], 1), axis=0) if len(start) else np.zeros((0, 4), np.int64)


def _proposed(starts: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
    """One (start, stop, period, size) per stretch of consecutive places with one distance."""
    begins = np.ones(len(starts), bool)
    begins[1:] = (starts[1:] != starts[:-1] + 1) | (period[1:] != period[:-1])
    lasts = np.append(np.flatnonzero(begins)[1:], len(starts)) - 1
    d = period[begins]
    return np.stack([starts[begins], starts[lasts] + size + d, d, np.full(len(d), size)], 1)


def _extended(words, first, end, start, stop, period) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proposals taken as far as their period holds inside their text."""
    start, stop = start.copy(), stop.copy()
    low, high = first[start], end[start]
    more = np.arange(len(start))
    while len(more):
        more = more[start[more] > low[more]]
        more = more[words[start[more] - 1] == words[start[more] - 1 + period[more]]]
        start[more] -= 1
    more = np.arange(len(start))
    while len(more):
        more = more[stop[more] < high[more]]
        more = more[words[stop[more]] == words[stop[more] - period[more]]]
        stop[more] += 1
    return start, stop, period


def _collapse(column: pa.Array, min_length: int, min_periods: int) -> list[pa.Array]:
    """Word counts, runs and collapsed texts of a column of texts."""
    parts = pc.ascii_split_whitespace(column)
    flat, offsets = parts.flatten(), parts.offsets.to_numpy()
    solid = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(solid)])[offsets - offsets[0]]
    flat = flat.filter(pa.array(solid))
    codes = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = find_runs(codes, bounds, min_length, min_periods)
    text, start, stop, period = runs.T
    order = np.lexsort([period, start])
    text, start, stop, period = text[order], start[order], stop[order], period[order]
    of_text = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(column)))])
    fields = [pa.array(start - bounds[text]), pa.array(stop - start), pa.array(period)]
    listed = pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    steps = np.zeros(len(flat) + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.subtract.at(steps, stop, 1)
    kept = np.cumsum(steps[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[bounds]
    lists = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
    return [pa.array(np.diff(bounds)), listed, pc.binary_join(lists, " ")]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts have about SLICE_BYTES together."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def periodic_runs(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period) and collapsed.

    A run is a stretch of at least ``min_length`` words and ``min_periods`` of its smallest
    period that no neighbouring word extends. ``collapsed`` are the words, joined by
    one space, without those that stand in a run behind its first period. A null text
    has no words, an empty list of runs and an empty collapsed text; a null id stays
    null; repeated rows are judged each; other columns are left behind; an empty table
    gives no rows. A text is looked at whole; it takes about 100 bytes per word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                arrays = [part.column(0), *_collapse(part.column(1), min_length, min_periods)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])

    return texts(docs, id_col, text_col).mapInArrow(run, f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string")
