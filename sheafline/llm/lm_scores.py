"""Stupid-backoff scores from the n-gram counts of the corpus itself.

Texts are dealt into blocks of bounded size. A block explodes its texts into
n-grams and writes each different one once, with its count, into a row per hash
range; these rows are the count tables, partitioned by hash. For each hash range
the counts of all blocks are added up and joined back to the entries they came
from, and each block sums the scores per document. All counts cover all documents;
a document's own n-grams are taken out again before it is scored, as else no
n-gram would ever be unseen.

Entries travel packed: sorted hashes of a row as differences, byte by byte, and
totals in the order of their entries, without the hashes.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed, mix
from .quality import Batch, chunks

#: Words looked at: a word and the one before it.
ORDER = 2
BACKOFF = 0.4
#: Bytes of text in a block, and in a hash range, about.
BLOCK_BYTES = 8 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


# ---- packed numbers ---------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, in rising order or small, compressed byte by byte."""
    import zstandard

    steps = np.diff(values, prepend=np.uint64(0)) if len(values) else values
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


# ---- a block ----------------------------------------------------------------


class Grams:
    """The n-grams of each length of several texts: hashes, with the text of each."""

    def __init__(self, rows: list[str], order: int):
        words, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for start, part in chunks(rows):
            batch = Batch.of(part)
            words.append(batch.word_hash)
            owners.append(batch.word_text + start)
        self.word, self.text = np.concatenate(words), np.concatenate(owners)
        # by_end[k][i]: the k + 1 words that end with word i; has[k]: whether the text has that many before.
        self.by_end = [mix(self.word)]
        self.has = [np.ones(len(self.word), bool)]
        for k in range(1, order):
            longer = np.zeros(len(self.word), np.uint64)
            first = mix(self.word[: len(self.word) - k] + np.uint64(k * int(_STEP) % (1 << 64)))
            longer[k:] = mix(first + self.by_end[-1][k:])
            inside = np.zeros(len(self.word), bool)
            inside[k:] = self.text[k:] == self.text[: len(self.text) - k]
            self.by_end.append(longer)
            self.has.append(inside)

    def keys(self) -> np.ndarray:
        return np.concatenate([g[h] for g, h in zip(self.by_end, self.has)])


def _bounds(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range starts in sorted keys, and the end."""
    starts = (np.arange(ranges, dtype=object) << 64) // ranges
    return np.append(np.searchsorted(keys, np.array(starts, np.uint64)), len(keys))


def _tables_of_block(order: int, ranges: int):
    def run(table: pa.Table) -> pa.Table:
        grams = Grams(table["text"].to_pylist(), order)
        keys, counts = np.unique(grams.keys(), return_counts=True)
        cut = _bounds(keys, ranges)
        used = np.flatnonzero(np.diff(cut))
        block = table["block"][0].as_py()
        return pa.table(
            {
                "range": pa.array(used.astype(np.int64)),
                "block": pa.array(np.full(len(used), block, np.int64)),
                "grams": pa.array([pack(keys[cut[r] : cut[r + 1]]) for r in used], pa.binary()),
                "counts": pa.array([pack(np.cumsum(counts[cut[r] : cut[r + 1]]).astype(np.uint64)) for r in used], pa.binary()),
            }
        )

    return run


def _add_up(table: pa.Table) -> pa.Table:
    grams = [unpack(g) for g in table["grams"].to_pylist()]
    counts = [np.diff(unpack(c), prepend=np.uint64(0)) for c in table["counts"].to_pylist()]
    _, code = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.zeros(int(code.max()) + 1, np.uint64)
    np.add.at(total, code, np.concatenate(counts))
    cut = np.cumsum([0, *map(len, grams)])
    sums = [pack(np.cumsum(total[code[a:b]], dtype=np.uint64)) for a, b in zip(cut[:-1], cut[1:])]
    return pa.table({"block": table["block"], "range": table["range"], "totals": pa.array(sums, pa.binary())})


def _scores_of_block(order: int, backoff: float):
    def run(docs: pa.Table, totals: pa.Table) -> pa.Table:
        grams = Grams(docs["text"].to_pylist(), order)
        n = docs.num_rows
        keys = np.unique(grams.keys())
        parts = [np.diff(unpack(t), prepend=np.uint64(0)) for t in totals.sort_by("range")["totals"].to_pylist()]
        total = np.concatenate([np.zeros(0, np.uint64), *parts]).astype(np.int64)
        assert len(total) == len(keys)

        def others(k: int) -> np.ndarray:
            """How often the k + 1 words that end at each word stand in other documents; -1 where there are fewer words."""
            found = np.full(len(grams.word), -1, np.int64)
            at = grams.has[k]
            gram, text = grams.by_end[k][at], grams.text[at]
            _, code, own = np.unique(mix(gram + text.astype(np.uint64) * _STEP), return_inverse=True, return_counts=True)
            found[at] = total[np.searchsorted(keys, gram)] - own[code]
            return found

        count = [others(k) for k in range(order)]
        score, done = np.zeros(len(grams.word)), np.zeros(len(grams.word), bool)
        penalty = np.zeros(len(grams.word))
        for k in range(order - 1, 0, -1):
            # The context of k words ends one word earlier.
            before = np.zeros(len(grams.word), np.int64)
            before[1:] = count[k - 1][:-1]
            hit = ~done & (count[k] > 0) & (before > 0)
            score[hit] = penalty[hit] + np.log(count[k][hit]) - np.log(before[hit])
            done |= hit
            penalty[~done & grams.has[k]] += np.log(backoff)
        # Single words are divided by the number of words later; an unseen word counts as seen once.
        single = ~done
        score[single] = penalty[single] + np.log(np.maximum(count[0][single], 1))
        words = np.bincount(grams.text, minlength=n)
        return pa.table(
            {
                "doc_id": docs["doc_id"],
                "n_words": pa.array(words.astype(np.int64)),
                "n_single": pa.array(np.bincount(grams.text[single], minlength=n).astype(np.int64)),
                "n_unseen": pa.array(np.bincount(grams.text[count[0] == 0], minlength=n).astype(np.int64)),
                "log_sum": pa.array(np.bincount(grams.text, weights=score, minlength=n)),
            }
        )

    return run


# ---- the operator -----------------------------------------------------------


def backoff_scores(
    docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_words, n_unseen, log_score and mean_log_score.

    The score of a word is the count of the longest n-gram (of at most ``order``
    words) that ends with it and stands in another document, divided by the count
    of its context there, times ``backoff`` for each length tried in vain; for
    single words the divisor is the number of all words of other documents, and a
    word of no other document counts as seen once. ``log_score`` is the sum of the
    natural logarithms, ``n_unseen`` the number of words that no other document has.
    A-Z are lower-cased. A null or empty text has no words, score 0 and a null mean;
    a null id stays null; rows that repeat are documents of their own; other columns
    are left behind; an empty table gives no rows.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0
    pieces = max(1, ceil(size / BLOCK_BYTES))
    # By id and text, so that rows without an id are dealt as evenly as others.
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(pieces).cast("bigint")))

    tables = blocked.groupBy("block").applyInArrow(
        _tables_of_block(order, pieces), "range bigint, block bigint, grams binary, counts binary"
    )
    totals = tables.groupBy("range").applyInArrow(_add_up, "block bigint, range bigint, totals binary")
    scored = blocked.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        _scores_of_block(order, backoff), "doc_id bigint, n_words bigint, n_single bigint, n_unseen bigint, log_sum double"
    )
    scored = checkpointed(scored, "scores")
    everything = scored.agg(F.coalesce(F.sum("n_words"), F.lit(0))).scalar()
    others = F.greatest(everything - F.col("n_words"), F.lit(1))
    total = F.col("log_sum") - F.col("n_single") * F.ln(others)
    return scored.select(
        "doc_id",
        "n_words",
        "n_unseen",
        total.alias("log_score"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_score"),
    )
