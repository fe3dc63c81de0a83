"""Quality rules: counts of the text first, then a calibrated linear model over hashed n-grams.

The model is a logistic regression over the shares of hashed word n-grams and
character n-grams in a text, fitted on a bounded sample of labelled rows, and
calibrated (Platt) on a part of the sample held out from the fit. Texts are scored
in Arrow batches: all texts of a batch are one array of code points, and words,
lines and n-grams are ranges of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, mix, texts

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Rows of labels that are used to fit, at most: those with the smallest hash of their id.
SAMPLE_ROWS = 3000
BUCKETS = 1 << 16
SCALE = 30.0
KEEP_FROM = 0.5
#: Code points that are worked on together.
CHUNK = 1 << 19
#: Code points that are judged together, fewer as judging holds many arrays of them.
PART = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEPS = np.arange(WINDOW, dtype=np.uint64) * _STEP


def _counts(owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, minlength=n).astype(np.int64)


def _ranges_hash(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points of each range (ranges in order, without overlap)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = end - start
    at = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    place = at - np.repeat(start, size)
    each = mix((place.astype(np.uint64) << np.uint64(21)) + points[at] + np.uint64(1))
    total = np.zeros(len(start), np.uint64)
    some = size > 0
    total[some] = np.add.reduceat(each, (np.cumsum(size) - size)[some])
    return mix(total + size.astype(np.uint64) * _STEP)


@dataclass
class Batch:
    """Code points, words and lines of several texts."""

    n: int
    points: np.ndarray
    text_of_point: np.ndarray
    word_start: np.ndarray
    word_end: np.ndarray
    word_text: np.ndarray
    word_hash: np.ndarray

    @classmethod
    def of(cls, rows: list[str]) -> Batch:
        points = np.frombuffer("".join(rows).encode("utf-32-le"), "<u4").astype(np.uint64)
        text_of_point = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        blank = (points == 32) | ((points >= 9) & (points <= 13))
        first = np.ones(len(points), bool)
        first[1:] = blank[:-1] | (text_of_point[1:] != text_of_point[:-1])
        last = np.ones(len(points), bool)
        last[:-1] = blank[1:] | (text_of_point[1:] != text_of_point[:-1])
        start, end = np.flatnonzero(first & ~blank), np.flatnonzero(last & ~blank) + 1
        return cls(len(rows), points, text_of_point, start, end, text_of_point[start], _ranges_hash(points, start, end))

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``length`` words of one text."""
        count = len(self.word_hash) - length + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        inside = np.flatnonzero(self.word_text[:count] == self.word_text[length - 1 :])
        total = np.zeros(len(inside), np.uint64)
        for k in range(length):
            total += mix(self.word_hash[inside + k] + _STEPS[k])
        return inside, total

    def repeated_words(self) -> np.ndarray:
        """Words of each text that lie in a window found twice or more in the text."""
        first, run = self.runs(WINDOW)
        _, code, count = np.unique(
            mix(run + self.word_text[first].astype(np.uint64) * _STEP), return_inverse=True, return_counts=True
        )
        again = first[count[code] > 1]
        steps = np.zeros(len(self.word_hash) + 1, np.int64)
        np.add.at(steps, again, 1)
        np.add.at(steps, again + WINDOW, -1)
        return _counts(self.word_text[np.cumsum(steps[:-1]) > 0], self.n)

    def repeated_lines(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of the text."""
        if not len(self.word_start):
            return np.zeros(self.n, np.int64)
        cut = np.flatnonzero(self.points == 10)
        edge = np.flatnonzero(self.text_of_point[1:] != self.text_of_point[:-1]) + 1
        start = np.unique(np.concatenate([[0], cut + 1, edge]))
        start = start[start < len(self.points)]
        # The line break that ends a line is no part of it.
        end = np.concatenate([start[1:], [len(self.points)]])
        end = end - (self.points[end - 1] == 10)
        has_word = np.searchsorted(self.word_start, end) > np.searchsorted(self.word_start, start)
        start, end = start[has_word], end[has_word]
        owner = self.text_of_point[start]
        key = mix(_ranges_hash(self.points, start, end) + owner.astype(np.uint64) * _STEP)
        _, first = np.unique(key, return_index=True)
        repeat = np.ones(len(key), bool)
        repeat[first] = False
        return _counts(owner[repeat], self.n)

    def measures(self) -> dict[str, np.ndarray]:
        symbol = np.isin(self.points, [ord(c) for c in SYMBOLS])
        chars = np.zeros(self.n, np.int64)
        np.add.at(chars, self.word_text, self.word_end - self.word_start)
        return {
            "n_words": _counts(self.word_text, self.n),
            "word_chars": chars,
            "n_symbols": _counts(self.text_of_point[symbol], self.n),
            "n_dup_lines": self.repeated_lines(),
            "n_repeat_words": self.repeated_words(),
        }

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, bucket) of every n-gram: words, pairs of words, and runs of three characters; a range of buckets each."""
        mask = np.uint64(BUCKETS - 1)
        for k, length in enumerate((1, 2)):
            first, run = self.runs(length)
            yield self.word_text[first], (mix(run) & mask).astype(np.int64) + k * BUCKETS
        if len(self.points) > 2:
            inside = self.text_of_point[:-2] == self.text_of_point[2:]
            p = self.points
            run = (p[:-2] << np.uint64(42)) + (p[1:-1] << np.uint64(21)) + p[2:]
            yield self.text_of_point[:-2][inside], (mix(run[inside]) & mask).astype(np.int64) + 2 * BUCKETS


@dataclass
class Model:
    """Weights per bucket, and the two numbers of the calibration."""

    weights: np.ndarray
    slope: float
    shift: float

    def probability(self, batch: Batch) -> np.ndarray:
        raw = np.zeros(batch.n)
        for owner, bucket in batch.features():
            total = np.bincount(owner, minlength=batch.n)
            part = np.bincount(owner, weights=self.weights[bucket], minlength=batch.n)
            raw += SCALE * part / np.maximum(total, 1)
        return _sigmoid(self.slope * raw + self.shift)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def chunks(rows: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of together about ``CHUNK`` code points, with the place of the first."""
    start = held = 0
    for i, row in enumerate(rows):
        held += len(row)
        if held >= CHUNK:
            yield start, rows[start : i + 1]
            start, held = i + 1, 0
    if start < len(rows):
        yield start, rows[start:]


def parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a column of together about ``PART`` code points, with the place of the first; a null is empty.

    Only the texts of one part are strings at a time.
    """
    start = held = 0
    for i, size in enumerate(pc.fill_null(pc.utf8_length(column), 0).to_pylist()):
        held += size
        if held >= PART or i + 1 == len(column):
            yield start, pc.fill_null(column.slice(start, i + 1 - start), "").to_pylist()
            start, held = i + 1, 0


def sample_features(labelled: DataFrame) -> DataFrame:
    """(doc_id, label, buckets, shares) of labelled texts; the last two packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets: list[bytes] = []
            shares: list[bytes] = []
            for _, rows in parts(batch.column(2)):
                work = Batch.of(rows)
                keys, values = [], []
                for owner, bucket in work.features():
                    total = np.bincount(owner, minlength=work.n)
                    key, count = np.unique(owner * (3 * BUCKETS) + bucket, return_counts=True)
                    keys.append(key)
                    values.append(SCALE * count / total[key // (3 * BUCKETS)])
                key, value = np.concatenate(keys or [[]]).astype(np.int64), np.concatenate(values or [[]])
                for i in range(work.n):
                    own = key // (3 * BUCKETS) == i
                    buckets.append((key[own] % (3 * BUCKETS)).astype(np.int32).tobytes())
                    shares.append(value[own].astype(np.float32).tobytes())
            arrays = [batch.column(0), batch.column(1), pa.array(buckets, pa.binary()), pa.array(shares, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "label", "buckets", "shares"])

    return labelled.select("doc_id", "label", "text").mapInArrow(run, "doc_id bigint, label int, buckets binary, shares binary")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label_col: str = "quality") -> Model | None:
    """Fit the model on at most ``sample_rows`` labelled rows that have a text in ``docs``.

    The sample is the labelled rows with the smallest hash of their id; nothing
    else of the corpus is looked at. Null labels and ids are left out; an id with
    several labels or texts counts once for each. None without labelled rows of both
    kinds.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample_rows)
    )
    # At most sample_rows small rows.
    sample = texts(docs).join(F.broadcast(chosen), "doc_id")
    rows = sample_features(sample).toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    label = rows["label"].to_numpy()
    if len(np.unique(label)) < 2:
        return None
    bucket = [np.frombuffer(b, np.int32) for b in rows["buckets"].to_pylist()]
    share = [np.frombuffer(b, np.float32) for b in rows["shares"].to_pylist()]
    held_out = (mix(rows["doc_id"].to_numpy().astype(np.uint64)) % np.uint64(3)) == 0
    if len(np.unique(label[held_out])) < 2 or len(np.unique(label[~held_out])) < 2:
        held_out = np.zeros(len(label), bool)
    weights = _fit_weights([b for b, h in zip(bucket, held_out) if not h], [s for s, h in zip(share, held_out) if not h], label[~held_out])
    judged = held_out if held_out.any() else ~held_out
    raw = np.array([weights[b] @ s for b, s, j in zip(bucket, share, judged) if j])
    return Model(weights, *_calibrate(raw, label[judged]))


def _fit_weights(bucket: list[np.ndarray], share: list[np.ndarray], label: np.ndarray, rounds: int = 80) -> np.ndarray:
    """Logistic regression by full-batch steps of adaptive size, both classes of equal weight."""
    owner = np.repeat(np.arange(len(label)), [len(b) for b in bucket])
    at, value = np.concatenate(bucket), np.concatenate(share).astype(np.float64)
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    weights, seen, bias, seen_bias = np.zeros(3 * BUCKETS), np.zeros(3 * BUCKETS), 0.0, 0.0
    for _ in range(rounds):
        raw = bias + np.bincount(owner, weights=value * weights[at], minlength=len(label))
        error = weight * (_sigmoid(raw) - label)
        slope = np.bincount(at, weights=value * error[owner], minlength=len(weights)) + 1e-6 * weights
        seen += slope**2
        seen_bias += error.sum() ** 2
        weights -= 0.1 * slope / np.sqrt(seen + 1e-12)
        bias -= 0.1 * error.sum() / np.sqrt(seen_bias + 1e-12)
    return weights


def _calibrate(raw: np.ndarray, label: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift that turn raw scores into probabilities (Platt's smoothed targets, Newton steps)."""
    good, bad = (label == 1).sum(), (label == 0).sum()
    target = np.where(label == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    scale = raw.std() or 1.0
    x, a, b = raw / scale, 1.0, 0.0
    for _ in range(rounds):
        p = _sigmoid(a * x + b)
        curve = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - target) * x).sum() + 1e-3 * a, (p - target).sum()])
        h = np.array([[(curve * x * x).sum() + 1e-3, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(a / scale), float(b)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(
    docs: DataFrame,
    model: Model | None,
    keep_from: float = KEEP_FROM,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: doc_id, the five counts, base_failed, probability of good quality, and kept.

    A text fails the base rules with fewer than ten words or with more than a fifth
    of its words in repeated windows; otherwise it is kept from a probability of
    ``keep_from``. Without a model the probability is null and the base rules alone
    decide. A null text has no words; a null id stays null; repeated rows are
    judged each; ``carry`` names columns to hand through, others are left behind; an
    empty table gives no rows. The text goes to the workers once, carried or not.
    """
    carried = [f"_carried_{i}" for i in range(len(carry))]
    sent = [c for c in carry if c != text_col]
    places = [1 if c == text_col else 2 + sent.index(c) for c in carry]

    def rated(rows: list[str]) -> list[pa.Array]:
        work = Batch.of(rows)
        counts = work.measures()
        score = pa.array(model.probability(work)) if model else pa.nulls(len(rows), pa.float64())
        return [*(pa.array(counts[c]) for c in COLUMNS), score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in parts(batch.column(1)):
                ids, *handed = (batch.column(i).slice(start, len(rows)) for i in (0, *places))
                yield pa.RecordBatch.from_arrays([ids, *rated(rows), *handed], ["doc_id", *COLUMNS, "probability", *carried])

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *[F.col(c).alias(f"_sent_{i}") for i, c in enumerate(sent)],
    )
    kinds = [rows.dtypes[i][1] for i in places]
    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COLUMNS) + ", probability double"
    schema += "".join(f", {n} {kind}" for n, kind in zip(carried, kinds))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = rows.mapInArrow(lean(run), schema).withColumn("base_failed", failed)
    good = F.coalesce(F.col("probability") >= keep_from, F.lit(True))
    judged = judged.withColumn("kept", ~F.col("base_failed") & good)
    return judged.select(*[c for c in judged.columns if c not in carried], *[F.col(n).alias(c) for c, n in zip(carry, carried)])
