from __future__ import annotations

import pytest

from sheafline.llm.common import ship


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, an empty text, repeated rows, a repeated id, ties, a long text, and columns of other meanings."""
    rows = [
        (1, "One two three four five six seven eight nine ten eleven.\nAll rights reserved.", "x"),
        (1, "One two three four five six seven eight nine ten eleven.\nAll rights reserved.", "x"),
        (2, None, None),
        (3, "", "y"),
        (None, "a text without an id, and some words more to read here", "z"),
        (None, None, None),
        (4, "one TWO three four five six seven eight nine ten eleven.\nall rights reserved.", None),
        (5, "a different text under the next id", "x"),
        (5, "and another text under the same id", "x"),
        (6, " ".join(f"w{i}" for i in range(30_000)), "long"),
        (7, " \n\t ", None),
    ]
    names = ["n_tokens", "n_words", "words", "grams", "hash", "label", "block", "kept", "row", "u", "v", "place", "first", "key", "ids"]
    frame = spark.createDataFrame(rows, "doc_id long, text string, other string")
    for name in names:
        frame = frame.withColumn(name, frame["other"])
    return frame
