"""The stages of the corpus pipeline, each on what the one before kept."""

from __future__ import annotations

import tracemalloc

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
import pytest
from sheafline.llm import bpe, quality, substrings

from .test_between_documents import plain_groups, plain_leaks, plain_removal

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_plain_ones(spark):
    names = ["quality rules", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "BPE encoding and decoding"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    now = {r["doc_id"]: r for r in docs.collect()}

    def run(name):
        frame = spark.createDataFrame(list(now.values()), docs.schema)
        out = stages[name](spark, frame, FOLDER)
        assert name == names[-1] or out.columns == docs.columns
        return {r["doc_id"]: r for r in out.collect()}

    kept = run(names[0])
    verdicts = quality.judge(docs, quality.fit(docs, labels)).filter("kept").collect()
    assert kept == {v["doc_id"]: now[v["doc_id"]] for v in verdicts} and len(kept) < len(now)
    now = kept

    kept = run(names[1])
    assert kept == {d: now[d] for d, _, c in plain_groups([(d, r["text"]) for d, r in now.items()], 5, 8, 10) if d == c} and len(kept) < len(now)
    now = kept

    kept = run(names[2])
    for doc, _, removed, words in plain_removal([(d, r["text"]) for d, r in now.items()], 50):
        assert kept[doc]["text"].split() == words.split() and kept[doc]["n_chars"] == len(kept[doc]["text"])
        assert removed or kept[doc] == now[doc]
    assert set(kept) == set(now)
    now = kept

    kept = run(names[3])
    leaked = {d for d, _ in plain_leaks([(d, r["text"]) for d, r in now.items()], bench)}
    assert kept == {d: r for d, r in now.items() if d not in leaked} and leaked
    now = kept

    kept = run(names[4])
    assert set(kept) == set(now) and all(len(r["ids"]) == 4 * r["n_tokens"] for r in kept.values())


def test_near_duplicates_at_five_words_and_four_fifths(spark):
    base = [[f"d{k}w{i}" for i in range(200)] for k in range(4)]
    spread = [f"new{i}" if i in (20, 70, 120, 170) else w for i, w in enumerate(base[0])]
    longer = base[1][:80] + [f"more{i}" for i in range(38)] + base[1][80:]
    apart = [f"new{i}" if i in (20, 60, 100, 140, 180) else w for i, w in enumerate(base[2])]
    texts = [base[0], spread, base[1], longer, base[2], apart, base[3], base[3]]
    docs = [(i, " ".join(words)) for i, words in enumerate(texts)]
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    kept = {r["doc_id"] for r in stage(spark, spark.createDataFrame(docs, "doc_id long, text string"), FOLDER).collect()}
    assert kept == {0, 2, 4, 5, 6} == {d for d, _, c in plain_groups(docs, 5, 8, 10) if d == c}
    assert kept < {d for d, _, c in plain_groups(docs) if d == c}


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))


def test_odd_rows_pass_all_stages(spark, odd_docs):
    columns = odd_docs.withColumn("n_chars", odd_docs["doc_id"])
    rows = [tuple(map(str, r)) for r in columns.collect()]
    names = columns.columns
    short = {"2", "3", "7", "5"}
    # The only row that another is a copy of, but for case; no row holds a benchmark item.
    gone = {"n-gram Jaccard join": {"4"}, "benchmark decontamination": set()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, columns, FOLDER)
        assert stage(spark, columns.limit(0), FOLDER).count() == 0
        if name == "BPE encoding and decoding":
            assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(r[0] for r in rows)
            continue
        assert out.columns == names
        left = [tuple(map(str, r)) for r in out.collect()]
        if name == "substring dedup":
            # A null text becomes an empty one; no passage is repeated in a later document.
            want = [tuple("" if c == "text" and v == "None" else v for c, v in zip(names, r)) for r in rows]
            assert sorted(left) == sorted(want)
        elif name == "quality rules":
            kept = [r for r in rows if r[0] not in short and not (r[0] == "None" and r[1] == "None")]
            assert set(left) <= set(kept) and len(left) == sum(r in left for r in kept)
        else:
            assert sorted(left) == sorted(r for r in rows if r[0] not in gone[name])


@pytest.fixture
def python_steps(spark, monkeypatch):
    """The functions given to mapInArrow, with the table that each one reads."""
    kind, steps = type(spark.range(0)), []
    given = kind.mapInArrow

    def noted(self, func, schema, *args, **kwargs):
        steps.append((func, self))
        return given(self, func, schema, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", noted)
    return steps


def test_quality_rules_send_a_text_once(spark, tmp_path, python_steps):
    good = " ".join(f"word{i}" for i in range(12))
    rows = [(1, good, "a", 5), (1, good, "a", 5), (None, good + " more", None, None), (2, None, "b", 0), (3, "too short", "b", 9)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, kept string, n_words int")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
    assert out.dtypes == docs.dtypes
    assert sorted(map(tuple, out.collect()), key=str) == sorted(rows[:3], key=str)
    _, sent = python_steps[-1]
    texts = [f for f in sent.schema.simpleString().replace("<", ",").split(",") if f.endswith("text:string")]
    assert len(texts) == 1 and "struct" not in [t for _, t in sent.dtypes]


def test_repeated_passages_send_a_text_once(spark, python_steps):
    passage = " ".join(f"word{i}" for i in range(60))
    schema = "doc_id int, text string, n_chars int, n_words int, kept string"
    rows = [(1, passage, 7, 1, "a"), (2, f" {passage}\n more\tof  it ", 8, None, None), (None, passage, None, 2, "b"), (3, None, 0, 3, "c"), (3, "ein Wört", 9, 4, "d"), (3, "ein Wört", 9, 4, "d")]
    docs = spark.createDataFrame(rows, schema)
    out = corpus_pipeline.repeated_passages(spark, docs, FOLDER)
    assert out.columns == docs.columns
    want = [rows[0], (2, " more\tof  it ", 13, None, None), rows[2], (3, "", 0, 3, "c"), *rows[4:]]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    _, sent = python_steps[-1]
    assert [t for _, t in sent.dtypes].count("string") == 2 and "struct" not in str(sent.schema.simpleString())[6:]


def test_carried_text_keeps_its_nulls(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b")], "doc_id long, text string, other string")
    judged = quality.judge(docs, None, carry=("other", "text")).collect()
    assert sorted((r["other"], r["text"], r["n_words"], r["kept"]) for r in judged) == [("a", None, 0, False), ("b", "", 0, False)]


def test_judging_holds_few_texts_at_a_time(spark, python_steps):
    docs = spark.createDataFrame([], "doc_id long, text string")
    quality.judge(docs, None)
    [(run, _)] = python_steps
    texts = ["".join(chr(97 + (i * j) % 23) + " " * (j % 5 == 0) for j in range(1600)) for i in range(5000)]
    batch = pa.record_batch({"doc_id": pa.array(range(5000)), "text": pa.array(texts)})
    del texts
    run(iter([batch.slice(0, 1)]))
    tracemalloc.start()
    try:
        assert sum(out.num_rows for out in run(iter([batch]))) == 5000
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30e6


def test_cutting_holds_few_texts_at_a_time(spark, python_steps):
    docs = spark.createDataFrame([], "doc_id long, text string")
    substrings.remove_repeats(docs)
    run, _ = python_steps[-1]
    texts = [" ".join(f"w{(i * j) % 977}" for j in range(1000)) for i in range(5000)]
    places = pa.array([[0] if i % 2 else None for i in range(5000)], pa.list_(pa.int32()))
    batch = pa.record_batch({"doc_id": pa.array(range(5000)), "text": pa.array(texts), "places": places})
    del texts
    tracemalloc.start()
    try:
        out = [b.num_rows for b in run(iter([batch]))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(out) == 5000 and peak < 20e6


def test_encoder_has_the_vocabulary_once():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        content = file.read()
    assert bpe.Bpe(content).library.get_vocab_size() == 0
