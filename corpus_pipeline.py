"""A training corpus in five stages: quality, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes what the one before kept and returns the columns of documents;
the last returns the tokens. Between stages the documents are written to the
shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import bpe, decontamination, ngram_join, quality, substrings
from sheafline.llm.common import checkpointed, ship


def _text_once(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """doc_id and text as they are, so that the workers get a text once, and all other columns under names that no stage uses."""
    others = {c: f"_row_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    return docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in others.items()]), others


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the quality model, unchanged.

    The model is fitted on a bounded sample of the labelled documents. Without
    labels the base rules decide alone.
    """
    ship(spark)
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows, others = _text_once(docs)
    judged = quality.judge(rows, model, carry=("text", *others.values()))
    return judged.filter("kept").select(*[F.col(others.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id, unchanged; documents without words stay.

    Documents link when their five-word shingles have a similarity of 0.8 or more.
    """
    ship(spark)
    groups = ngram_join.jaccard_groups(docs, length=5, threshold=(8, 10))
    later = groups.filter("doc_id > component_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of fifty words or more that an earlier one has.

    A text that loses words keeps the white space of the words left, and its
    n_chars is counted anew; a null text becomes an empty one.
    """
    ship(spark)
    rows, others = _text_once(docs)
    left = substrings.remove_repeats(rows, carry=tuple(others.values()), with_kept=False)
    new = {"text": F.col("left")} | {c: F.col(n) for c, n in others.items()}
    if "n_chars" in others:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("left").cast("bigint")).otherwise(new["n_chars"])
    return left.select(*[new[c].alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, unchanged."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (packed little-endian unsigned 32-bit numbers) and their decoded text."""
    ship(spark)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    rows = bpe.round_trip(docs, tokenizer)
    return rows.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("BPE encoding and decoding", tokens),
]

#: The trained model of the first stage is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
