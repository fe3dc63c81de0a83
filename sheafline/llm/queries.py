"""One query per operator over the given tables, and the SQL each must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    decontamination,
    licenses,
    lm_scores,
    merkle,
    ngram_join,
    periods,
    quality,
    sentence_pieces,
    sql,
    substrings,
    token_counts,
    url_filter,
)
from .common import ascii_lower, ship, word_array

TOKEN_LIMIT = 4096


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _file(name: str) -> bytes:
    """A tokenizer file, a megabyte or two, read on the driver and sent with the task."""
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op1_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = _file("word_bpe_49k.json").decode()
    rows = bpe.round_trip(_read(spark, folder, "documents"), tokenizer)
    return rows.select(
        "doc_id",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.leaks(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))
    return found.drop("text_key")


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.url_verdicts(_read(spark, folder, "pages"))
    terms = {c: F.array_join(c, ",") for c in ("strict_terms", "soft_terms")}
    return judged.withColumns(terms)


def op4_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    rendered = chat.perspectives(_read(spark, folder, "conversations"))
    mask = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return rendered.withColumn("mask", F.array_join(mask, ",")).drop("spans")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    return quality.judge(docs, quality.fit(docs, _read(spark, folder, "labels")))


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    scored = lm_scores.backoff_scores(_read(spark, folder, "documents"))
    # Sums of logarithms depend on their order in the last digits.
    return scored.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log_score")})


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_groups(_read(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substrings.remove_repeats(_read(spark, folder, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_read(spark, folder, "documents"))
    return found.drop("blocks")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.token_counts(_read(spark, folder, "documents"), _file("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_sentencepiece_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    rows = sentence_pieces.round_trip(_read(spark, folder, "documents"), _file("piece_bpe_32k.model"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    tampered = F.when(chosen, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    proven = merkle.manifest(_read(spark, folder, "documents"), claimed={"text": tampered})
    proof = merkle.proof_digest("path").alias("proof_sha256")
    return proven.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of every tenth text repeat with a period from some place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    # Elsewhere the words are null and the text stays as it is.
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, word_array(F.col("text"))).alias("words"))
    rows = rows.withColumns({"n": F.size("words"), "g": F.floor(F.col("h") / 10)})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    one = F.slice("words", F.col("a") + 1, F.col("p"))
    # n - a is less than (3 + 7) * p.
    again = F.slice(F.flatten(F.array_repeat(one, 10)), 1, F.col("n") - F.col("a"))
    planted = F.array_join(F.concat(F.slice("words", 1, F.col("a")), again), " ")
    return rows.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.periodic_runs(_with_planted_periods(_read(spark, folder, "documents")))

    def stronger(best, run):
        better = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(better, run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast(periods.RUN), stronger)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_decontamination": op2_decontamination,
    "op3_url_filter": op3_url_filter,
    "op4_chat_perspectives": op4_chat_perspectives,
    "op5_quality_rules": op5_quality_rules,
    "op6_lm_scores": op6_lm_scores,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_token_counts": op10_token_counts,
    "op11_sentencepiece_round_trip": op11_sentencepiece_round_trip,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {
    "op2_decontamination": sql.decontamination(),
    "op3_url_filter": sql.url_filter(),
    "op4_chat_perspectives": sql.chat_perspectives(),
    "op6_lm_scores": sql.lm_scores(),
    "op7_ngram_jaccard_join": sql.ngram_jaccard_join(),
    "op8_substring_dedup": sql.substring_dedup(),
    "op9_license_scan": sql.license_scan(),
    "op12_merkle_manifest": sql.merkle_manifest(),
    "op13_periodic_runs": sql.periodic_runs(),
}
