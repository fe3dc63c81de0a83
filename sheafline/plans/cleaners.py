"""Cleaners: named, versioned ``DataFrame -> DataFrame`` transforms of raw rows.

A transform takes raw rows (with JSON text in ``metadata``) and adds
``cleaned_metadata`` (JSON text, null when it failed) and ``failure`` (JSON
text, null when it did not).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import polls
from ..functions.arrays import clean_string_array, strings_of_variant
from ..functions.jsonio import has_key, is_empty_object, put_fields
from ..functions.text import char_count, clean_text, clean_title, word_count
from ..operators.validation import failure_document
from ..vocab import ARTICLE_CLEANER, ARTICLE_OPERATIONS, POLL_CLEANER, POLL_OPERATIONS


@dataclass(frozen=True)
class Cleaner:
    name: str
    version: str
    transform: Callable[[DataFrame], DataFrame]


_REGISTRY: dict[str, Callable[..., Cleaner]] = {}


def register(name: str, build: Callable[..., Cleaner]) -> None:
    """Make a cleaner available by name; ``build`` takes the options of ``get_cleaner``."""
    _REGISTRY[name] = build


def available_cleaners() -> list[str]:
    return sorted(_REGISTRY)


def get_cleaner(name: str, **options: object) -> Cleaner:
    if name not in _REGISTRY:
        raise ValueError(f"unknown cleaner '{name}'; available: {', '.join(available_cleaners())}")
    return _REGISTRY[name](**options)


# Articles


def article_columns(df: DataFrame) -> DataFrame:
    """Cleaned columns for typed article columns; only inputs that are present are cleaned."""
    have, out = set(df.columns), {}
    if "content" in have:
        out["cleaned_content"] = clean_text(F.col("content"))
    if "summary" in have:
        out["cleaned_summary"] = clean_text(F.col("summary"))
    if "title" in have:
        out["cleaned_title"] = clean_title(F.col("title"))
    if "categories" in have:
        out["cleaned_categories"] = clean_string_array(F.col("categories"))
    if "links" in have:
        out["cleaned_links"] = clean_string_array(F.col("links"))
    df = df.withColumns(out)
    counts = {}
    if "content" in have:
        counts["content_word_count"] = word_count(F.col("cleaned_content"))
        counts["content_char_count"] = char_count(F.col("cleaned_content"))
    if "summary" in have:
        counts["summary_word_count"] = word_count(F.col("cleaned_summary"))
    if "categories" in have:
        counts["category_count"] = F.size("cleaned_categories").cast("bigint")
    if "links" in have:
        counts["internal_link_count"] = F.size("cleaned_links").cast("bigint")
    counts["original_content_length"] = char_count(F.col("content")) if "content" in have else F.lit(0).cast("bigint")
    return df.withColumns(counts)


_ARTICLE_OUT = [
    "cleaned_content", "content_word_count", "content_char_count", "cleaned_summary", "summary_word_count",
    "cleaned_title", "cleaned_categories", "category_count", "cleaned_links", "internal_link_count",
    "cleaned_at", "original_content_length", "cleaning_operations_applied",
]


def article_struct(raw: DataFrame, cleaned_at: str) -> DataFrame:
    """Add ``cleaned``: a struct of the cleaned fields, each null when its key is absent.

    ``not_text`` marks rows whose content is there but is no text.
    """
    parsed = raw.withColumn("_v", F.try_parse_json("metadata"))

    def value(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "variant")

    def text(name: str) -> Column:
        is_text = F.schema_of_variant(value(name)) == "STRING"
        return F.when(is_text, F.try_variant_get("_v", f"$.{name}", "string"))

    names = ["content", "summary", "title", "categories", "links"]
    fields = parsed.withColumns(
        {f"_has_{n}": value(n).isNotNull() for n in names}
        | {f"_{n}": text(n) for n in ("content", "summary", "title")}
        | {f"_{n}": strings_of_variant(value(n)) for n in ("categories", "links")}
    )
    cleaned = fields.withColumns(
        {
            "_c_content": F.when(F.col("_has_content"), clean_text(F.col("_content"))),
            "_c_summary": F.when(F.col("_has_summary"), clean_text(F.col("_summary"))),
            "_c_title": F.when(F.col("_has_title"), clean_title(F.col("_title"))),
            "_c_categories": F.when(F.col("_has_categories"), clean_string_array(F.col("_categories"))),
            "_c_links": F.when(F.col("_has_links"), clean_string_array(F.col("_links"))),
        }
    )

    def counted(name: str, count: Column) -> Column:
        return F.when(F.col(f"_has_{name}"), count)

    struct = F.struct(
        F.col("_c_content").alias("cleaned_content"),
        counted("content", word_count(F.col("_c_content"))).alias("content_word_count"),
        counted("content", char_count(F.col("_c_content"))).alias("content_char_count"),
        F.col("_c_summary").alias("cleaned_summary"),
        counted("summary", word_count(F.col("_c_summary"))).alias("summary_word_count"),
        F.col("_c_title").alias("cleaned_title"),
        F.col("_c_categories").alias("cleaned_categories"),
        counted("categories", F.size("_c_categories").cast("bigint")).alias("category_count"),
        F.col("_c_links").alias("cleaned_links"),
        counted("links", F.size("_c_links").cast("bigint")).alias("internal_link_count"),
        F.lit(cleaned_at).alias("cleaned_at"),
        char_count(F.col("_content")).alias("original_content_length"),
        F.array(*[F.lit(x) for x in ARTICLE_OPERATIONS]).alias("cleaning_operations_applied"),
    )
    return cleaned.select(
        *[F.col(c) for c in raw.columns],
        struct.alias("cleaned"),
        (F.col("_has_content") & F.col("_content").isNull()).alias("not_text"),
    )


def clean_articles(raw: DataFrame, cleaned_at: str) -> DataFrame:
    """Article cleaner: the original metadata with the cleaned fields put over it."""
    nothing = is_empty_object(F.col("metadata"))
    failure = F.when(
        nothing, failure_document(F.concat(F.lit("Raw data ("), F.col("id").cast("string"), F.lit(") has no metadata to clean")))
    ).when(F.coalesce("not_text", F.lit(False)), failure_document(F.lit("content is not text"), "TypeError"))
    cleaned = article_struct(raw, cleaned_at).withColumn("failure", failure)
    added = {name: F.col(f"cleaned.{name}") for name in _ARTICLE_OUT}
    document = F.when(F.col("failure").isNull(), put_fields(F.col("metadata"), added))
    return cleaned.withColumn("cleaned_metadata", document).drop("cleaned", "not_text")


# Polls

POLL_INPUT = (
    "cycle STRING, state STRING, candidate_name STRING, pct_estimate STRING, pct_trend_adjusted STRING, "
    "modeldate STRING, election_date STRING, collection_source STRING, sum_influence STRING"
)


def poll_columns(df: DataFrame, version: str, current_year: int) -> DataFrame:
    """Cleaned columns for text columns of a poll record (see ``POLL_INPUT``).

    Version 2 and later give ``model_date``; earlier ones ``modeldate``,
    ``election_date`` and the days between them. Other input columns are kept.
    """
    raw_names = [part.split()[0] for part in POLL_INPUT.split(", ")]
    held = df.select(
        *[F.col(c) for c in df.columns if c not in raw_names],
        *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(f"_{c}") for c in raw_names],
    )
    newer = polls.version_at_least(version, "2.0.0")
    numbers = ("pct_estimate", "pct_trend_adjusted")
    fields = held.withColumns({f"_{c}": polls.lenient_float(F.col(f"_{c}")) for c in numbers}).withColumns(
        {
            "cycle": polls.lenient_int(F.col("_cycle")),
            "cleaned_state": polls.state_name(F.col("_state")),
            "cleaned_candidate_name": polls.candidate_name(F.col("_candidate_name")),
            "pct_estimate": polls.within_percent(F.col("_pct_estimate")),
            "pct_trend_adjusted": polls.within_percent(F.col("_pct_trend_adjusted")),
            "_model": polls.iso_date_text(F.col("_modeldate")),
            "_election": polls.iso_date_text(F.col("_election_date")),
        }
    )
    pcts = [F.col("pct_estimate"), F.col("pct_trend_adjusted")]
    days = None if newer else polls.days_between(F.col("_model"), F.col("_election"))
    dated = (
        {"model_date": F.col("_model")}
        if newer
        else {"modeldate": F.col("_model"), "election_date": F.col("_election"), "days_before_election": days}
    )
    out = fields.withColumns(
        dated
        | {
            "dataset_type": polls.dataset_type(F.col("cycle")),
            "collection_source": F.col("_collection_source"),
            "data_quality_score": polls.quality_score(
                F.col("cycle"), F.col("cleaned_state"), F.col("cleaned_candidate_name"), F.col("_model"), pcts
            ),
            "is_outlier": polls.is_outlier(pcts, F.col("cycle"), current_year, days),
            "sum_influence": polls.lenient_float(F.col("_sum_influence")),
        }
    )
    return out.drop("_model", "_election", *[f"_{c}" for c in raw_names])


def poll_output_columns(version: str) -> list[str]:
    dates = ["model_date"] if polls.version_at_least(version, "2.0.0") else ["modeldate", "election_date", "days_before_election"]
    return [
        "cycle", "cleaned_state", "cleaned_candidate_name", "pct_estimate", "pct_trend_adjusted", *dates,
        "dataset_type", "collection_source", "data_quality_score", "is_outlier",
    ]


def clean_polls(raw: DataFrame, cleaned_at: str, version: str, current_year: int) -> DataFrame:
    """Poll cleaner: the cleaned fields alone; nulls are kept, influence only when it was there."""
    kept = raw.withColumns(
        {
            "_empty": is_empty_object(F.col("metadata")),
            "_influence": has_key(F.col("metadata"), "sum_influence"),
            "_in": F.from_json("metadata", POLL_INPUT),
        }
    )
    names = [part.split()[0] for part in POLL_INPUT.split(", ")]
    inner = kept.select(F.struct(*raw.columns).alias("_raw"), "_empty", "_influence", *[F.col(f"_in.{n}").alias(n) for n in names])
    cleaned = poll_columns(inner, version, current_year)
    fixed = [
        *[F.col(c) for c in poll_output_columns(version)],
        F.lit(cleaned_at).alias("cleaned_at"),
        F.array(*[F.lit(x) for x in POLL_OPERATIONS]).alias("cleaning_operations_applied"),
    ]
    keep = {"ignoreNullFields": "false"}
    document = F.when(F.col("_influence"), F.to_json(F.struct(*fixed, "sum_influence"), keep)).otherwise(
        F.to_json(F.struct(*fixed), keep)
    )
    failure = F.when(
        F.col("_empty"),
        failure_document(F.concat(F.lit("Raw data ("), F.col("_raw.id").cast("string"), F.lit(") has no metadata to clean"))),
    )
    return cleaned.select("_raw.*", failure.alias("failure"), F.when(~F.col("_empty"), document).alias("cleaned_metadata"))


def _article_cleaner(cleaned_at: str, version: str = ARTICLE_CLEANER[1], **_: object) -> Cleaner:
    return Cleaner(ARTICLE_CLEANER[0], version, lambda raw: clean_articles(raw, cleaned_at))


def _poll_cleaner(cleaned_at: str, current_year: int, version: str = POLL_CLEANER[1], **_: object) -> Cleaner:
    return Cleaner(POLL_CLEANER[0], version, lambda raw: clean_polls(raw, cleaned_at, version, current_year))


register(ARTICLE_CLEANER[0], _article_cleaner)
register(POLL_CLEANER[0], _poll_cleaner)
