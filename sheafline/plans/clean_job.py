"""Cleaning as one job: select, skip what is done, transform, validate, route, append, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.json_schema import error_messages, with_schema_errors
from ..operators.lookups import already_cleaned, by_name, not_cleaned
from ..operators.maintenance import CLEANED_KEY, append_rows, new_rows
from ..operators.ordering import BUCKET_ROWS
from ..operators.selectors import recent, select_ids
from ..schemas import CLEANED_DATA
from ..session import stage
from ..sources.tables import append_table, conform, read_table
from ..vocab import VALIDATION_STATUSES
from .cleaners import Cleaner


# Schemas of cleaned metadata, in the stored form (name, version, JSON Schema).
ARTICLE_SCHEMA = {
    "cleaner_name": "wikipedia_cleaner",
    "current_schema_version": "1.0.0",
    "schema": {
        "type": "object",
        "required": ["cleaned_title", "cleaned_content", "content_word_count"],
        "properties": {
            "cleaned_title": {"type": "string", "minLength": 1},
            "cleaned_content": {"type": "string"},
            "content_word_count": {"type": "integer", "minimum": 0},
            "cleaned_categories": {"type": "array", "items": {"type": "string"}},
        },
    },
}
POLL_SCHEMA = {
    "cleaner_name": "fivethirtyeight_cleaner",
    "current_schema_version": "2.0.0",
    "schema": {
        "type": "object",
        "required": ["cycle", "cleaned_state", "cleaned_candidate_name"],
        "properties": {
            "cycle": {"type": "integer"},
            "cleaned_state": {"type": "string", "minLength": 1},
            "cleaned_candidate_name": {"type": "string", "minLength": 1},
            "pct_estimate": {"type": ["number", "null"], "minimum": 0, "maximum": 100},
            "pct_trend_adjusted": {"type": ["number", "null"], "minimum": 0, "maximum": 100},
        },
    },
}


def select_raw(
    raw: DataFrame,
    statuses: DataFrame | None = None,
    status: str | None = None,
    id_spec: str | None = None,
    hours: int | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Raw rows to clean: by id spec, by status name, by age, or any mix."""
    rows = raw
    if id_spec is not None:
        rows = select_ids(rows, id_spec)
    if status is not None:
        rows = by_name(rows, statuses, "validation_status_id", status)
    if hours is not None:
        rows = recent(rows, hours, as_of)
    return rows


def cleaned_rows(
    raw: DataFrame, cleaned: DataFrame, cleaner: Cleaner, schema_id: int, schema: dict, as_of: str, cleaning_time_ms: int = 0
) -> DataFrame:
    """New cleaned rows (without ids) for the raw rows this cleaner version has not done."""
    todo = not_cleaned(raw, cleaned, cleaner.name, cleaner.version)
    return checked_rows(todo, cleaner, schema_id, schema, as_of, cleaning_time_ms)


def checked_rows(todo: DataFrame, cleaner: Cleaner, schema_id: int, schema: dict, as_of: str, cleaning_time_ms: int = 0) -> DataFrame:
    """Cleaned rows (without ids) for all the given raw rows.

    A row whose transform failed is kept as invalid, with ``{}`` and the reason.
    """
    done = cleaner.transform(todo)
    parsed = done.withColumn("_document", F.try_parse_json("cleaned_metadata"))
    checked = with_schema_errors(parsed, "_document", schema, "_errors")
    valid = F.coalesce(F.size("_errors") == 0, F.lit(False)) & F.col("failure").isNull()
    error = F.coalesce(
        "failure",
        F.when(~valid, F.to_json(F.struct(error_messages(F.col("_errors")).alias("validation_errors")))),
    )
    return checked.select(
        F.col("id").alias("raw_data_id"),
        F.lit(schema_id).cast("bigint").alias("cleaned_data_metadata_schema_id"),
        "title",
        "language_code",
        "url",
        F.coalesce("cleaned_metadata", F.lit("{}")).alias("metadata"),
        F.when(valid, F.lit(VALIDATION_STATUSES.index("valid") + 1))
        .otherwise(F.lit(VALIDATION_STATUSES.index("invalid") + 1))
        .cast("bigint")
        .alias("validation_status_id"),
        error.alias("validation_error"),
        F.lit(cleaner.name).alias("cleaner_used"),
        F.lit(cleaner.version).alias("cleaner_version"),
        F.lit(cleaning_time_ms).cast("bigint").alias("cleaning_time_ms"),
        F.lit(as_of).cast("timestamp").alias("cleaned_at"),
        F.lit(as_of).cast("timestamp").alias("created_at"),
    )


def numbered_cleaned_rows(batch: DataFrame, cleaned: DataFrame, buckets: int | None = None) -> DataFrame:
    """The batch with ids, without keys the table already holds."""
    fresh = new_rows(batch, cleaned, CLEANED_KEY, [F.col("raw_data_id").asc()])
    return append_rows(fresh, conform(cleaned, CLEANED_DATA), F.col("raw_data_id"), buckets)


def clean_results(wanted: DataFrame, cleaned: DataFrame, cleaner: Cleaner) -> DataFrame:
    """Per raw row asked for: its cleaned id (also of an earlier run), and whether it has one."""
    ids = already_cleaned(wanted, cleaned, cleaner.name, cleaner.version).select("raw_data_id", F.col("id").alias("cleaned_id"))
    return wanted.select(F.col("id").alias("raw_data_id")).join(ids, "raw_data_id", "left").withColumn(
        "ok", F.col("cleaned_id").isNotNull()
    )


def _clock() -> Column:
    """Nanoseconds of the machine's clock, read anew for every row."""
    return F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("bigint")


def _timed(staged: DataFrame) -> DataFrame:
    """Staged rows with ``cleaning_time_ms``: the mean time between the rows of their task, in whole milliseconds, at least one."""
    apart = F.max("_clock") - F.min("_clock")
    mean = F.ceil(apart / F.greatest(F.count("*") - 1, F.lit(1)) / 1e6).cast("bigint")
    # One row per task.
    times = staged.groupBy("_task").agg(F.greatest(mean, F.lit(1)).alias("_ms"))
    return staged.join(times, "_task").withColumn("cleaning_time_ms", F.col("_ms")).drop("_task", "_clock", "_ms")


def run_clean(spark: SparkSession, wanted: DataFrame, cleaned_path: str, cleaner: Cleaner, schema_id: int, schema: dict, as_of: str) -> DataFrame:
    """Clean, append once to the Parquet table at ``cleaned_path``, and return one row of figures.

    The rows are cleaned in one pass that writes them to the shared folder. The same
    pass counts them by outcome and reads the clock behind each row: nothing is
    read again for the figures. The new rows are put together before the table is
    touched, so a second run appends nothing.

    Figures: success_count (rows asked for that have a cleaned row in the end),
    error_count (those that have none: repeats of an id), skipped_count (successes of
    earlier runs), valid_count and invalid_count of the new rows, failed_count (invalid
    because their transform failed; kept with the reason), average_time_per_record
    (of the new rows in ms, 0.0 where there are none).
    """
    cleaned = read_table(spark, cleaned_path, CLEANED_DATA)
    asked, outcome = Observation(), Observation()
    valid = VALIDATION_STATUSES.index("valid") + 1
    failed = F.get_json_object("validation_error", "$.cleaning_failed") == "true"
    rows = cleaned_rows(wanted.observe(asked, F.count("*").alias("rows")), cleaned, cleaner, schema_id, schema, as_of)
    rows = rows.observe(
        outcome,
        F.count("*").alias("rows"),
        F.count_if(F.col("validation_status_id") == valid).alias("valid"),
        F.count_if(F.coalesce(failed, F.lit(False))).alias("failed"),
    )
    staged = _timed(stage(rows.withColumns({"_task": F.spark_partition_id(), "_clock": _clock()}), "cleaning"))
    counts = outcome.get
    skipped = asked.get["rows"] - counts["rows"]
    batch = numbered_cleaned_rows(staged, cleaned, buckets=max(1, -(-counts["rows"] // BUCKET_ROWS)))
    times = Observation()
    batch = batch.observe(times, F.count("*").alias("rows"), F.avg("cleaning_time_ms").alias("mean"))
    append_table(batch, cleaned_path)
    written = times.get
    figures = {
        "success_count": written["rows"] + skipped,
        "error_count": counts["rows"] - written["rows"],
        "skipped_count": skipped,
        "valid_count": counts["valid"],
        "invalid_count": counts["rows"] - counts["valid"],
        "failed_count": counts["failed"],
    }
    mean = F.lit(written["mean"] or 0.0).cast("double")
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(k) for k, n in figures.items()], mean.alias("average_time_per_record"))
