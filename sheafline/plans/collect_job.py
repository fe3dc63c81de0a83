"""Collecting and checking as jobs over landed files: attempts, raw rows and target states."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.maintenance import merge_update
from ..operators.resolve import check_targets, page_titles
from ..operators.selectors import not_checked, with_title_and_content
from ..operators.validation import Fields, article_errors, failed_check_targets, poll_errors, route, target_outcomes
from ..sources.pages import article_metadata, article_records
from ..sources.poll_files import match_targets_to_rows, poll_metadata, poll_records
from ..vocab import ATTEMPT_STATUSES, COLLECTION_STATUSES, VALIDATION_STATUSES


@dataclass(frozen=True)
class Collected:
    """Rows to append and the new state of the targets."""

    attempts: DataFrame
    raw: DataFrame
    targets: DataFrame


def _status_id(df: DataFrame, names: list[str], name_col: str, id_col: str) -> DataFrame:
    """Replace a status name by its id in the lookup table of these names."""
    ids = F.create_map(*[F.lit(x) for place, name in enumerate(names, start=1) for x in (name, place)])
    return df.withColumn(id_col, F.element_at(ids, F.col(name_col)).cast("bigint")).drop(name_col)


def _finish(targets: DataFrame, records: DataFrame, metadata: Column, errors: Column, schema_id: int, as_of: str, validate: bool) -> Collected:
    """Attempts and raw rows of the fetched records, and the outcome of every target asked for.

    The target id is the attempt's natural key within one job; the writer numbers both.
    """
    usable = with_title_and_content(records)
    now = F.lit(as_of).cast("timestamp")
    attempts = usable.select(
        "collection_target_id",
        F.col("language_code"),
        F.col("collection_name").alias("search_term_used"),
        F.lit(ATTEMPT_STATUSES.index("success") + 1).cast("bigint").alias("attempt_status_id"),
        F.lit(None).cast("bigint").alias("error_type_id"),
        F.lit(None).cast("string").alias("error_message"),
        now.alias("created_at"),
    )
    routed = route(usable.withColumns({"metadata": metadata, "errors": errors}), validate=validate)
    raw = _status_id(routed, VALIDATION_STATUSES, "validation_status", "validation_status_id").select(
        "collection_target_id",
        F.lit(schema_id).cast("bigint").alias("raw_data_metadata_schema_id"),
        "title",
        "language_code",
        "url",
        "metadata",
        "validation_status_id",
        "validation_error",
        F.lit(None).cast("string").alias("filepath_of_save"),
        now.alias("created_at"),
    )
    outcomes = target_outcomes(targets, usable)
    updates = _status_id(outcomes.select("id", "collection_status_name"), COLLECTION_STATUSES, "collection_status_name", "collection_status_id")
    return Collected(attempts, raw, merge_update(targets, updates, "id", ["collection_status_id"]))


def collect_polls(targets: DataFrame, rows: DataFrame, schema_id: int, as_of: str, validate: bool = False) -> Collected:
    """Fetch the file row each poll target names. ``rows`` carry ``original_row_index``."""
    keyed = targets.select(F.col("id").alias("collection_target_id"), "collection_name", "language_code")
    found = match_targets_to_rows(keyed, rows)
    records = poll_records(found, as_of).withColumn("url", F.lit(None).cast("string"))
    return _finish(targets, records, poll_metadata(records), poll_errors(Fields(records)), schema_id, as_of, validate)


def collect_articles(targets: DataFrame, pages: DataFrame, schema_id: int, as_of: str, validate: bool = False) -> Collected:
    """Fetch the landed page with the title of each article target."""
    titled = article_records(pages, as_of)
    ids = page_titles(titled.select(F.col("language").alias("language_code"), "title", "page_id"))
    keyed = targets.select(
        F.col("id").alias("collection_target_id"), "collection_name", "language_code", F.lower("collection_name").alias("folded")
    )
    matched = keyed.join(ids.select("language_code", "folded", "page_id"), ["language_code", "folded"]).drop("folded")
    records = matched.join(titled, "page_id").withColumn("original_search_title", F.col("collection_name"))
    document = article_metadata(records.drop("collection_target_id", "collection_name", "language_code"))
    return _finish(targets, records, document, article_errors(Fields(records)), schema_id, as_of, validate)


def retry_targets(targets: DataFrame, statuses: list[str] = ("failed",)) -> DataFrame:
    """Targets whose last collection failed."""
    ids = [COLLECTION_STATUSES.index(s) + 1 for s in statuses]
    return targets.filter(F.col("collection_status_id").isin(ids))


@dataclass(frozen=True)
class Checked:
    """Check rows to append and the new state of the targets."""

    checks: DataFrame
    targets: DataFrame


def check_job(targets: DataFrame, pages: DataFrame, checks: DataFrame | None, as_of: str) -> Checked:
    """Check targets against the page catalogue; those with earlier checks are skipped when ``checks`` is given.

    Targets that are not found become ``check_failed``.
    """
    wanted = not_checked(targets, checks) if checks is not None else targets
    results = check_targets(wanted, pages)
    rows = results.select(
        "collection_target_id",
        F.col("collection_name").alias("search_term_used"),
        "language_code",
        "test_status",
        F.to_json("search_results_found").alias("search_results_found"),
        "error_message",
        F.lit(0).cast("bigint").alias("test_duration"),
        F.lit(as_of).cast("timestamp").alias("created_at"),
    )
    updates = _status_id(failed_check_targets(results), COLLECTION_STATUSES, "collection_status_name", "collection_status_id")
    return Checked(rows, merge_update(targets, updates, "id", ["collection_status_id"]))
