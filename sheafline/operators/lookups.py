"""Joins to lookup tables, and joins that show a row with its surroundings.

Lookup tables are small literal or Parquet tables; Spark broadcasts them when
their measured size is below its own threshold, and shuffles them otherwise.
No join here forces a broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsonio import canonical
from ..vocab import values_frame
from .ordering import listed, newest_first


def lookup_values(lookup: DataFrame, name: str | None = None) -> DataFrame:
    """All lookup rows by name, or the one with this name."""
    return lookup.orderBy("name") if name is None else lookup.filter(F.col("name") == name)


def with_name(df: DataFrame, lookup: DataFrame, id_col: str, name_col: str, missing: str | None = None) -> DataFrame:
    """Left join the lookup name; keys without one get ``missing`` (such as ``unknown``)."""
    side = lookup.select(F.col("id").alias(id_col), F.col("name").alias(name_col))
    joined = df.join(side, id_col, "left")
    if missing is not None:
        joined = joined.withColumn(name_col, F.coalesce(F.col(name_col), F.lit(missing)))
    return joined


def with_id(df: DataFrame, lookup: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Left join the lookup id for a name; null when the name is unknown."""
    side = lookup.select(F.col("name").alias(name_col), F.col("id").alias(id_col))
    return df.join(side, name_col, "left")


def by_name(
    df: DataFrame, lookup: DataFrame, id_col: str, name: str, limit: int | None = None, ordered: bool = False
) -> DataFrame:
    """Rows whose lookup name equals ``name``."""
    wanted = lookup.filter(F.col("name") == name).select(F.col("id").alias("_id"))
    return listed(df.join(wanted, df[id_col] == wanted["_id"], "left_semi"), limit, ordered)


def usage_counts(lookup: DataFrame, df: DataFrame, id_col: str) -> DataFrame:
    """How many rows use each lookup value, zeros included."""
    counts = df.groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("usage_count"))
    return lookup.join(counts, "id", "left").select(
        "id", "name", F.coalesce("usage_count", F.lit(0)).alias("usage_count")
    )


def name_exists(lookup: DataFrame, names: list[str]) -> DataFrame:
    """Whether each name is a lookup value."""
    asked = values_frame(lookup.sparkSession, "name STRING", [(n,) for n in names])
    found = lookup.select("name").distinct().withColumn("found", F.lit(True))
    return asked.join(found, "name", "left").select("name", F.coalesce("found", F.lit(False)).alias("found"))


def _named_targets(targets: DataFrame, types: DataFrame) -> DataFrame:
    side = types.select(F.col("id").alias("collection_type_id"), F.col("name").alias("collection_type"))
    return targets.join(side, "collection_type_id", "left").select(
        F.col("id").alias("collection_target_id"), "collection_name", "collection_type"
    )


def _attempt_context(attempts: DataFrame, targets: DataFrame, types: DataFrame) -> DataFrame:
    return (
        attempts.select(
            F.col("id").alias("collection_attempt_id"),
            "collection_target_id",
            "search_term_used",
            F.col("language_code").alias("language_code_used"),
        )
        .join(_named_targets(targets, types), "collection_target_id", "left")
        .drop("collection_target_id")
    )


def raw_with_details(
    raw: DataFrame, statuses: DataFrame, attempts: DataFrame, targets: DataFrame, types: DataFrame, limit: int | None = None
) -> DataFrame:
    """Raw rows with status name, attempt, target and type.

    With a limit the newest rows are picked before the joins, which all keep
    every row of the left side.
    """
    rows = newest_first(raw, limit) if limit else raw
    named = with_name(rows, statuses, "validation_status_id", "validation_status_name")
    joined = named.join(_attempt_context(attempts, targets, types), "collection_attempt_id", "left")
    return newest_first(joined) if limit else joined


def cleaned_with_details(
    cleaned: DataFrame,
    raw: DataFrame,
    statuses: DataFrame,
    attempts: DataFrame,
    targets: DataFrame,
    types: DataFrame,
    limit: int | None = None,
) -> DataFrame:
    """Cleaned rows with status name, raw row, attempt, target and type; with a limit, the newest."""
    rows = newest_first(cleaned, limit) if limit else cleaned
    source = raw.select(
        F.col("id").alias("raw_data_id"),
        F.col("title").alias("raw_data_title"),
        F.col("url").alias("raw_data_url"),
        "collection_attempt_id",
    )
    named = with_name(rows, statuses, "validation_status_id", "validation_status_name")
    joined = named.join(source, "raw_data_id", "left").join(
        _attempt_context(attempts, targets, types), "collection_attempt_id", "left"
    )
    joined = joined.drop("collection_attempt_id")
    return newest_first(joined) if limit else joined


def attempts_with_details(
    attempts: DataFrame, statuses: DataFrame, errors: DataFrame, targets: DataFrame, types: DataFrame, limit: int | None = None
) -> DataFrame:
    """Attempts with status, error type, target and type; with a limit, the newest."""
    rows = newest_first(attempts, limit) if limit else attempts
    named = with_name(rows, statuses, "attempt_status_id", "attempt_status_name")
    named = with_name(named, errors, "error_type_id", "error_type_name")
    joined = named.join(_named_targets(targets, types), "collection_target_id", "left")
    return newest_first(joined) if limit else joined


def attempts_of_run(links: DataFrame, attempts: DataFrame, run_id: int | None = None) -> DataFrame:
    """Attempts linked to one run, or all linked attempts with their run."""
    side = links if run_id is None else links.filter(F.col("run_collection_metadata_id") == run_id)
    side = side.select(F.col("collection_attempt_id").alias("id"), "run_collection_metadata_id")
    return attempts.join(side, "id")


def runs_of_attempt(links: DataFrame, runs: DataFrame, attempt_id: int | None = None) -> DataFrame:
    """Runs linked to one attempt, or all linked runs with their attempt."""
    side = links if attempt_id is None else links.filter(F.col("collection_attempt_id") == attempt_id)
    side = side.select(F.col("run_collection_metadata_id").alias("id"), F.col("collection_attempt_id").alias("linked_attempt_id"))
    return runs.join(side, "id")


def failed_for_retry(
    attempts: DataFrame,
    targets: DataFrame,
    types: DataFrame,
    errors: DataFrame,
    failed_status_id: int,
    collected_status_id: int,
) -> DataFrame:
    """Targets not collected whose latest attempt (largest id) failed; no error type shows as ``unknown``.

    The largest id per target is a plain hash aggregate; the join back is on the
    attempt's own unique id.
    """
    last = attempts.groupBy("collection_target_id").agg(F.max("id").alias("id")).select("id")
    failed = attempts.filter(F.col("attempt_status_id") == failed_status_id).join(last, "id", "left_semi")
    open_targets = targets.filter(F.col("collection_status_id") != collected_status_id)
    joined = failed.select(
        "collection_target_id", "error_message", "error_type_id", F.col("created_at").alias("last_attempt_at")
    ).join(
        open_targets.select(
            F.col("id").alias("collection_target_id"), "collection_name", "language_code", "collection_type_id"
        ),
        "collection_target_id",
    )
    named = with_name(joined, errors, "error_type_id", "error_type_name", missing="unknown")
    named = named.join(
        types.select(F.col("id").alias("collection_type_id"), F.col("name").alias("collection_type")), "collection_type_id"
    )
    return named.select(
        F.col("collection_target_id").alias("config_id"),
        "collection_name",
        "language_code",
        "collection_type",
        "error_message",
        "error_type_name",
        "last_attempt_at",
    ).distinct()


def unused_schemas(schemas: DataFrame, rows: DataFrame, schema_col: str) -> DataFrame:
    """Schemas that no row refers to."""
    used = rows.select(F.col(schema_col).alias("id")).distinct()
    return schemas.join(used, "id", "left_anti")


def same_schema(schemas: DataFrame, documents: DataFrame | str, document: str = "document") -> DataFrame:
    """Schemas equal to a JSON document (or to one of a table), whatever the key order and spacing."""
    mine = canonical(F.col("metadata_schema"))
    if isinstance(documents, str):
        return schemas.filter(mine == canonical(F.lit(documents)))
    wanted = documents.select(canonical(F.col(document)).alias("_document"))
    return schemas.join(wanted, mine == F.col("_document"), "left_semi")


def already_cleaned(raw: DataFrame, cleaned: DataFrame, cleaner: str, version: str) -> DataFrame:
    """Existing cleaned ids of raw rows this cleaner version has done."""
    done = cleaned.filter((F.col("cleaner_used") == cleaner) & (F.col("cleaner_version") == version))
    return done.select("id", "raw_data_id").join(raw.select(F.col("id").alias("raw_data_id")), "raw_data_id", "left_semi")


def not_cleaned(raw: DataFrame, cleaned: DataFrame, cleaner: str, version: str, raw_id: str = "id") -> DataFrame:
    """Raw rows this cleaner version has not done yet."""
    done = cleaned.filter((F.col("cleaner_used") == cleaner) & (F.col("cleaner_version") == version))
    return raw.join(done.select(F.col("raw_data_id").alias("_done")), F.col(raw_id) == F.col("_done"), "left_anti")
