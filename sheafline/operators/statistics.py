"""Reports on the process: counts, shares, durations, duplicates, summaries.

Shares are taken after aggregation: the one-task window that gives the total
runs over the handful of names in a lookup table, never over data rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import char_count
from .lookups import with_name
from .ordering import first_per_key, id_blocks, map_blocks, newest_first



def count_if(test: Column) -> Column:
    return F.count_if(test)


def share(part: Column, total: Column) -> Column:
    """Percentage rounded to 2 places; 0 for an empty total."""
    return F.when(total > 0, F.round(100.0 * part / total, 2)).otherwise(F.lit(0.0))


def _with_share(counts: DataFrame, count: str = "record_count") -> DataFrame:
    return counts.withColumn("percentage", share(F.col(count), F.sum(count).over(W.partitionBy())))


def status_counts(df: DataFrame, statuses: DataFrame, id_col: str = "validation_status_id") -> DataFrame:
    """Rows per status name, with their share of all rows; rows without a known status count in the total only."""
    counts = df.groupBy(id_col).agg(F.count("*").alias("record_count"))
    shared = _with_share(counts)
    names = statuses.select(F.col("id").alias(id_col), F.col("name").alias("status_name"))
    return shared.join(names, id_col).select("status_name", "record_count", "percentage")


def raw_totals(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("collection_attempt_id").alias("unique_attempts"),
        F.countDistinct("language_code").alias("unique_languages"),
    )


def cleaned_totals(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("raw_data_id").alias("unique_raw_data"),
        F.countDistinct("cleaner_used").alias("unique_cleaners"),
        F.countDistinct("language_code").alias("unique_languages"),
        F.avg("cleaning_time_ms").alias("avg_cleaning_time_ms"),
        F.min("cleaning_time_ms").alias("min_cleaning_time_ms"),
        F.max("cleaning_time_ms").alias("max_cleaning_time_ms"),
    )


def cleaner_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("cleaner_used", "cleaner_version").agg(
        F.count("*").alias("record_count"), F.avg("cleaning_time_ms").alias("avg_cleaning_time_ms")
    )


def cleaner_performance(cleaned: DataFrame, cleaner: str | None = None) -> DataFrame:
    """Count, mean, least, most and exact median time per cleaner version."""
    rows = cleaned if cleaner is None else cleaned.filter(F.col("cleaner_used") == cleaner)
    keys = ["cleaner_used", "cleaner_version"]
    # Counting equal times first lets one shuffle of few rows serve every figure.
    times = rows.groupBy(*keys, "cleaning_time_ms").agg(F.count("*").alias("_rows"))
    group = W.partitionBy(*keys)
    value = F.col("cleaning_time_ms")
    timed = F.when(value.isNotNull(), F.col("_rows")).otherwise(F.lit(0))
    reached = F.sum(timed).over(group.orderBy(value.asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0))
    placed = times.select(*keys, value, "_rows", timed.alias("_n"), reached.alias("_to"), F.sum(timed).over(group).alias("_all"))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_to") > place) & (F.col("_to") - F.col("_n") <= place), value))

    return placed.groupBy(*keys).agg(
        F.sum("_rows").alias("total_cleaned"),
        (F.sum(value * F.col("_n")) / F.sum("_n")).alias("avg_time_ms"),
        F.min(value).alias("min_time_ms"),
        F.max(value).alias("max_time_ms"),
        ((at(low) + at(high)) / 2).alias("median_time_ms"),
    )


def cleaner_summary(cleaned: DataFrame, cleaner: str, version: str, valid_status_id: int) -> DataFrame:
    """One row: total, valid, invalid, success rate, times, first and last row of one cleaner version."""
    rows = cleaned.filter((F.col("cleaner_used") == cleaner) & (F.col("cleaner_version") == version))
    valid = count_if(F.col("validation_status_id") == valid_status_id)
    return rows.agg(
        F.count("*").alias("total_cleaned"),
        valid.alias("valid_count"),
        (F.count("*") - valid).alias("invalid_count"),
        F.when(F.count("*") > 0, valid / F.count("*") * 100).otherwise(F.lit(0.0)).alias("success_rate"),
        F.coalesce(F.avg("cleaning_time_ms"), F.lit(0.0)).alias("avg_cleaning_time_ms"),
        F.coalesce(F.min("cleaning_time_ms"), F.lit(0)).alias("min_cleaning_time_ms"),
        F.coalesce(F.max("cleaning_time_ms"), F.lit(0)).alias("max_cleaning_time_ms"),
        F.min("created_at").alias("first_cleaned"),
        F.max("created_at").alias("last_cleaned"),
    ).select(F.lit(cleaner).alias("cleaner_name"), F.lit(version).alias("cleaner_version"), "*")


def attempt_statistics(attempts: DataFrame, statuses: DataFrame) -> DataFrame:
    """Attempts and distinct targets per status, with shares."""
    # Distinct targets in two steps: rows are counted per (status, target) before
    # the shuffle, so a hot status is spread over its targets.
    per_target = attempts.groupBy("attempt_status_id", "collection_target_id").agg(F.count("*").alias("_n"))
    counts = per_target.groupBy("attempt_status_id").agg(
        F.sum("_n").alias("attempt_count"), F.count("collection_target_id").alias("unique_configs")
    )
    named = counts.join(statuses.select(F.col("id").alias("attempt_status_id"), F.col("name").alias("attempt_status_name")), "attempt_status_id")
    return _with_share(named, "attempt_count").drop("attempt_status_id")


def failed_by_error(attempts: DataFrame, errors: DataFrame, failed_status_id: int) -> DataFrame:
    """Failed attempts per error type; those without one show as ``unknown``."""
    counts = (
        attempts.filter(F.col("attempt_status_id") == failed_status_id)
        .groupBy("error_type_id")
        .agg(F.count("*").alias("error_count"))
    )
    named = with_name(counts, errors, "error_type_id", "error_type_name", missing="unknown")
    return named.groupBy("error_type_name").agg(F.sum("error_count").alias("error_count"))


def check_statistics(checks: DataFrame) -> DataFrame:
    """Checks per status with durations and shares."""
    counts = checks.groupBy("test_status").agg(
        F.count("*").alias("test_count"),
        F.avg("test_duration").alias("avg_duration"),
        F.min("test_duration").alias("min_duration"),
        F.max("test_duration").alias("max_duration"),
    )
    return _with_share(counts, "test_count")


def check_languages(checks: DataFrame) -> DataFrame:
    return checks.groupBy("language_code").agg(
        F.count("*").alias("test_count"),
        count_if(F.col("test_status") == "success").alias("success_count"),
        count_if(F.col("test_status") == "failed").alias("failed_count"),
    )


def recent_failures(checks: DataFrame, limit: int = 10) -> DataFrame:
    """The newest failed checks."""
    failed = newest_first(checks.filter(F.col("test_status") == "failed"), limit)
    return failed.select("id", "search_term_used", "language_code", "error_message", "created_at")


def check_summary(checks: DataFrame) -> DataFrame:
    """Totals by status and by language in one pass: ``grouping`` says which."""
    by_both = checks.groupBy("test_status", "language_code").agg(F.count("*").alias("n"))
    sets = by_both.groupingSets(
        [[F.col("test_status")], [F.col("language_code")], []], F.col("test_status"), F.col("language_code")
    ).agg(F.sum("n").alias("test_count"), F.grouping_id().alias("_g"))
    return sets.select(
        F.when(F.col("_g") == 1, "status").when(F.col("_g") == 2, "language").otherwise("total").alias("grouping"),
        F.coalesce("test_status", "language_code", F.lit("all")).alias("value"),
        "test_count",
    )


def minutes_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(60_000_000)


def run_performance(runs: DataFrame, types: DataFrame, statuses: DataFrame) -> DataFrame:
    """Completed runs by (type, status): count, mean successes, failures and minutes."""
    done = runs.filter(F.col("completed_at").isNotNull())
    counts = done.groupBy("run_type_id", "run_status_id").agg(
        F.count("*").alias("run_count"),
        F.avg("attempts_successful").alias("avg_successful"),
        F.avg("attempts_failed").alias("avg_failed"),
        F.avg(minutes_between(F.col("created_at"), F.col("completed_at"))).alias("avg_duration_minutes"),
    )
    named = counts.join(types.select(F.col("id").alias("run_type_id"), F.col("name").alias("run_type_name")), "run_type_id")
    named = named.join(statuses.select(F.col("id").alias("run_status_id"), F.col("name").alias("run_status_name")), "run_status_id")
    return named.drop("run_type_id", "run_status_id")


def run_summary(performance: DataFrame) -> DataFrame:
    """Overall success rate and count-weighted mean minutes of ``run_performance``.

    A group whose mean is exactly 0 minutes is left out of the mean, as is one without any.
    """
    n, ok, bad, minutes = (F.col(c) for c in ("run_count", "avg_successful", "avg_failed", "avg_duration_minutes"))
    timed = minutes.isNotNull() & (minutes != 0)
    tried = F.sum((ok + bad) * n)
    weight = F.sum(F.when(timed, n))
    return performance.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_runs"),
        F.when(tried > 0, F.round(F.sum(ok * n) / tried * 100, 2)).otherwise(F.lit(0.0)).alias("avg_success_rate"),
        F.when(weight > 0, F.round(F.sum(F.when(timed, minutes * n)) / weight, 2)).otherwise(F.lit(0.0)).alias("avg_duration_minutes"),
    )


def duplicate_titles(raw: DataFrame) -> DataFrame:
    """Titles held by more than one row: count, first and last creation."""
    counts = raw.groupBy("title").agg(
        F.count("*").alias("duplicate_count"),
        F.min("created_at").alias("first_created"),
        F.max("created_at").alias("last_created"),
    )
    return counts.filter(F.col("duplicate_count") > 1)


def duplicate_title_ids(raw: DataFrame, width: int = 10_000) -> DataFrame:
    """All row ids of every duplicated title, as sorted arrays in blocks of bounded size.

    Titles are counted first, which the map tasks combine; only rows of duplicated
    titles are made into arrays. Their blocks are cut by id range, so that a title
    held by a third of all rows never meets in one task.
    """
    repeated = raw.groupBy("title").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select("title")
    rows = raw.select("title", "id").join(repeated, "title", "left_semi")
    return id_blocks(rows, ["title"], "id", width).withColumnRenamed("ids", "raw_data_ids")


def collection_status_counts(targets: DataFrame, types: DataFrame, statuses: DataFrame) -> DataFrame:
    """Targets per (type, language, status); unresolved names show as ``unknown``."""
    counts = targets.groupBy("collection_type_id", "language_code", "collection_status_id").agg(F.count("*").alias("count"))
    named = with_name(counts, types, "collection_type_id", "collection_type", missing="unknown")
    named = with_name(named, statuses, "collection_status_id", "collection_status_name", missing="unknown")
    return named.groupBy("collection_type", "language_code", "collection_status_name").agg(F.sum("count").alias("count"))


def collection_summary(counts: DataFrame) -> DataFrame:
    """Totals and collected share of ``collection_status_counts``."""
    name, n = F.col("collection_status_name"), F.col("count")

    def total(status: str) -> Column:
        return F.coalesce(F.sum(F.when(name == status, n)), F.lit(0))

    return counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_targets"),
        total("collected").alias("collected"),
        total("not_collected").alias("not_collected"),
        total("failed").alias("failed"),
        share(total("collected"), F.coalesce(F.sum(n), F.lit(0))).alias("collection_percentage"),
    )


def import_statistics(targets: DataFrame, collector_id: int | None = None) -> DataFrame:
    """Targets per status id."""
    df = targets if collector_id is None else targets.filter(F.col("collector_name_id") == collector_id)
    return df.groupBy("collection_status_id").agg(F.count("*").alias("target_count"))


def collector_status(targets: DataFrame, types: DataFrame, collector_id: int, status_id: int) -> DataFrame:
    """Open targets of a collector: count per type and language."""
    open_targets = targets.filter((F.col("collector_name_id") == collector_id) & (F.col("collection_status_id") == status_id))
    counts = open_targets.groupBy("collection_type_id", "language_code").agg(F.count("*").alias("target_count"))
    return with_name(counts, types, "collection_type_id", "collection_type", missing="unknown").drop("collection_type_id")


def open_targets(targets: DataFrame, types: DataFrame, collector_id: int, status_id: int) -> DataFrame:
    """Open targets of a collector, one row each: type, language, name and id."""
    rows = targets.filter((F.col("collector_name_id") == collector_id) & (F.col("collection_status_id") == status_id))
    named = with_name(rows.select("collection_type_id", "language_code", "collection_name", "id"), types, "collection_type_id", "collection_type", missing="unknown")
    return named.select("collection_type", "language_code", "collection_name", "id")


def open_types(targets: DataFrame, types: DataFrame, collector_id: int, status_id: int) -> DataFrame:
    """Distinct type names with open targets."""
    return collector_status(targets, types, collector_id, status_id).select("collection_type").distinct()


def open_languages(targets: DataFrame, collector_id: int, status_id: int) -> DataFrame:
    """Distinct languages with open targets."""
    open_targets = targets.filter((F.col("collector_name_id") == collector_id) & (F.col("collection_status_id") == status_id))
    return open_targets.select("language_code").distinct()


def grouped_targets(targets: DataFrame, types: DataFrame) -> DataFrame:
    """type → language → name → id, one row per name; of targets with the same name the newest wins."""
    keys = ["collection_type_id", "language_code", "collection_name"]
    newest = first_per_key(
        targets.select(*keys, "created_at", "id"), keys, [F.col("created_at").desc(), F.col("id").desc()]
    )
    named = with_name(newest, types, "collection_type_id", "collection_type", missing="unknown")
    return named.select("collection_type", "language_code", "collection_name", "id")


def grouped_target_maps(targets: DataFrame, types: DataFrame, width: int = 10_000) -> DataFrame:
    """``grouped_targets`` as ``{name: id}`` maps per type and language, in blocks of bounded size."""
    return map_blocks(grouped_targets(targets, types), ["collection_type", "language_code"], "collection_name", "id", width)


def data_summary(records: DataFrame, content: str = "content") -> DataFrame:
    """One row: record count, column names, and mean, median, least and most content length."""
    lengths = records.select(F.when(F.col(content).isNotNull(), char_count(F.col(content))).alias("_len"))
    counts = lengths.groupBy("_len").agg(F.count("*").alias("_n"))
    # One row per distinct text length: bounded by the longest text, not by the rows.
    timed = F.when(F.col("_len").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    running = W.orderBy(F.col("_len").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    placed = counts.select("_len", "_n", timed.alias("_m"), F.sum(timed).over(running).alias("_to"), F.sum(timed).over(W.partitionBy()).alias("_all"))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_to") > place) & (F.col("_to") - F.col("_m") <= place), F.col("_len")))

    return placed.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.lit(",".join(records.columns)).alias("columns"),
        (F.sum(F.col("_len") * F.col("_m")) / F.sum("_m")).alias("average_length"),
        ((at(low) + at(high)) / 2).alias("median_length"),
        F.min("_len").alias("min_length"),
        F.max("_len").alias("max_length"),
    )


def language_distribution(records: DataFrame, language: str = "language") -> DataFrame:
    """Records per language; null is left out."""
    return records.filter(F.col(language).isNotNull()).groupBy(language).agg(F.count("*").alias("record_count"))


def batch_result(results: DataFrame, ok: str = "ok", time: str | None = None) -> DataFrame:
    """Success and error counts of a batch, with the mean time; the ids stay in ``results``."""
    figures = [
        count_if(F.col(ok)).alias("success_count"),
        count_if(~F.col(ok)).alias("error_count"),
    ]
    if time:
        figures.append(F.coalesce(F.avg(time), F.lit(0.0)).alias("average_time_per_record"))
    return results.agg(*figures)


