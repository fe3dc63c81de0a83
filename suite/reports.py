"""Statistics and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.operators import lookups, ordering, statistics as st

from .base import query


def _rounded(df, *columns, places=6):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(
    "d1_raw_status_counts",
    """SELECT vs.name AS status_name, count(*) AS record_count, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM raw_data), 2) AS percentage
       FROM raw_data rd JOIN validation_statuses vs ON rd.validation_status_id = vs.id GROUP BY vs.name""",
)
def raw_status_counts(v):
    return st.status_counts(v.raw_data(), v.validation_statuses())


@query("d1_raw_totals", "SELECT count(*) AS total_records, count(DISTINCT collection_attempt_id) AS unique_attempts, count(DISTINCT language_code) AS unique_languages FROM raw_data")
def _(v):
    return st.raw_totals(v.raw_data())


@query(
    "d2_cleaned_totals",
    """SELECT count(*) AS total_records, count(DISTINCT raw_data_id) AS unique_raw_data, count(DISTINCT cleaner_used) AS unique_cleaners,
              count(DISTINCT language_code) AS unique_languages, round(avg(cleaning_time_ms), 6) AS avg_cleaning_time_ms,
              min(cleaning_time_ms) AS min_cleaning_time_ms, max(cleaning_time_ms) AS max_cleaning_time_ms FROM cleaned_data""",
)
def _(v):
    return _rounded(st.cleaned_totals(v.cleaned_data()), "avg_cleaning_time_ms")


@query(
    "d2_cleaned_status_counts",
    """SELECT vs.name AS status_name, count(*) AS record_count, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM cleaned_data), 2) AS percentage
       FROM cleaned_data cd JOIN validation_statuses vs ON cd.validation_status_id = vs.id GROUP BY vs.name""",
)
def _(v):
    return st.status_counts(v.cleaned_data(), v.validation_statuses())


@query("d2_cleaner_counts", "SELECT cleaner_used, cleaner_version, count(*) AS record_count, round(avg(cleaning_time_ms), 6) AS avg_cleaning_time_ms FROM cleaned_data GROUP BY ALL")
def _(v):
    return _rounded(st.cleaner_counts(v.cleaned_data()), "avg_cleaning_time_ms")


_PERFORMANCE = """SELECT cleaner_used, cleaner_version, count(*) AS total_cleaned, round(avg(cleaning_time_ms), 6) AS avg_time_ms,
    min(cleaning_time_ms) AS min_time_ms, max(cleaning_time_ms) AS max_time_ms,
    quantile_cont(cleaning_time_ms, 0.5) AS median_time_ms FROM cleaned_data {} GROUP BY cleaner_used, cleaner_version"""


@query("d3_cleaner_performance", _PERFORMANCE.format(""))
def _(v):
    return _rounded(st.cleaner_performance(v.cleaned_data()), "avg_time_ms")


@query("d3_cleaner_performance_one", _PERFORMANCE.format("WHERE cleaner_used = 'table_cleaner'"))
def _(v):
    return _rounded(st.cleaner_performance(v.cleaned_data(), "table_cleaner"), "avg_time_ms")


@query(
    "d3_median_duration",
    "SELECT test_status, language_code, quantile_cont(test_duration, 0.5)::DOUBLE AS median_duration FROM check_collection_targets GROUP BY ALL",
)
def _(v):
    return ordering.exact_median(v.check_collection_targets(), ["test_status", "language_code"], "test_duration", "median_duration")


@query(
    "d4_cleaner_summary",
    """SELECT 'article_cleaner' AS cleaner_name, '2.0.0' AS cleaner_version, count(*) AS total_cleaned,
              count(*) FILTER (WHERE validation_status_id = 1) AS valid_count, count(*) FILTER (WHERE validation_status_id <> 1) AS invalid_count,
              round(count(*) FILTER (WHERE validation_status_id = 1) / count(*) * 100, 6) AS success_rate,
              round(avg(cleaning_time_ms), 6) AS avg_cleaning_time_ms, min(cleaning_time_ms) AS min_cleaning_time_ms,
              max(cleaning_time_ms) AS max_cleaning_time_ms, min(created_at) AS first_cleaned, max(created_at) AS last_cleaned
       FROM cleaned_data WHERE cleaner_used = 'article_cleaner' AND cleaner_version = '2.0.0'""",
)
def _(v):
    return _rounded(st.cleaner_summary(v.cleaned_data(), "article_cleaner", "2.0.0", 1), "success_rate", "avg_cleaning_time_ms")


@query(
    "d5_attempt_statistics",
    """SELECT s.name AS attempt_status_name, count(*) AS attempt_count, count(DISTINCT collection_target_id) AS unique_configs,
              round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM collection_attempts), 2) AS percentage
       FROM collection_attempts a JOIN attempt_statuses s ON a.attempt_status_id = s.id GROUP BY s.name""",
)
def _(v):
    return st.attempt_statistics(v.collection_attempts(), v.attempt_statuses())


@query(
    "d5_failed_by_error",
    """SELECT coalesce(e.name, 'unknown') AS error_type_name, count(*) AS error_count FROM collection_attempts a
       LEFT JOIN error_types e ON a.error_type_id = e.id WHERE a.attempt_status_id = 2 GROUP BY 1""",
)
def _(v):
    return st.failed_by_error(v.collection_attempts(), v.error_types(), 2)


@query(
    "d6_check_statistics",
    """SELECT test_status, count(*) AS test_count, round(avg(test_duration), 6) AS avg_duration, min(test_duration) AS min_duration,
              max(test_duration) AS max_duration, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM check_collection_targets), 2) AS percentage
       FROM check_collection_targets GROUP BY test_status""",
)
def _(v):
    return _rounded(st.check_statistics(v.check_collection_targets()), "avg_duration")


@query(
    "d6_check_languages",
    """SELECT language_code, count(*) AS test_count, count(*) FILTER (WHERE test_status = 'success') AS success_count,
              count(*) FILTER (WHERE test_status = 'failed') AS failed_count FROM check_collection_targets GROUP BY language_code""",
)
def _(v):
    return st.check_languages(v.check_collection_targets())


_RUNS = """SELECT rt.name AS run_type_name, rs.name AS run_status_name, count(*) AS run_count, avg(attempts_successful) AS avg_successful,
    avg(attempts_failed) AS avg_failed, avg(date_diff('second', r.created_at, r.completed_at) / 60) AS avg_duration_minutes
    FROM run_collection_metadata r JOIN run_types rt ON r.run_type_id = rt.id JOIN run_statuses rs ON r.run_status_id = rs.id
    WHERE r.completed_at IS NOT NULL GROUP BY rt.name, rs.name"""


def _run_performance(v):
    return st.run_performance(v.run_collection_metadata(), v.run_types(), v.run_statuses())


@query(
    "d7_run_performance",
    f"""SELECT run_type_name, run_status_name, run_count, round(avg_successful, 6) AS avg_successful, round(avg_failed, 6) AS avg_failed,
               round(avg_duration_minutes, 4) AS avg_duration_minutes FROM ({_RUNS})""",
)
def _(v):
    return _rounded(_rounded(_run_performance(v), "avg_successful", "avg_failed"), "avg_duration_minutes", places=4)


@query(
    "d7_run_summary",
    f"""SELECT sum(run_count)::BIGINT AS total_runs, round(sum(avg_successful * run_count) / sum((avg_successful + avg_failed) * run_count) * 100, 2) AS avg_success_rate,
               round(sum(avg_duration_minutes * run_count) / sum(run_count), 2) AS avg_duration_minutes FROM ({_RUNS})""",
)
def _(v):
    return st.run_summary(_run_performance(v))


@query(
    "d8_duplicate_titles",
    """SELECT title, count(*) AS duplicate_count, min(created_at) AS first_created, max(created_at) AS last_created
       FROM raw_data GROUP BY title HAVING count(*) > 1""",
)
def _(v):
    return st.duplicate_titles(v.raw_data())


@query(
    "d8_duplicate_title_ids",
    """WITH dup AS (SELECT title FROM raw_data GROUP BY title HAVING count(*) > 1)
       SELECT title, id // 10000 AS block, array_to_string(list(id ORDER BY id), ',') AS raw_data_ids FROM raw_data
       WHERE title IN (SELECT title FROM dup) GROUP BY title, id // 10000""",
)
def _(v):
    blocks = st.duplicate_title_ids(v.raw_data())
    return blocks.withColumn("raw_data_ids", F.array_join(F.col("raw_data_ids").cast("array<string>"), ","))


_STATUS_COUNTS = """SELECT coalesce(t.name, 'unknown') AS collection_type, c.language_code, coalesce(s.name, 'unknown') AS collection_status_name, count(*) AS count
    FROM collection_targets c LEFT JOIN collection_types t ON c.collection_type_id = t.id LEFT JOIN collection_statuses s ON c.collection_status_id = s.id GROUP BY 1, 2, 3"""


def _status_counts(v):
    return st.collection_status_counts(v.collection_targets(), v.collection_types(), v.collection_statuses())


@query("d9_collection_status_counts", _STATUS_COUNTS)
def _(v):
    return _status_counts(v)


@query(
    "d9_collection_summary",
    """SELECT count(*) AS total_targets, count(*) FILTER (WHERE collection_status_id = 2) AS collected,
              count(*) FILTER (WHERE collection_status_id = 1) AS not_collected, count(*) FILTER (WHERE collection_status_id = 3) AS failed,
              round(100.0::DOUBLE * count(*) FILTER (WHERE collection_status_id = 2) / count(*), 2) AS collection_percentage FROM collection_targets""",
)
def _(v):
    return st.collection_summary(_status_counts(v))


@query("d10_import_statistics", "SELECT collection_status_id, count(*) AS target_count FROM collection_targets GROUP BY 1")
def _(v):
    return st.import_statistics(v.collection_targets())


@query(
    "d11_collector_status",
    """SELECT t.name AS collection_type, c.language_code, count(*) AS target_count FROM collection_targets c JOIN collection_types t ON c.collection_type_id = t.id
       WHERE collector_name_id = 4 AND collection_status_id = 1 GROUP BY 1, 2""",
)
def _(v):
    return st.collector_status(v.collection_targets(), v.collection_types(), 4, 1)


@query(
    "d11_open_targets",
    """SELECT t.name AS collection_type, c.language_code, c.collection_name, c.id FROM collection_targets c JOIN collection_types t ON c.collection_type_id = t.id
       WHERE collector_name_id = 4 AND collection_status_id = 1""",
)
def _(v):
    return st.open_targets(v.collection_targets(), v.collection_types(), 4, 1)


@query("d12_open_types", "SELECT DISTINCT t.name AS collection_type FROM collection_targets c JOIN collection_types t ON c.collection_type_id = t.id WHERE collector_name_id = 4 AND collection_status_id = 1")
def _(v):
    return st.open_types(v.collection_targets(), v.collection_types(), 4, 1)


@query("d12_open_languages", "SELECT DISTINCT language_code FROM collection_targets WHERE collector_name_id = 4 AND collection_status_id = 1")
def _(v):
    return st.open_languages(v.collection_targets(), 4, 1)


@query(
    "d13_data_summary",
    """SELECT count(*) AS total_records, 'doc_id,lang,source,content' AS columns, round(avg(length(content)), 6) AS average_length,
              quantile_cont(length(content), 0.5) AS median_length, min(length(content)) AS min_length, max(length(content)) AS max_length FROM documents_noised""",
)
def _(v):
    return _rounded(st.data_summary(v.documents_noised()), "average_length")


@query("d13_language_distribution", "SELECT lang, count(*) AS record_count FROM documents GROUP BY lang")
def _(v):
    return st.language_distribution(v.table("documents"), "lang")


@query(
    "d13_median_by_ranges",
    "SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.5) AS median, count(*) AS n FROM lineitem GROUP BY ALL",
)
def _(v):
    """Prices, of which most are different: no task orders the values of a group."""
    keys = ["l_returnflag", "l_linestatus"]
    medians = ordering.run_median(v.table("lineitem"), keys, "l_extendedprice", few=100)
    return medians.join(v.table("lineitem").groupBy(*keys).agg(F.count("*").alias("n")), keys)


@query(
    "d15_batch_result",
    """SELECT count(*) FILTER (WHERE validation_status_id = 1) AS success_count, count(*) FILTER (WHERE validation_status_id <> 1) AS error_count,
              round(avg(cleaning_time_ms), 6) AS average_time_per_record FROM cleaned_data""",
)
def _(v):
    results = v.cleaned_data().select((F.col("validation_status_id") == 1).alias("ok"), "cleaning_time_ms")
    return _rounded(st.batch_result(results, time="cleaning_time_ms"), "average_time_per_record")


@query(
    "d16_check_summary",
    """SELECT 'status' AS grouping, test_status AS value, count(*) AS test_count FROM check_collection_targets GROUP BY test_status
       UNION ALL SELECT 'language', language_code, count(*) FROM check_collection_targets GROUP BY language_code
       UNION ALL SELECT 'total', 'all', count(*) FROM check_collection_targets""",
)
def _(v):
    return st.check_summary(v.check_collection_targets())


@query(
    "d16_recent_failures",
    """SELECT id, search_term_used, language_code, error_message, created_at FROM check_collection_targets WHERE test_status = 'failed'
       ORDER BY created_at DESC, id DESC LIMIT 10""",
)
def _(v):
    return st.recent_failures(v.check_collection_targets())


@query(
    "d17_usage_counts",
    "SELECT s.id, s.name, count(t.id) AS usage_count FROM collection_statuses s LEFT JOIN collection_targets t ON t.collection_status_id = s.id GROUP BY s.id, s.name",
)
def _(v):
    return lookups.usage_counts(v.collection_statuses(), v.collection_targets(), "collection_status_id")


@query(
    "d17_name_exists",
    "SELECT n.name, EXISTS (SELECT 1 FROM collection_targets t WHERE t.collection_name = n.name) AS found FROM (VALUES ('Customer#000000003'), ('nobody')) AS n(name)",
)
def _(v):
    return lookups.name_exists(v.collection_targets().select(F.col("collection_name").alias("name")), ["Customer#000000003", "nobody"])


_GROUPED = """SELECT t.name AS collection_type, language_code, collection_name, id FROM
    (SELECT *, row_number() OVER (PARTITION BY collection_type_id, language_code, collection_name ORDER BY created_at DESC, c.id DESC) AS rn FROM collection_targets c) c
    JOIN collection_types t ON c.collection_type_id = t.id WHERE rn = 1""".replace("collection_name, id FROM", "collection_name, c.id FROM")


@query("d18_grouped_targets", _GROUPED)
def _(v):
    return st.grouped_targets(v.collection_targets(), v.collection_types())


@query(
    "d18_grouped_target_maps",
    f"""SELECT collection_type, language_code, id // 5000 AS block, array_to_string(list(collection_name || '=' || id ORDER BY collection_name), ',') AS entries
        FROM ({_GROUPED}) GROUP BY 1, 2, 3""",
)
def _(v):
    blocks = st.grouped_target_maps(v.collection_targets(), v.collection_types(), width=5000)
    pairs = F.transform(F.map_entries("entries"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return blocks.withColumn("entries", F.array_join(pairs, ","))
