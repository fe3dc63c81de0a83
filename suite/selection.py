"""Selectors, lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.operators import integrity, lookups, ordering, resolve, selectors
from sheafline.session import shared_dir
from sheafline.sources import poll_files
from sheafline.sources.tables import write_bucketed

from .base import query

RAW = "id, title, language_code, validation_status_id, created_at"
TARGETS = "id, collector_name_id, collection_type_id, language_code, collection_name, collection_status_id, created_at"


def _raw(df):
    return df.select(*RAW.split(", "))


def _targets(df):
    return df.select(*TARGETS.split(", "))


@query("b1_by_ids", f"SELECT {TARGETS} FROM collection_targets WHERE id IN (SELECT collection_target_id FROM collection_attempts WHERE attempt_status_id = 2)")
def _(v):
    failed = v.collection_attempts().filter("attempt_status_id = 2").select("collection_target_id")
    return _targets(selectors.by_ids(v.collection_targets(), failed))


@query("b1_by_short_list", f"SELECT {TARGETS} FROM collection_targets WHERE id IN (3, 17, 99, 4000)")
def _(v):
    return _targets(selectors.by_ids(v.collection_targets(), [3, 17, 99, 4000, 17]))


@query("b2_id_ranges", f"SELECT {RAW} FROM raw_data WHERE id BETWEEN 10 AND 300 OR id = 350 OR id BETWEEN 500 AND 900")
def _(v):
    return _raw(selectors.select_ids(v.raw_data(), "10-300, 350, 9-2, 1-2-3, 500-900"))


@query("b3_equal_path", f"SELECT {RAW} FROM raw_data WHERE filepath_of_save = 'store/src3.json'")
def _(v):
    return _raw(selectors.where_equal(v.raw_data(), filepath_of_save="store/src3.json"))


@query("b3_equal_schema", "SELECT id, raw_data_id, cleaner_used FROM cleaned_data WHERE cleaned_data_metadata_schema_id = 2")
def _(v):
    return selectors.where_equal(v.cleaned_data(), cleaned_data_metadata_schema_id=2).select("id", "raw_data_id", "cleaner_used")


@query("b3_equal_target_status", "SELECT id, collection_target_id, search_term_used FROM check_collection_targets WHERE test_status = 'failed' AND collection_target_id = 8")
def _(v):
    found = selectors.where_equal(v.check_collection_targets(), test_status="failed", collection_target_id=8)
    return found.select("id", "collection_target_id", "search_term_used")


@query("b4_by_cleaner", "SELECT id, cleaner_used, cleaner_version FROM cleaned_data WHERE cleaner_used = 'article_cleaner'")
def _(v):
    return selectors.by_cleaner(v.cleaned_data(), "article_cleaner").select("id", "cleaner_used", "cleaner_version")


@query("b4_by_cleaner_version", "SELECT id, cleaner_used, cleaner_version FROM cleaned_data WHERE cleaner_used = 'article_cleaner' AND cleaner_version = '2.0.0'")
def _(v):
    return selectors.by_cleaner(v.cleaned_data(), "article_cleaner", "2.0.0").select("id", "cleaner_used", "cleaner_version")


@query("b5_recent_raw", f"SELECT {RAW} FROM raw_data WHERE created_at >= TIMESTAMP '2024-01-01 12:00:00' - INTERVAL 6 HOUR")
def _(v):
    return _raw(selectors.recent(v.raw_data(), 6, "2024-01-01 12:00:00"))


@query("b5_recent_attempts", "SELECT id, collection_target_id, created_at FROM collection_attempts WHERE created_at >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 48 HOUR")
def _(v):
    return selectors.recent(v.collection_attempts(), 48, "2024-01-20 00:00:00").select("id", "collection_target_id", "created_at")


@query("b6_title_contains", f"SELECT {RAW} FROM raw_data WHERE title ILIKE '%THE%'")
def _(v):
    return _raw(selectors.contains(v.raw_data(), "title", "THE"))


@query("b6_term_contains", "SELECT id, search_term_used FROM collection_attempts WHERE search_term_used ILIKE '%Err_r 1%'")
def _(v):
    return selectors.contains(v.collection_attempts(), "search_term_used", "Err_r 1").select("id", "search_term_used")


@query("b7_field_contains", f"SELECT {RAW} FROM raw_data WHERE json_extract_string(metadata, '$.content') ILIKE '%ther the%'")
def _(v):
    return _raw(selectors.metadata_contains(v.raw_data(), "ther the", "content"))


@query("b7_metadata_contains", f"SELECT {RAW} FROM raw_data WHERE metadata ILIKE '%SRC7%'")
def _(v):
    return _raw(selectors.metadata_contains(v.raw_data(), "SRC7"))


@query(
    "b8_field_values",
    """SELECT id, created_at, json_extract_string(metadata, '$.source') AS field_value FROM raw_data
       WHERE json_extract_string(metadata, '$.source') IS NOT NULL ORDER BY created_at DESC, id DESC LIMIT 100""",
)
def _(v):
    return selectors.field_values(v.raw_data(), "source", 100)


def _schemas(v):
    """One stored schema per document source, naming a property after it."""
    docs = v.table("documents").groupBy("source").agg(F.min("doc_id").alias("id"), F.max("n_chars").alias("longest"))
    return docs.select(
        "id",
        F.format_string(
            '{"cleaner_name": "%s", "current_schema_version": "1.%d.0", "schema": {"type": "object", "properties": {"%s_title": {"maxLength": %d}}}}',
            "source", F.col("id") % 3, "source", "longest",
        ).alias("metadata_schema"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.col("id") * F.make_dt_interval(mins=F.lit(1))).alias("created_at"),
    )


SCHEMAS_SQL = """stored_schemas AS (
    SELECT min(doc_id) AS id,
           '{"cleaner_name": "' || source || '", "current_schema_version": "1.' || min(doc_id) % 3 || '.0", "schema": {"type": "object", "properties": {"'
           || source || '_title": {"maxLength": ' || max(n_chars) || '}}}}' AS metadata_schema,
           TIMESTAMP '2024-01-01 00:00:00' + min(doc_id) * INTERVAL 1 MINUTE AS created_at
    FROM documents GROUP BY source)"""


@query("b9_schema_property", f"WITH {SCHEMAS_SQL} SELECT id, created_at FROM stored_schemas WHERE metadata_schema ILIKE '%\"src7_title\"%'")
def _(v):
    return selectors.schemas_with_property(_schemas(v), "src7_title").select("id", "created_at")


@query("b9_schema_top_level", f"WITH {SCHEMAS_SQL} SELECT id, created_at FROM stored_schemas WHERE list_contains(json_keys(metadata_schema), 'schema')")
def _(v):
    return selectors.schemas_with_property(_schemas(v), "schema", top_level_only=True).select("id", "created_at")


@query(
    "b10_select_targets",
    f"""SELECT {TARGETS} FROM collection_targets WHERE collector_name_id = 2 AND collection_status_id = 1
        AND collection_type_id IN (1, 5) AND language_code IN ('NATION_3', 'NATION_7', 'NATION_11')""",
)
def _(v):
    return _targets(selectors.select_targets(v.collection_targets(), 2, 1, [1, 5], ["NATION_3", "NATION_7", "NATION_11"]))


@query("b10_select_targets_collector", f"SELECT {TARGETS} FROM collection_targets WHERE collector_name_id = 2 AND collection_status_id = 1")
def _(v):
    return _targets(selectors.select_targets(v.collection_targets(), 2, 1))


@query("b11_targets_by_type_language", f"SELECT {TARGETS} FROM collection_targets WHERE collection_type_id = 3 AND language_code = 'NATION_4' AND collection_status_id = 3")
def _(v):
    return _targets(selectors.select_targets(v.collection_targets(), status_id=3, type_ids=[3], languages=["NATION_4"]))


@query("b11_targets_by_status", f"SELECT {TARGETS} FROM collection_targets WHERE collection_status_id = 3")
def _(v):
    return _targets(selectors.select_targets(v.collection_targets(), status_id=3))


@query(
    "b13_not_checked",
    f"SELECT {TARGETS} FROM collection_targets WHERE id NOT IN (SELECT collection_target_id FROM check_collection_targets)",
)
def _(v):
    return _targets(selectors.not_checked(v.collection_targets(), v.check_collection_targets()))


@query(
    "b14_select_for_check",
    f"""SELECT {TARGETS} FROM collection_targets WHERE collection_type_id IN (1, 2) AND language_code IN ('NATION_1', 'NATION_2')
        AND id NOT IN (SELECT collection_target_id FROM check_collection_targets)""",
)
def _(v):
    return _targets(selectors.select_for_check(v.collection_targets(), v.check_collection_targets(), [1, 2], ["NATION_1", "NATION_2"]))


@query("b15_title_and_content", "SELECT id, title FROM raw_data WHERE title <> '' AND json_extract_string(metadata, '$.content') <> ''")
def _(v):
    raw = v.raw_data().withColumn("content", F.get_json_object("metadata", "$.content"))
    return selectors.with_title_and_content(raw).select("id", "title")


@query(
    "b16_lookup_values",
    "SELECT s.id, s.name, count(t.id) AS target_count FROM collection_statuses s LEFT JOIN collection_targets t ON t.collection_status_id = s.id GROUP BY s.id, s.name",
)
def _(v):
    counts = v.collection_targets().groupBy(F.col("collection_status_id").alias("id")).agg(F.count("*").alias("n"))
    found = lookups.lookup_values(v.collection_statuses()).join(counts, "id", "left")
    return found.select("id", "name", F.coalesce("n", F.lit(0)).alias("target_count"))


@query("c1_by_status_name", f"SELECT {RAW.replace('id, title', 'r.id, title')} FROM raw_data r JOIN validation_statuses s ON r.validation_status_id = s.id WHERE s.name = 'invalid'")
def _(v):
    return _raw(lookups.by_name(v.raw_data(), v.validation_statuses(), "validation_status_id", "invalid"))


@query("c1_by_error_name", "SELECT a.id, a.error_message FROM collection_attempts a JOIN error_types e ON a.error_type_id = e.id WHERE e.name = 'server_error'")
def _(v):
    return lookups.by_name(v.collection_attempts(), v.error_types(), "error_type_id", "server_error").select("id", "error_message")


@query("c1_by_run_type", "SELECT r.id, r.attempts_successful FROM run_collection_metadata r JOIN run_types t ON r.run_type_id = t.id WHERE t.name = '2-HIGH'")
def _(v):
    return lookups.by_name(v.run_collection_metadata(), v.run_types(), "run_type_id", "2-HIGH").select("id", "attempts_successful")


_CONTEXT = """LEFT JOIN collection_attempts ca ON {key} = ca.id
    LEFT JOIN collection_targets cfg ON ca.collection_target_id = cfg.id
    LEFT JOIN collection_types ct ON cfg.collection_type_id = ct.id"""
_CONTEXT_COLS = "ca.search_term_used, ca.language_code AS language_code_used, cfg.collection_name, ct.name AS collection_type"
_CONTEXT_NAMES = ["search_term_used", "language_code_used", "collection_name", "collection_type"]


@query(
    "c2_raw_with_details",
    f"""SELECT rd.id, rd.title, rd.created_at, vs.name AS validation_status_name, {_CONTEXT_COLS}
        FROM raw_data rd LEFT JOIN validation_statuses vs ON rd.validation_status_id = vs.id {_CONTEXT.format(key='rd.collection_attempt_id')}""",
)
def _(v):
    rows = lookups.raw_with_details(v.raw_data(), v.validation_statuses(), v.collection_attempts(), v.collection_targets(), v.collection_types())
    return rows.select("id", "title", "created_at", "validation_status_name", *_CONTEXT_NAMES)


@query(
    "c2_raw_with_details_newest",
    f"""SELECT rd.id, rd.created_at, vs.name AS validation_status_name, {_CONTEXT_COLS}
        FROM raw_data rd LEFT JOIN validation_statuses vs ON rd.validation_status_id = vs.id {_CONTEXT.format(key='rd.collection_attempt_id')}
        ORDER BY rd.created_at DESC, rd.id DESC LIMIT 50""",
)
def _(v):
    rows = lookups.raw_with_details(
        v.raw_data(), v.validation_statuses(), v.collection_attempts(), v.collection_targets(), v.collection_types(), limit=50
    )
    return rows.select("id", "created_at", "validation_status_name", *_CONTEXT_NAMES)


@query(
    "c3_cleaned_with_details",
    f"""SELECT cd.id, cd.cleaner_used, vs.name AS validation_status_name, rd.title AS raw_data_title, rd.url AS raw_data_url, {_CONTEXT_COLS}
        FROM cleaned_data cd LEFT JOIN validation_statuses vs ON cd.validation_status_id = vs.id
        LEFT JOIN raw_data rd ON cd.raw_data_id = rd.id {_CONTEXT.format(key='rd.collection_attempt_id')}""",
)
def _(v):
    rows = lookups.cleaned_with_details(
        v.cleaned_data(), v.raw_data(), v.validation_statuses(), v.collection_attempts(), v.collection_targets(), v.collection_types()
    )
    return rows.select("id", "cleaner_used", "validation_status_name", "raw_data_title", "raw_data_url", *_CONTEXT_NAMES)


@query(
    "c4_attempts_with_details",
    """SELECT ca.id, ca.created_at, s.name AS attempt_status_name, e.name AS error_type_name, cfg.collection_name, ct.name AS collection_type
       FROM collection_attempts ca LEFT JOIN attempt_statuses s ON ca.attempt_status_id = s.id LEFT JOIN error_types e ON ca.error_type_id = e.id
       LEFT JOIN collection_targets cfg ON ca.collection_target_id = cfg.id LEFT JOIN collection_types ct ON cfg.collection_type_id = ct.id""",
)
def _(v):
    rows = lookups.attempts_with_details(v.collection_attempts(), v.attempt_statuses(), v.error_types(), v.collection_targets(), v.collection_types())
    return rows.select("id", "created_at", "attempt_status_name", "error_type_name", "collection_name", "collection_type")


@query(
    "c5_failed_for_retry",
    """SELECT DISTINCT cfg.id AS config_id, cfg.collection_name, cfg.language_code, ct.name AS collection_type, ca.error_message,
              coalesce(et.name, 'unknown') AS error_type_name, ca.created_at AS last_attempt_at
       FROM collection_targets cfg JOIN collection_types ct ON cfg.collection_type_id = ct.id
       JOIN collection_attempts ca ON cfg.id = ca.collection_target_id LEFT JOIN error_types et ON ca.error_type_id = et.id
       WHERE cfg.collection_status_id <> 2 AND ca.attempt_status_id = 2
         AND ca.id = (SELECT max(ca2.id) FROM collection_attempts ca2 WHERE ca2.collection_target_id = cfg.id)""",
)
def _(v):
    return lookups.failed_for_retry(v.collection_attempts(), v.collection_targets(), v.collection_types(), v.error_types(), 2, 2)


@query(
    "c6_unused_schemas",
    f"WITH {SCHEMAS_SQL} SELECT s.id, s.metadata_schema FROM stored_schemas s LEFT JOIN cleaned_data c ON s.id = c.cleaned_data_metadata_schema_id WHERE c.id IS NULL",
)
def _(v):
    return lookups.unused_schemas(_schemas(v), v.cleaned_data(), "cleaned_data_metadata_schema_id").select("id", "metadata_schema")


_NOT_CLEANED = f"""SELECT {RAW} FROM raw_data r WHERE NOT EXISTS (SELECT 1 FROM cleaned_data c
        WHERE c.raw_data_id = r.id AND c.cleaner_used = 'article_cleaner' AND c.cleaner_version = '2.0.0')"""


@query("c7_not_cleaned", _NOT_CLEANED)
def _(v):
    return _raw(lookups.not_cleaned(v.raw_data(), v.cleaned_data(), "article_cleaner", "2.0.0"))


@query("c7_not_cleaned_bucketed", _NOT_CLEANED)
def _(v):
    """Both tables dealt by the raw id when they were written."""
    base = shared_dir(v.spark, "bucketed")
    tables = {}
    for name, rows, key in (("raw", v.raw_data(), "id"), ("cleaned", v.cleaned_data(), "raw_data_id")):
        # The catalog entry is of this session; the files lie in the shared folder.
        tables[name] = f"{name}_{base[-12:]}"
        write_bucketed(rows, tables[name], key, 8, f"{base}/{name}")
    raw, cleaned = (v.spark.table(t) for t in tables.values())
    return _raw(lookups.not_cleaned(raw, cleaned, "article_cleaner", "2.0.0"))


@query(
    "c7_already_cleaned",
    """SELECT c.id, c.raw_data_id FROM cleaned_data c WHERE c.cleaner_used = 'article_cleaner' AND c.cleaner_version = '2.0.0'
       AND c.raw_data_id IN (SELECT id FROM raw_data WHERE language_code = 'en')""",
)
def _(v):
    english = v.raw_data().filter("language_code = 'en'")
    return lookups.already_cleaned(english, v.cleaned_data(), "article_cleaner", "2.0.0").select("id", "raw_data_id")


@query("c8_names_with_unknown", "SELECT a.id, coalesce(e.name, 'unknown') AS error_type_name FROM collection_attempts a LEFT JOIN error_types e ON a.error_type_id = e.id")
def _(v):
    return lookups.with_name(v.collection_attempts(), v.error_types(), "error_type_id", "error_type_name", missing="unknown").select("id", "error_type_name")


@query("c8_ids_of_names", "SELECT l.l_orderkey, l.l_linenumber, n.id AS source_id FROM (SELECT *, CASE l_linestatus WHEN 'F' THEN 'failed' ELSE 'missing' END AS name FROM lineitem) l LEFT JOIN attempt_statuses n ON l.name = n.name")
def _(v):
    named = v.table("lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linestatus") == "F", "failed").otherwise("missing").alias("name"))
    return lookups.with_id(named, v.attempt_statuses(), "name", "source_id").drop("name")


@query(
    "c9_targets_to_rows",
    """WITH t AS (SELECT o_orderkey, o_orderstatus || '_' || o_orderpriority || '_name_' || (o_custkey + 2) AS collection_name FROM orders)
       SELECT t.o_orderkey, c.c_custkey AS original_row_index, c.c_name FROM t
       JOIN customer c ON CAST(split_part(t.collection_name, '_', -1) AS BIGINT) - 2 = c.c_custkey""",
)
def _(v):
    names = v.table("orders").select(
        "o_orderkey",
        F.concat_ws("_", "o_orderstatus", "o_orderpriority", F.lit("name"), (F.col("o_custkey") + 2).cast("string")).alias("collection_name"),
    )
    rows = v.table("customer").select(F.col("c_custkey").alias("original_row_index"), "c_name")
    return poll_files.match_targets_to_rows(names, rows).select("o_orderkey", "original_row_index", "c_name")


@query(
    "c10_attempts_of_runs",
    "SELECT a.id, a.attempt_status_id, l.run_collection_metadata_id FROM collection_attempts a JOIN link_attempts_to_runs l ON l.collection_attempt_id = a.id",
)
def _(v):
    rows = lookups.attempts_of_run(v.link_attempts_to_runs(), v.collection_attempts())
    return rows.select("id", "attempt_status_id", "run_collection_metadata_id")


@query(
    "c10_runs_of_attempts",
    "SELECT r.id, r.run_type_id, l.collection_attempt_id AS linked_attempt_id FROM run_collection_metadata r JOIN link_attempts_to_runs l ON l.run_collection_metadata_id = r.id",
)
def _(v):
    return lookups.runs_of_attempt(v.link_attempts_to_runs(), v.run_collection_metadata()).select("id", "run_type_id", "linked_attempt_id")


def _page_targets(v):
    """Wanted titles: page titles, titles with a lost last word, and words no page has."""
    pages = v.stored_page_catalogue()
    title = F.col("title")
    return pages.select(
        F.col("page_id").alias("id"),
        "language_code",
        F.when(F.col("url").like("https:%"), F.lower(title))
        .when(F.col("url").like("%#top"), F.concat(F.lit("zzqx"), F.col("page_id").cast("string")))
        .otherwise(F.regexp_replace(title, " [^ ]*$", ""))
        .alias("collection_name"),
    )


PAGE_TARGETS_SQL = """page_targets AS (
    SELECT page_id AS id, language_code,
           CASE WHEN url LIKE 'https:%' THEN lower(title) WHEN url LIKE '%#top' THEN 'zzqx' || page_id
                ELSE regexp_replace(title, ' [^ ]*$', '') END AS collection_name
    FROM page_catalogue),
titles AS (
    SELECT language_code, lower(title) AS folded, arg_min(title, page_id) AS title, min(page_id) AS page_id
    FROM page_catalogue GROUP BY language_code, lower(title)),
misses AS (
    SELECT DISTINCT t.language_code, lower(t.collection_name) AS folded FROM page_targets t
    WHERE NOT EXISTS (SELECT 1 FROM titles x WHERE x.language_code = t.language_code AND x.folded = lower(t.collection_name))),
compared AS (
    SELECT m.language_code, m.folded, t.title, t.page_id, len(list_distinct(regexp_extract_all(m.folded, '[^\\s]+'))) AS n_words,
           len(list_intersect(regexp_extract_all(m.folded, '[^\\s]+'), regexp_extract_all(lower(t.title), '[^\\s]+'))) AS shared
    FROM misses m JOIN titles t ON m.language_code = t.language_code),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY language_code, folded ORDER BY shared DESC, title, page_id) AS place
    FROM compared WHERE shared > 0 AND 3 * shared >= n_words),
found AS (
    SELECT language_code, folded, list(title ORDER BY place) AS titles FROM ranked WHERE place <= 10 GROUP BY language_code, folded)"""


@query(
    "c11_check_targets",
    f"""WITH {PAGE_TARGETS_SQL}
        SELECT t.id AS collection_target_id, t.collection_name, t.language_code,
               CASE WHEN x.title IS NOT NULL THEN 'success' WHEN f.titles IS NOT NULL THEN 'failed_with_suggestions' ELSE 'failed' END AS test_status,
               CASE WHEN x.title IS NOT NULL THEN x.title WHEN f.titles IS NOT NULL THEN array_to_string(f.titles[1:5], ' | ') ELSE '' END AS search_results,
               CASE WHEN x.title IS NOT NULL THEN '' WHEN f.titles IS NOT NULL THEN 'Target not found, but ' || len(f.titles) || ' search suggestions available'
                    ELSE 'Target not found and no search suggestions available' END AS error_message
        FROM page_targets t LEFT JOIN titles x ON x.language_code = t.language_code AND x.folded = lower(t.collection_name)
        LEFT JOIN found f ON f.language_code = t.language_code AND f.folded = lower(t.collection_name)""",
)
def _(v):
    checked = resolve.check_targets(_page_targets(v), v.stored_page_catalogue())
    return checked.withColumn("search_results", F.array_join("search_results_found", " | ")).drop("search_results_found")


@query(
    "c12_resolve_pages",
    f"""WITH {PAGE_TARGETS_SQL}
        SELECT t.id AS collection_target_id, t.collection_name, t.language_code,
               CASE WHEN x.title IS NOT NULL THEN 'exact' WHEN f.titles IS NOT NULL THEN 'search' ELSE 'none' END AS resolved_by,
               coalesce(x.title, f.titles[1]) AS resolved_title, y.page_id
        FROM page_targets t LEFT JOIN titles x ON x.language_code = t.language_code AND x.folded = lower(t.collection_name)
        LEFT JOIN found f ON f.language_code = t.language_code AND f.folded = lower(t.collection_name)
        LEFT JOIN titles y ON y.language_code = t.language_code AND y.title = coalesce(x.title, f.titles[1])""",
)
def _(v):
    return resolve.resolve_pages(_page_targets(v), v.stored_page_catalogue())


def _aliases(v):
    """First words of titles as ambiguous names; each second name leads to another such name first."""
    pages = v.stored_page_catalogue()
    first = F.split_part("title", F.lit(" "), F.lit(1))
    direct = pages.select("language_code", first.alias("alias"), F.col("title").alias("option"), (F.col("page_id") * 2 + 1).alias("position"))
    indirect = pages.select(
        "language_code", F.concat(F.lit("See "), first).alias("alias"), first.alias("option"), (F.col("page_id") * 2).alias("position")
    )
    return direct.unionByName(indirect)


@query(
    "c13_resolve_aliases",
    """WITH titles AS (
           SELECT language_code, lower(title) AS folded, arg_min(title, page_id) AS title, min(page_id) AS page_id
           FROM page_catalogue GROUP BY language_code, lower(title)),
       aliases AS (
           SELECT language_code, split_part(title, ' ', 1) AS alias, title AS option, page_id * 2 + 1 AS position FROM page_catalogue
           UNION ALL SELECT language_code, 'See ' || split_part(title, ' ', 1), split_part(title, ' ', 1), page_id * 2 FROM page_catalogue),
       options AS (
           SELECT * FROM (SELECT language_code, lower(alias) AS alias, lower(option) AS target,
                  row_number() OVER (PARTITION BY language_code, lower(alias) ORDER BY position, option) AS place FROM aliases) WHERE place <= 5),
       direct AS (
           SELECT o.language_code, o.alias, o.place, o.target, CASE WHEN a.alias IS NULL THEN t.page_id END AS page_id
           FROM options o LEFT JOIN titles t ON o.language_code = t.language_code AND o.target = t.folded
           LEFT JOIN (SELECT DISTINCT language_code, alias FROM options) a ON o.language_code = a.language_code AND o.target = a.alias),
       best AS (SELECT language_code, alias, arg_min(page_id, place) AS page_id FROM direct WHERE page_id IS NOT NULL GROUP BY 1, 2),
       deep AS (
           SELECT d.language_code, d.alias, d.place, coalesce(d.page_id, b.page_id) AS page_id
           FROM direct d LEFT JOIN best b ON d.language_code = b.language_code AND d.target = b.alias),
       answer AS (SELECT language_code, alias, arg_min(page_id, place) AS page_id FROM deep WHERE page_id IS NOT NULL GROUP BY 1, 2),
       asked AS (SELECT DISTINCT language_code, alias AS title FROM aliases)
       SELECT q.language_code, q.title, t.title AS page_title, t.page_id
       FROM asked q LEFT JOIN answer a ON q.language_code = a.language_code AND lower(q.title) = a.alias
       LEFT JOIN titles t ON t.page_id = a.page_id""",
)
def _(v):
    aliases = _aliases(v)
    asked = aliases.select("language_code", F.col("alias").alias("title")).distinct()
    return resolve.resolve_aliases(asked, aliases, v.stored_page_catalogue())


@query(
    "c14_orphans",
    """SELECT 'collection_attempts' AS child, 'collection_target_id' AS column_name, 'collection_targets' AS parent,
              (SELECT count(*) FROM collection_attempts WHERE collection_target_id NOT IN (SELECT id FROM collection_targets)) AS orphan_count
       UNION ALL SELECT 'raw_data', 'collection_attempt_id', 'collection_attempts',
              (SELECT count(*) FROM raw_data WHERE collection_attempt_id NOT IN (SELECT id FROM collection_attempts))
       UNION ALL SELECT 'check_collection_targets', 'collection_target_id', 'collection_targets',
              (SELECT count(*) FROM check_collection_targets WHERE collection_target_id NOT IN (SELECT id FROM collection_targets))
       UNION ALL SELECT 'run_collection_metadata', 'collection_attempt_id', 'collection_attempts', 0
       UNION ALL SELECT 'link_attempts_to_runs', 'collection_attempt_id', 'collection_attempts',
              (SELECT count(*) FROM link_attempts_to_runs WHERE collection_attempt_id NOT IN (SELECT id FROM collection_attempts))
       UNION ALL SELECT 'link_attempts_to_runs', 'run_collection_metadata_id', 'run_collection_metadata',
              (SELECT count(*) FROM link_attempts_to_runs WHERE run_collection_metadata_id NOT IN (SELECT id FROM run_collection_metadata))
       UNION ALL SELECT 'cleaned_data', 'raw_data_id', 'raw_data',
              (SELECT count(*) FROM cleaned_data WHERE raw_data_id NOT IN (SELECT id FROM raw_data))""",
)
def _(v):
    names = ["collection_targets", "collection_attempts", "raw_data", "check_collection_targets", "run_collection_metadata", "link_attempts_to_runs", "cleaned_data"]
    return integrity.orphan_report({n: getattr(v, n)() for n in names})


@query(
    "c14_orphan_links",
    "SELECT collection_attempt_id, run_collection_metadata_id FROM link_attempts_to_runs WHERE run_collection_metadata_id NOT IN (SELECT id FROM run_collection_metadata WHERE completed_at IS NOT NULL)",
)
def _(v):
    runs = v.run_collection_metadata().filter("completed_at IS NOT NULL")
    return integrity.orphans(v.link_attempts_to_runs(), "run_collection_metadata_id", runs)


@query(
    "c14_cascade",
    """SELECT 'kept' AS part, collection_attempt_id, run_collection_metadata_id FROM link_attempts_to_runs
       WHERE collection_attempt_id NOT IN (SELECT id FROM collection_attempts WHERE attempt_status_id = 2)
       UNION ALL SELECT 'gone', collection_attempt_id, run_collection_metadata_id FROM link_attempts_to_runs
       WHERE collection_attempt_id IN (SELECT id FROM collection_attempts WHERE attempt_status_id = 2)""",
)
def _(v):
    failed = v.collection_attempts().filter("attempt_status_id = 2")
    kept, gone = integrity.cascade(v.link_attempts_to_runs(), "collection_attempt_id", failed)
    return kept.withColumn("part", F.lit("kept")).unionByName(gone.withColumn("part", F.lit("gone")))


@query(
    "c14_set_null",
    """SELECT id, CASE WHEN collection_attempt_id IN (SELECT id FROM collection_attempts WHERE attempt_status_id = 2) THEN NULL
                       ELSE collection_attempt_id END AS collection_attempt_id FROM raw_data""",
)
def _(v):
    failed = v.collection_attempts().filter("attempt_status_id = 2")
    return integrity.set_null(v.raw_data(), "collection_attempt_id", failed).select("id", "collection_attempt_id")


@query(
    "c15_duplicate_keys",
    """SELECT collector_name_id, collection_type_id, language_code, collection_name, count(*) AS row_count FROM collection_targets
       GROUP BY ALL HAVING count(*) > 1""",
)
def _(v):
    return integrity.duplicate_keys(v.collection_targets(), integrity.UNIQUE_KEYS["collection_targets"])


@query(
    "e1_latest_attempt",
    """SELECT id, collection_target_id, search_term_used, created_at FROM
       (SELECT *, row_number() OVER (PARTITION BY collection_target_id ORDER BY created_at DESC, id DESC) AS rn FROM collection_attempts) WHERE rn = 1""",
)
def _(v):
    return ordering.latest_per_key(v.collection_attempts(), ["collection_target_id"]).select("id", "collection_target_id", "search_term_used", "created_at")


@query(
    "e2_first_target_per_language",
    f"""SELECT {TARGETS} FROM (SELECT *, row_number() OVER (PARTITION BY language_code ORDER BY created_at, id) AS rn
        FROM collection_targets WHERE collector_name_id = 1 AND collection_status_id = 1) WHERE rn = 1""",
)
def _(v):
    return _targets(selectors.unique_languages(v.collection_targets(), 1, 1))


@query("e6_newest_first", f"SELECT {TARGETS} FROM collection_targets ORDER BY created_at DESC, id DESC LIMIT 200")
def _(v):
    return _targets(ordering.newest_first(v.collection_targets(), 200))


@query("e6_newest_first_all", "SELECT id, created_at FROM collection_attempts")
def _(v):
    return ordering.newest_first(v.collection_attempts(), 0).select("id", "created_at")


@query("e7_fixed_sample", "SELECT id, title FROM raw_data ORDER BY md5(id::VARCHAR), id LIMIT 100")
def _(v):
    return ordering.sample_by_hash(v.raw_data(), F.col("id"), 100).select("id", "title")


@query("e8_distinct", "SELECT DISTINCT collection_target_id, attempt_status_id, error_type_id FROM collection_attempts")
def _(v):
    return v.collection_attempts().select("collection_target_id", "attempt_status_id", "error_type_id").distinct()


@query(
    "e9_concatenated_selections",
    f"""SELECT {TARGETS} FROM collection_targets WHERE collection_type_id = 1 AND language_code = 'NATION_5'
        UNION ALL SELECT {TARGETS} FROM collection_targets WHERE collection_type_id = 2 AND language_code = 'NATION_5'""",
)
def _(v):
    return _targets(selectors.select_targets(v.collection_targets(), type_ids=[1, 2], languages=["NATION_5"]))
