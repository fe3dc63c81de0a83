"""Registry of queries, and the model views as SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheafline.sources.model_views import COLLECTORS, LANGUAGES, RUN_STATUSES, TARGET_TYPES, ModelViews
from sheafline.vocab import ATTEMPT_STATUSES, COLLECTION_STATUSES, ERROR_TYPES, STATE_VOTES, VALIDATION_STATUSES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _lookup(names: list[str]) -> str:
    rows = ", ".join(f"({i}::BIGINT, '{n}')" for i, n in enumerate(names, start=1))
    return f"SELECT * FROM (VALUES {rows}) AS v(id, name)"


def _case(column: str, names: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {column} = '{n}' THEN {i}" for i, n in enumerate(names, start=1)) + " END::BIGINT"


_LANG = f"['{LANGUAGES[0]}', '{LANGUAGES[1]}', '{LANGUAGES[2]}', '{LANGUAGES[3]}'][(user_id % 4 + 1)::INT]"
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

VIEWS = {
    "validation_statuses": _lookup(VALIDATION_STATUSES),
    "attempt_statuses": _lookup(ATTEMPT_STATUSES),
    "collection_statuses": _lookup(COLLECTION_STATUSES),
    "error_types": _lookup(ERROR_TYPES),
    "collection_types": _lookup(TARGET_TYPES),
    "collector_names": _lookup(COLLECTORS),
    "run_types": _lookup(TARGET_TYPES),
    "run_statuses": _lookup(RUN_STATUSES),
    "raw_data": """
        SELECT d.doc_id AS id, d.doc_id AS collection_attempt_id,
               (CASE WHEN d.n_chars > 1000 THEN 2 ELSE 1 END)::BIGINT AS raw_data_metadata_schema_id,
               split_part(d.text, chr(10), 1) AS title, d.lang AS language_code,
               'https://example.com/' || d.source || '/' || d.doc_id AS url,
               json_object('content', d.text, 'source', d.source, 'n_chars', d.n_chars, 'language', d.lang)::VARCHAR AS metadata,
               (CASE WHEN l.quality = 1 THEN 1 WHEN l.quality = 0 THEN 2 ELSE 3 END)::BIGINT AS validation_status_id,
               NULL::VARCHAR AS validation_error, 'store/' || d.source || '.json' AS filepath_of_save,
               TIMESTAMP '2024-01-01 00:00:00' + d.doc_id * INTERVAL 1 MINUTE AS created_at,
               d.text AS body, d.n_chars AS n_chars
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "cleaned_data": """
        SELECT id, id AS raw_data_id, raw_data_metadata_schema_id AS cleaned_data_metadata_schema_id, title, language_code,
               url, metadata, validation_status_id, validation_error,
               CASE WHEN language_code = 'fr' THEN 'poll_cleaner' WHEN language_code = 'en' THEN 'article_cleaner' ELSE 'table_cleaner' END AS cleaner_used,
               CASE WHEN n_chars > 1000 THEN '2.0.0' ELSE '1.0.0' END AS cleaner_version,
               n_chars % 97 AS cleaning_time_ms, created_at AS cleaned_at, created_at
        FROM raw_data WHERE validation_status_id <> 3""",
    "collection_targets": f"""
        SELECT o_orderkey AS id, {_case('c_mktsegment', COLLECTORS)} AS collector_name_id,
               {_case('o_orderpriority', TARGET_TYPES)} AS collection_type_id, n_name AS language_code, c_name AS collection_name,
               (CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)::BIGINT AS collection_status_id,
               o_orderdate AS updated_at, o_orderdate AS created_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "collection_attempts": f"""
        SELECT event_id AS id, user_id AS collection_target_id, {_LANG} AS language_code,
               event_type || ' ' || {_K} AS search_term_used,
               (CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 3 ELSE 1 END)::BIGINT AS attempt_status_id,
               CASE WHEN event_type = 'error' THEN {_K} % 11 + 1 END AS error_type_id,
               CASE WHEN event_type = 'error' THEN props END AS error_message, ts AS created_at
        FROM events""",
    "check_collection_targets": f"""
        SELECT event_id AS id, user_id AS collection_target_id, event_type || ' ' || {_K} AS search_term_used,
               {_LANG} AS language_code,
               CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' ELSE 'failed_with_suggestions' END AS test_status,
               '[]' AS search_results_found, CASE WHEN event_type = 'purchase' THEN '' ELSE props END AS error_message,
               floor(value)::BIGINT AS test_duration, ts AS created_at
        FROM events""",
    "run_collection_metadata": f"""
        SELECT o_orderkey AS id, NULL::BIGINT AS collection_attempt_id, {_case('o_orderpriority', TARGET_TYPES)} AS run_type_id,
               (CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 3 END)::BIGINT AS run_status_id,
               attempts_successful, attempts_failed, NULL::VARCHAR AS config_used,
               CASE WHEN o_orderstatus <> 'P' THEN shipped END AS completed_at, o_orderdate AS created_at
        FROM orders JOIN (
            SELECT l_orderkey, count(*) FILTER (WHERE l_linestatus = 'F') AS attempts_successful,
                   count(*) FILTER (WHERE l_linestatus = 'O') AS attempts_failed, max(l_shipdate) AS shipped
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "link_attempts_to_runs": """
        SELECT DISTINCT l_partkey AS collection_attempt_id, l_orderkey AS run_collection_metadata_id FROM lineitem""",
    "polls": """
        SELECT l_orderkey * 8 + l_linenumber AS poll_id, year(l_shipdate)::INT AS cycle, n_name AS cleaned_state,
               l_returnflag AS cleaned_candidate_name, l_quantity AS pct_estimate,
               l_quantity + 100.0::DOUBLE * (l_discount - 0.05::DOUBLE) AS pct_trend_adjusted,
               l_shipdate::DATE AS model_date, abs(l_tax) AS sum_influence
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "raw_polls": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_no,
               CASE l_linenumber WHEN 6 THEN NULL WHEN 5 THEN year(l_shipdate) || '.0' ELSE year(l_shipdate)::VARCHAR END AS cycle,
               ' ' || replace(n_name, '_', ' ') || chr(9) AS state,
               CASE l_returnflag WHEN 'A' THEN 'Donald  J. Trump ' WHEN 'N' THEN ' Hillary Rodham Clinton' ELSE 'Bernie Sanders' END AS candidate_name,
               CASE l_linenumber WHEN 1 THEN '-' || l_quantity::INT WHEN 2 THEN (l_quantity::INT + 100)::VARCHAR WHEN 3 THEN 'n/a'
                    ELSE l_quantity::INT || '.1234567' END AS pct_estimate,
               CASE WHEN l_linenumber <> 4 THEN (l_quantity::INT * 2)::VARCHAR END AS pct_trend_adjusted,
               CASE WHEN l_linenumber <= 3 THEN month(l_shipdate) || '/' || day(l_shipdate) || '/' || year(l_shipdate)
                    WHEN l_linenumber = 4 THEN strftime(l_shipdate, '%Y-%m-%d') || 'T00:00:00'
                    WHEN l_linenumber = 5 THEN '13-2020' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS modeldate,
               '11/3/2020' AS election_date,
               CASE WHEN l_linestatus = 'F' THEN trunc(abs(l_tax) * 100)::INT::VARCHAR END AS sum_influence
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "documents_noised": """
        SELECT doc_id, lang, source,
               CASE doc_id % 5
                    WHEN 0 THEN '  ' || text || '[12] end[3]'
                    WHEN 1 THEN chr(8220) || text || chr(8221) || ' it' || chr(8217) || 's ' || chr(8216) || 'so' || chr(8217)
                    WHEN 2 THEN text || ' ' || chr(8212) || ' a' || chr(8211) || 'b'
                    WHEN 3 THEN text || chr(10) || chr(10) || chr(10) || chr(10) || 'last' || chr(10) || ' ' || chr(10) || chr(10) || 'line' || chr(10)
                    ELSE text || '  two' || chr(9) || chr(9) || 'gaps [citation needed] x[clarification needed] ' END
               || CASE WHEN doc_id % 50 = 7 THEN 'Ã©' ELSE '' END AS content
        FROM documents""",
    "page_catalogue": """
        SELECT page_id, url, {title} AS title, regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS language_code FROM pages""",
    "state_votes": "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v}::BIGINT)" for k, v in STATE_VOTES.items()) + ") AS v(cleaned_state, votes)",
}

# White space of any kind, as the characters to trim and as a class to split at.
_SPACES = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SPACE_CHARS = " || ".join(f"chr({c})" for c in _SPACES)
SPACE_CLASS = "".join(f"\\x{{{c:x}}}" for c in _SPACES)


def strip_sql(x: str) -> str:
    return f"trim({x}, {SPACE_CHARS})"


def unescape_sql(x: str) -> str:
    for entity, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&amp;", "'&'")):
        x = f"replace({x}, '{entity}', {char})"
    return x


def plain_sql(x: str) -> str:
    return strip_sql(unescape_sql(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


VIEWS["page_catalogue"] = VIEWS["page_catalogue"].replace(
    "{title}", plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
)


def clean_text_sql(x: str) -> str:
    x = f"regexp_replace({x}, '\\[[0-9]+\\]|\\[citation needed\\]|\\[clarification needed\\]', '', 'g')"
    for code, char in ((8220, "chr(34)"), (8221, "chr(34)"), (8216, "chr(39)"), (8217, "chr(39)"), (8211, "'-'"), (8212, "'-'")):
        x = f"replace({x}, chr({code}), {char})"
    x = f"regexp_replace({x}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    x = f"regexp_replace({x}, '[ \\t]+', ' ', 'g')"
    return f"coalesce({strip_sql(x)}, '')"


def clean_title_sql(x: str) -> str:
    x = f"regexp_replace({x}, '\\[[0-9]+\\]|\\[citation needed\\]|\\[clarification needed\\]', '', 'g')"
    return f"coalesce({strip_sql(f'regexp_replace({x}, ' + chr(39) + '[ \\t]+' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}, '')"


def words_sql(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{SPACE_CLASS}]+'))"


def with_views(body: str) -> str:
    """Put the model views a statement uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(body)
    ctes = [f"{name} AS ({VIEWS[name]})" for name in needed]
    body = body.strip()
    if body.upper().startswith("WITH "):
        ctes.append(body[5:])
        return "WITH " + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def query(name: str, sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``name`` with its SQL."""

    def wrap(fn: Callable[[ModelViews], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: fn(ModelViews(spark, folder))
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return wrap
