"""Sources, text and poll functions, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheafline.functions import arrays, jsonio, polls, text
from sheafline.operators import json_schema, validation
from sheafline.operators.lookups import same_schema
from sheafline.plans import cleaners
from sheafline.plans.clean_job import POLL_SCHEMA
from sheafline.schemas import CORRUPT, POLL_CSV_LAYOUTS, POLL_MODEL_COLUMNS
from sheafline.session import shared_dir
from sheafline.sources import pages, poll_files, tables
from sheafline.vocab import MOJIBAKE_PATTERNS

from .base import SPACE_CLASS, clean_text_sql, clean_title_sql, plain_sql, query, strip_sql, unescape_sql, words_sql
from .selection import SCHEMAS_SQL, _schemas

COLLECTED_AT = "2024-02-01T00:00:00"
YEAR = 2024

# Sources and sinks


@query(
    "a1_poll_csv",
    """SELECT cleaned_candidate_name AS candidate, strftime(model_date, '%-m/%-d/%Y') AS date, pct_trend_adjusted, cleaned_state AS state, cycle,
              NULL::VARCHAR AS party, pct_estimate, NULL::DOUBLE AS hi, NULL::DOUBLE AS lo FROM polls""",
)
def _(v):
    day = F.col("model_date")
    rows = v.polls().select(
        F.col("cleaned_candidate_name").alias("candidate"),
        F.concat_ws("/", F.month(day), F.dayofmonth(day), F.year(day)).alias("date"),
        "pct_trend_adjusted",
        F.col("cleaned_state").alias("state"),
        "cycle",
        F.lit(None).cast("string").alias("party"),
        "pct_estimate",
        F.lit(None).cast("double").alias("hi"),
        F.lit(None).cast("double").alias("lo"),
    )
    path = shared_dir(v.spark, "poll-csv")
    rows.write.option("header", True).csv(path)
    return poll_files.read_poll_csv(v.spark, path, "2020-2024").drop("_corrupt_record")


_OLD_FIRST, _OLD_LAST = POLL_MODEL_COLUMNS[0], POLL_MODEL_COLUMNS[-1]
_BROKEN = "2016,Ohio,2016-11-01,A,1,not a number,40.5"


@query(
    "a1_poll_csv_old",
    f"""SELECT cycle, cleaned_state AS state, strftime(model_date, '%Y-%m-%d') AS modeldate, cleaned_candidate_name AS candidate_name, 1::BIGINT AS candidate_id,
               pct_estimate, pct_trend_adjusted, pct_estimate * 2 AS first_model_value, sum_influence AS last_model_value, NULL::VARCHAR AS broken FROM polls
        UNION ALL SELECT 2016, 'Ohio', '2016-11-01', 'A', 1, NULL, 40.5, NULL, NULL, '{_BROKEN}'""",
)
def _(v):
    """The older layout with its model-internal columns, in two files; one has a broken line."""
    names = [f.name for f in POLL_CSV_LAYOUTS["1968-2016"].fields if f.name != CORRUPT]
    polls = v.polls()
    known = {
        "cycle": F.col("cycle"), "state": F.col("cleaned_state"), "modeldate": F.date_format("model_date", "yyyy-MM-dd"),
        "candidate_name": F.col("cleaned_candidate_name"), "candidate_id": F.lit(1), "pct_estimate": F.col("pct_estimate"),
        "pct_trend_adjusted": F.col("pct_trend_adjusted"), _OLD_FIRST: F.col("pct_estimate") * 2, _OLD_LAST: F.col("sum_influence"),
    }
    path = shared_dir(v.spark, "old-poll-csv")
    polls.select(*[known.get(n, F.lit(None).cast("string")).alias(n) for n in names]).write.option("header", True).csv(path)
    v.spark.range(1).select(F.lit(",".join(names) + "\n" + _BROKEN)).write.mode("append").text(path)
    rows = poll_files.read_poll_csv(v.spark, path, "1968-2016")
    return rows.select(*names[:4], *names[4:7], F.col(_OLD_FIRST).alias("first_model_value"), F.col(_OLD_LAST).alias("last_model_value"), F.col(CORRUPT).alias("broken"))


@query("a2_full_table", "SELECT * FROM orders")
def _(v):
    return tables.read_table(v.spark, f"{v.folder}/orders.parquet")


@query(
    "a3_decode_json",
    f"""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
               CASE WHEN event_type = 'error' THEN '{{}}' ELSE replace(props, ' ', '') END AS document FROM events""",
)
def _(v):
    broken = F.when(F.col("event_type") == "error", F.substring("props", 1, 3)).otherwise(F.col("props"))
    decoded = v.table("events").select("event_id", jsonio.decode(broken).alias("v"))
    return decoded.select("event_id", F.try_variant_get("v", "$.k", "bigint").alias("k"), F.to_json("v").alias("document"))


@query("a4_write_records", "SELECT doc_id, lang, source, content FROM documents_noised")
def _(v):
    base = shared_dir(v.spark, "records")
    folder = tables.write_records(v.documents_noised(), "article_data", base, "20240201_000000", "json")
    return v.spark.read.schema("doc_id BIGINT, lang STRING, source STRING, content STRING").json(folder)


_VISIBLE = r"regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g')"
_TITLE_SQL = plain_sql("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
_ARTICLE_SQL = rf"regexp_extract({_VISIBLE}, '(?is)<article\b[^>]*>(.*)</article>', 1)"
_BODY_SQL = rf"regexp_extract({_VISIBLE}, '(?is)<body\b[^>]*>(.*)</body>', 1)"
_CHOSEN = f"CASE WHEN {_ARTICLE_SQL} <> '' THEN {_ARTICLE_SQL} ELSE {_BODY_SQL} END"
_LINES = rf"regexp_replace(regexp_replace({_CHOSEN}, '(?i)</(?:p|div|h[1-6]|li|tr|section|article)>|<br\s*/?>', chr(10), 'g'), '<[^>]*>', '', 'g')"
_CONTENT_SQL = strip_sql(rf"regexp_replace({unescape_sql(_LINES)}, '\n{{2,}}', chr(10), 'g')")
_RECORDS_SQL = f"""records AS (
    SELECT page_id, {_TITLE_SQL} AS title, {plain_sql(f"regexp_extract({_VISIBLE}, '(?is)<p" + chr(92) + "b[^>]*>(.*?)</p>', 1)")} AS summary,
           {_CONTENT_SQL} AS content, url,
           list_transform(regexp_extract_all({_VISIBLE}, '(?is)<li\\b[^>]*>\\s*<a\\b[^>]*>(.*?)</a>\\s*</li>', 1), lambda x: {plain_sql('x')}) AS categories,
           regexp_extract_all({_VISIBLE}, '(?i)<a\\b[^>]*\\bhref="([^"]*)"', 1) AS links,
           regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS language
    FROM pages)"""


def _records(v):
    return pages.article_records(v.pages(), COLLECTED_AT)


@query(
    "a6_article_records",
    f"""WITH {_RECORDS_SQL} SELECT page_id, title, summary, content, url, array_to_string(categories, ' | ') AS categories,
        array_to_string(links, ' | ') AS links, '{COLLECTED_AT}' AS collected_at, 'wikipedia_' || language AS source, language, title AS original_search_title FROM records""",
)
def _(v):
    return _records(v).withColumns({c: F.array_join(c, " | ") for c in ("categories", "links")})


_POLL_ROWS = """SELECT order_id, line_no, cycle, state, candidate_name AS candidate, modeldate AS date, pct_estimate, pct_trend_adjusted,
    order_id * 8 + line_no AS original_row_index FROM raw_polls"""


def _poll_rows(v):
    return v.raw_polls().select(
        "order_id", "line_no", "cycle", "state", F.col("candidate_name").alias("candidate"), F.col("modeldate").alias("date"),
        "pct_estimate", "pct_trend_adjusted", (F.col("order_id") * 8 + F.col("line_no")).alias("original_row_index"),
    )


_POLL_RECORDS = f"""SELECT order_id, line_no, cycle, state, candidate AS candidate_name, date AS modeldate, NULL::VARCHAR AS election_date,
    'en' AS language, '{COLLECTED_AT}' AS collected_at, 'fivethirtyeight_csv' AS collection_source,
    replace(candidate, ' ', '_') || ' - ' || replace(state, ' ', '_') || ' - ' || coalesce(cycle, 'Unknown') AS title,
    'Polling data for ' || replace(candidate, ' ', '_') || ' in ' || replace(state, ' ', '_') || ' (' || coalesce(cycle, 'Unknown') || '): ' || pct_estimate || '% estimate' AS content,
    original_row_index, pct_estimate, pct_trend_adjusted FROM ({_POLL_ROWS})"""


@query("a7_poll_records", _POLL_RECORDS)
def _(v):
    return poll_files.poll_records(_poll_rows(v), COLLECTED_AT).drop("candidate", "date")


@query(
    "a8_stored_article_fields",
    f"WITH {_RECORDS_SQL} SELECT title, content, url, language, page_id, {words_sql('content')} AS word_count, '{COLLECTED_AT}' AS collected_at FROM records",
)
def _(v):
    return pages.stored_article_fields(_records(v))


@query(
    "a9_stored_poll_fields",
    f"""SELECT cycle, state, modeldate, candidate_name, pct_estimate, pct_trend_adjusted, election_date, language, collected_at,
               collection_source, original_row_index FROM ({_POLL_RECORDS})""",
)
def _(v):
    return poll_files.stored_poll_fields(poll_files.poll_records(_poll_rows(v), COLLECTED_AT))


@query(
    "a10_target_names",
    f"""SELECT order_id, line_no, coalesce(cycle, 'unknown') || '_' || replace(state, ' ', '_') || '_' || replace(candidate, ' ', '_') || '_' || (original_row_index + 2) AS collection_name
        FROM ({_POLL_ROWS})""",
)
def _(v):
    return poll_files.target_names(_poll_rows(v)).select("order_id", "line_no", "collection_name")


@query(
    "a11_import_targets",
    f"""SELECT 1::BIGINT AS collector_name_id, 2::BIGINT AS collection_type_id, 'en' AS language_code,
               coalesce(cycle, 'unknown') || '_' || replace(state, ' ', '_') || '_' || replace(candidate, ' ', '_') || '_' || (original_row_index + 2) AS collection_name,
               1::BIGINT AS collection_status_id FROM ({_POLL_ROWS})""",
)
def _(v):
    return poll_files.import_targets(_poll_rows(v), 1, 2, 1)


# Text functions


@query("f1_clean_text", f"SELECT doc_id, {clean_text_sql('content')} AS cleaned_content FROM documents_noised")
def _(v):
    return v.documents_noised().select("doc_id", text.clean_text(F.col("content")).alias("cleaned_content"))


@query("f2_clean_title", f"SELECT doc_id, {clean_title_sql('content')} AS cleaned_title FROM documents_noised")
def _(v):
    return v.documents_noised().select("doc_id", text.clean_title(F.col("content")).alias("cleaned_title"))


@query(
    "f3_clean_arrays",
    f"""WITH parts AS (
            SELECT page_id, x.place, regexp_replace({strip_sql('x.part')}, '[ \\t]+', ' ', 'g') AS part FROM (
                SELECT page_id, unnest(string_split(html, '><')) AS part, generate_subscripts(string_split(html, '><'), 1) AS place FROM pages) x),
        firsts AS (SELECT page_id, part, min(place) AS place FROM parts WHERE part <> '' GROUP BY page_id, part)
        SELECT page_id, count(*) AS part_count, array_to_string(list(part ORDER BY place), '|') AS parts FROM firsts GROUP BY page_id""",
)
def _(v):
    parts = arrays.clean_string_array(F.split("html", "><"))
    cleaned = v.pages().select("page_id", parts.alias("parts"))
    return cleaned.select("page_id", F.size("parts").cast("bigint").alias("part_count"), F.array_join("parts", "|").alias("parts"))


@query(
    "f4_counts",
    f"SELECT doc_id, {words_sql('content')} AS word_count, length(content) AS char_count FROM documents_noised",
)
def _(v):
    return v.documents_noised().select("doc_id", text.word_count(F.col("content")).alias("word_count"), text.char_count(F.col("content")).alias("char_count"))


def _article_raw(v):
    """Raw rows of noised articles, every fourth language with other keys left out."""
    content = F.col("content")
    links = F.array(F.lit("a  link "), F.lit("a link"), F.lit("  "), F.concat(F.lit(" https://x.org/"), F.col("source")))
    categories = F.array(F.lit(" a  b"), F.lit("a b"), F.col("source"))
    full = F.to_json(F.struct(content, content.alias("title"), categories.alias("categories"), links.alias("links")))
    bare = F.to_json(F.struct(content.alias("summary")))
    document = F.when(F.col("lang") == "es", bare).when(F.col("lang") == "de", "{}").otherwise(full)
    return v.documents_noised().select(F.col("doc_id").alias("id"), "lang", document.alias("metadata"))


_FULL = "lang IN ('en', 'fr')"


@query(
    "f5_article_transform",
    f"""SELECT doc_id AS id, CASE WHEN {_FULL} THEN {clean_text_sql('content')} END AS cleaned_content,
               CASE WHEN {_FULL} THEN {words_sql(clean_text_sql('content'))} END AS content_word_count,
               CASE WHEN {_FULL} THEN length({clean_text_sql('content')}) END AS content_char_count,
               CASE WHEN lang = 'es' THEN {clean_text_sql('content')} END AS cleaned_summary,
               CASE WHEN lang = 'es' THEN {words_sql(clean_text_sql('content'))} END AS summary_word_count,
               CASE WHEN {_FULL} THEN {clean_title_sql('content')} END AS cleaned_title,
               CASE WHEN {_FULL} THEN 'a b|' || source END AS cleaned_categories,
               CASE WHEN {_FULL} THEN 2 END::BIGINT AS category_count,
               CASE WHEN {_FULL} THEN 'a link|https://x.org/' || source END AS cleaned_links,
               CASE WHEN {_FULL} THEN 2 END::BIGINT AS internal_link_count,
               CASE WHEN {_FULL} THEN length(content) ELSE 0 END AS original_content_length
        FROM documents_noised""",
)
def _(v):
    cleaned = cleaners.article_struct(_article_raw(v), COLLECTED_AT).select("id", "cleaned.*")
    joined = {c: F.array_join(c, "|") for c in ("cleaned_categories", "cleaned_links")}
    return cleaned.withColumns(joined).drop("cleaned_at", "cleaning_operations_applied")


@query("f6_state_name", f"SELECT order_id, line_no, replace({strip_sql('state')}, ' ', '_') AS cleaned_state FROM raw_polls")
def _(v):
    return v.raw_polls().select("order_id", "line_no", polls.state_name(F.col("state")).alias("cleaned_state"))


_CANDIDATE = f"regexp_replace({strip_sql('candidate_name')}, '[{SPACE_CLASS}]+', ' ', 'g')"
_CANDIDATE = f"CASE {_CANDIDATE} WHEN 'Hillary Rodham Clinton' THEN 'Hillary Clinton' WHEN 'Donald J. Trump' THEN 'Donald Trump' WHEN 'Bernard Sanders' THEN 'Bernie Sanders' ELSE {_CANDIDATE} END"


@query("f7_candidate_name", f"SELECT order_id, line_no, {_CANDIDATE} AS cleaned_candidate_name FROM raw_polls")
def _(v):
    return v.raw_polls().select("order_id", "line_no", polls.candidate_name(F.col("candidate_name")).alias("cleaned_candidate_name"))


_DAY = "split_part(modeldate, 'T', 1)"
_ISO_DAY = f"""CASE WHEN regexp_matches({_DAY}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') THEN {_DAY}
    WHEN regexp_matches({_DAY}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$')
    THEN split_part({_DAY}, '/', 3) || '-' || lpad(split_part({_DAY}, '/', 1), 2, '0') || '-' || lpad(split_part({_DAY}, '/', 2), 2, '0') END"""


@query("f8_iso_dates", f"SELECT order_id, line_no, d AS iso_text, try_cast(d AS DATE) AS iso_date FROM (SELECT *, {_ISO_DAY} AS d FROM raw_polls)")
def _(v):
    dates = v.raw_polls().select("order_id", "line_no", polls.iso_date_text(F.col("modeldate")).alias("iso_text"))
    return dates.withColumn("iso_date", polls.as_date(F.col("iso_text")))


@query("f9_days_between", f"SELECT order_id, line_no, date_diff('day', try_cast(d AS DATE), DATE '2020-11-03') AS days FROM (SELECT *, {_ISO_DAY} AS d FROM raw_polls)")
def _(v):
    first, last = polls.iso_date_text(F.col("modeldate")), polls.iso_date_text(F.col("election_date"))
    return v.raw_polls().select("order_id", "line_no", polls.days_between(first, last).alias("days"))


_PCT = "round(CASE WHEN try_cast({0} AS DOUBLE) < 0 THEN 0.0 WHEN try_cast({0} AS DOUBLE) > 100 THEN 100.0 ELSE try_cast({0} AS DOUBLE) END, 6)"


@query("f10_percentage", f"SELECT order_id, line_no, {_PCT.format('pct_estimate')} AS pct_estimate FROM raw_polls")
def _(v):
    return v.raw_polls().select("order_id", "line_no", polls.percentage(F.col("pct_estimate")).alias("pct_estimate"))


@query(
    "f11_lenient_numbers",
    "SELECT order_id, line_no, trunc(try_cast(cycle AS DOUBLE))::BIGINT AS cycle, trunc(try_cast(pct_estimate AS DOUBLE))::BIGINT AS whole, try_cast(sum_influence AS DOUBLE) AS sum_influence FROM raw_polls",
)
def _(v):
    return v.raw_polls().select(
        "order_id", "line_no", polls.lenient_int(F.col("cycle")).alias("cycle"),
        polls.lenient_int(F.col("pct_estimate")).alias("whole"), polls.lenient_float(F.col("sum_influence")).alias("sum_influence"),
    )


_TRANSFORM = f"""SELECT order_id, line_no, trunc(try_cast(cycle AS DOUBLE))::BIGINT AS cycle, replace({strip_sql('state')}, ' ', '_') AS cleaned_state,
    {_CANDIDATE} AS cleaned_candidate_name, {_PCT.format('pct_estimate')} AS pct_estimate, {_PCT.format('pct_trend_adjusted')} AS pct_trend_adjusted,
    {_ISO_DAY} AS model_date, try_cast(sum_influence AS DOUBLE) AS sum_influence FROM raw_polls"""
_SCORED = f"""SELECT *, CASE WHEN cycle <> 0 AND cycle <= 2016 THEN '1968-2016' ELSE '2020-2024' END AS dataset_type, NULL::VARCHAR AS collection_source,
    round(((CASE WHEN cycle <> 0 THEN 1.0::DOUBLE ELSE 0 END) + 2.0 + (CASE WHEN model_date IS NOT NULL THEN 0.7::DOUBLE ELSE 0 END)
      + (CASE WHEN pct_estimate IS NOT NULL OR pct_trend_adjusted IS NOT NULL THEN 0.8::DOUBLE ELSE 0 END)) / 4.5::DOUBLE, 6) AS data_quality_score,
    (coalesce(pct_estimate < 1.0 OR pct_estimate > 90.0, false) OR coalesce(pct_trend_adjusted < 1.0 OR pct_trend_adjusted > 90.0, false)
      OR coalesce(cycle < 1968 OR cycle > {YEAR} + 4, false)) AS is_outlier FROM ({_TRANSFORM})"""


def _poll_columns(v, version="2.0.0"):
    return cleaners.poll_columns(v.raw_polls(), version, YEAR).withColumn("data_quality_score", F.round("data_quality_score", 6))


@query("f12_quality_score", f"SELECT order_id, line_no, data_quality_score FROM ({_SCORED})")
def _(v):
    return _poll_columns(v).select("order_id", "line_no", "data_quality_score")


@query("f13_outliers", f"SELECT order_id, line_no, is_outlier FROM ({_SCORED})")
def _(v):
    return _poll_columns(v).select("order_id", "line_no", "is_outlier")


@query("f14_dataset_type", f"SELECT order_id, line_no, dataset_type FROM ({_SCORED})")
def _(v):
    return _poll_columns(v).select("order_id", "line_no", "dataset_type")


@query("f15_poll_transform", _SCORED)
def _(v):
    return _poll_columns(v)


@query(
    "f15_poll_transform_v1",
    f"""SELECT * EXCLUDE (model_date, is_outlier), model_date AS modeldate, '2020-11-03' AS election_date,
        date_diff('day', try_cast(model_date AS DATE), DATE '2020-11-03') AS days_before_election,
        is_outlier OR coalesce(date_diff('day', try_cast(model_date AS DATE), DATE '2020-11-03') NOT BETWEEN 0 AND 1460, false) AS is_outlier FROM ({_SCORED})""",
)
def _(v):
    return _poll_columns(v, "1.0.0")


@query("f16_time_weight", "SELECT poll_id, pct_estimate, round(exp(-0.05::DOUBLE * date_diff('day', model_date, DATE '2001-12-31') / 30), 6) AS time_weight FROM polls")
def _(v):
    days = F.datediff(F.lit("2001-12-31").cast("date"), F.col("model_date"))
    return v.polls().select("poll_id", "pct_estimate", F.round(polls.time_weight(days, 0.05), 6).alias("time_weight"))


@query(
    "f18_normalised_values",
    """SELECT event_id, CASE WHEN event_type <> 'click' THEN value END AS value,
              strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('us', ts) % 1000000 = 0 THEN '' ELSE '.' || lpad((date_part('us', ts) % 1000000)::VARCHAR, 6, '0') END AS iso_ts FROM events""",
)
def _(v):
    with_nan = F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("value"))
    return v.table("events").select("event_id", jsonio.normalise_number(with_nan).alias("value"), jsonio.iso_instant(F.col("ts")).alias("iso_ts"))


@query(
    "f19_json_text",
    "SELECT id, json_extract_string(metadata, '$.source') AS source, json_extract_string(metadata, '$.nothing') AS nothing, length(json_extract_string(metadata, '$.content')) AS content_length FROM raw_data",
)
def _(v):
    field = lambda name: jsonio.field_text(F.col("metadata"), name)
    return v.raw_data().select("id", field("source").alias("source"), field("nothing").alias("nothing"), F.length(field("content")).cast("bigint").alias("content_length"))


@query(
    "f20_collector_label",
    "SELECT event_id, upper(event_type[1]) || lower(event_type[2:]) AS label FROM events",
)
def _(v):
    return v.table("events").select("event_id", text.collector_label(F.concat("event_type", F.lit("_collector_v1"))).alias("label"))


@query(
    "f21_canonical_json",
    "SELECT e.event_id, '{\"a\":\"' || event_type || '\",\"k\":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}' AS document FROM events e",
)
def _(v):
    built = F.format_string('{ "k": %s,  "a":"%s" }', F.get_json_object("props", "$.k"), "event_type")
    return v.table("events").select("event_id", jsonio.canonical(built).alias("document"))


@query(
    "f21_same_schema",
    f"""WITH {SCHEMAS_SQL} SELECT s.id FROM stored_schemas s JOIN (SELECT source, min(doc_id) AS first FROM documents GROUP BY source) d
        ON json_extract_string(s.metadata_schema, '$.cleaner_name') = d.source WHERE d.first % 2 = 0""",
)
def _(v):
    """Every second document asked for differs from the stored one by one number."""
    reordered = F.format_string(
        '{"schema":{"properties":{"%s_title":{"maxLength":%d}},"type":"object"},  "current_schema_version":"1.%d.0","cleaner_name":"%s"}',
        "source", F.col("longest") + F.col("first") % 2, F.col("first") % 3, "source",
    )
    documents = v.table("documents").groupBy("source").agg(F.min("doc_id").alias("first"), F.max("n_chars").alias("longest"))
    return same_schema(_schemas(v), documents.select(reordered.alias("document"))).select("id")


@query(
    "e10_distinct_in_order",
    """SELECT doc_id, array_to_string(list(w ORDER BY place), ' ') AS words FROM (
           SELECT doc_id, w, min(place) AS place FROM (
               SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS place FROM documents) GROUP BY doc_id, w)
       GROUP BY doc_id""",
)
def _(v):
    return v.table("documents").select("doc_id", F.array_join(arrays.distinct_in_order(F.split("text", " ")), " ").alias("words"))


@query(
    "e11_missing_fields",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'k,title,url' WHEN event_type = 'click' THEN 'title,url' ELSE 'title' END AS missing FROM events""",
)
def _(v):
    document = (
        F.when(F.col("event_type") == "error", "not json").when(F.col("event_type") == "click", F.col("props"))
        .otherwise(F.concat(F.rtrim("props", F.lit("}")), F.lit(', "url": null}')))
    )
    missing = arrays.missing_entries(["url", "title", "k"], jsonio.keys(document))
    return v.table("events").select("event_id", F.array_join(missing, ",").alias("missing"))


# Validation

_MOJIBAKE = " OR ".join(f"contains(content, '{p}')" for p in MOJIBAKE_PATTERNS)


def _checked_records(v):
    """Noised documents as records with missing, empty, short and malformed fields."""
    lang = F.col("lang")
    return v.documents_noised().select(
        "doc_id",
        F.when(lang != "de", F.col("source")).alias("title"),
        "content",
        F.when(lang == "fr", "fra").otherwise(lang).alias("language"),
        F.when(lang == "es", "ftp://x").otherwise(F.concat(F.lit("https://example.com/"), "source")).alias("url"),
        F.when(lang == "fr", "").otherwise(COLLECTED_AT).alias("collected_at"),
    )


@query(
    "v1_record_errors",
    f"""SELECT doc_id, concat_ws(' / ', CASE WHEN lang = 'de' THEN 'Missing required fields: title' END,
            CASE WHEN lang = 'fr' THEN 'Field ''collected_at'' is empty' END,
            CASE WHEN length({strip_sql('content')}) < 300 THEN 'Content too short <300 characters.' END,
            CASE WHEN {_MOJIBAKE} THEN 'Potential encoding issues in content' END,
            CASE WHEN lang = 'fr' THEN 'Invalid language code: fra' END,
            CASE WHEN lang = 'es' THEN 'Invalid URL format: ftp://x' END) AS errors FROM documents_noised""",
)
def _(v):
    records = _checked_records(v)
    errors = validation.record_errors(validation.Fields(records), min_length=300)
    return records.select("doc_id", F.array_join(errors, " / ").alias("errors"))


@query(
    "v1_batch_verdict",
    f"""SELECT count(*) AS record_count, (count(*) FILTER (WHERE lang = 'de') + 2 * count(*) FILTER (WHERE lang = 'fr') + count(*) FILTER (WHERE lang = 'es')
            + count(*) FILTER (WHERE {_MOJIBAKE}))::BIGINT AS error_count, false AS passed FROM documents_noised""",
)
def _(v):
    records = _checked_records(v)
    return validation.batch_verdict(records.select("doc_id", validation.record_errors(validation.Fields(records)).alias("errors")))


@query(
    "v2_article_errors",
    f"""SELECT doc_id, concat_ws(' / ', CASE WHEN lang = 'de' THEN 'Missing required field: title' END,
            CASE WHEN lang = 'fr' THEN 'Empty required field: collected_at' END,
            CASE WHEN length({strip_sql('content')}) < 300 THEN 'Content too short: ' || length(content) || ' char' END) AS errors FROM documents_noised""",
)
def _(v):
    records = _checked_records(v)
    errors = validation.article_errors(validation.Fields(records), min_length=300)
    return records.select("doc_id", F.array_join(errors, " / ").alias("errors"))


_ESTIMATE, _TREND = "try_cast(pct_estimate AS DOUBLE)", "try_cast(pct_trend_adjusted AS DOUBLE)"


def _as_shown(x):
    """A number as Spark writes it: at least one decimal place."""
    return f"CASE WHEN {x} = trunc({x}) THEN {x}::BIGINT || '.0' ELSE {x}::VARCHAR END"


@query(
    "v3_poll_errors",
    f"""SELECT order_id, line_no, concat_ws(' / ', CASE WHEN cycle IS NULL THEN 'Missing required field: cycle' END,
            CASE WHEN cycle LIKE '%.0' THEN 'Cycle must be an integer: ' || cycle END,
            CASE WHEN pct_estimate = 'n/a' THEN 'Percentage estimate must be a number: n/a' END,
            CASE WHEN {_ESTIMATE} < 0 OR {_ESTIMATE} > 100 THEN 'Invalid percentage estimate: ' || {_as_shown(_ESTIMATE)} || '. Must be between 0.0 and 100.0' END,
            CASE WHEN abs({_ESTIMATE} - {_TREND}) > 50 THEN 'Large difference between estimate (' || {_as_shown(_ESTIMATE)} || ') and trend-adjusted ('
                 || {_as_shown(_TREND)} || '): ' || {_as_shown(f'abs({_ESTIMATE} - {_TREND})')} || '%' END) AS errors FROM raw_polls""",
)
def _(v):
    records = v.raw_polls()
    # "2000.0" is text here, which is no whole number, as it is not for a plain int conversion.
    return records.select("order_id", "line_no", F.array_join(validation.poll_errors(validation.Fields(records)), " / ").alias("errors"))


@query(
    "v3_typed_poll_errors",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_no,
              CASE WHEN year(l_shipdate) % 2 = 1 THEN '' ELSE 'Invalid language code: fr. Expected ''en'' for FiveThirtyEight data' END AS errors FROM lineitem""",
)
def _(v):
    """Typed columns: a cycle of 2016.0 is the whole number 2016."""
    year = F.year("l_shipdate")
    records = v.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        year.cast("double").alias("cycle"),
        F.lit("Ohio").alias("state"),
        F.lit("A").alias("candidate_name"),
        F.lit(40.5).alias("pct_estimate"),
        F.when(year % 2 == 1, "en").otherwise("fr").alias("language"),
    )
    return records.select("order_id", "line_no", F.array_join(validation.poll_errors(validation.Fields(records)), " / ").alias("errors"))


def _schema_case(v, version="2.0.0"):
    cleaned = cleaners.poll_columns(v.raw_polls(), version, YEAR)
    document = F.to_variant_object(F.struct(*cleaners.poll_output_columns(version)))
    return cleaned.select("order_id", "line_no", document.alias("document"))


@query(
    "v4_schema_errors",
    f"""SELECT order_id, line_no, concat_ws(' / ', CASE WHEN cycle IS NULL THEN 'cycle: null is not of type ''integer''' END,
            CASE WHEN pct_estimate > 40 THEN 'pct_estimate: is greater than the maximum of 40' END) AS errors FROM ({_TRANSFORM})""",
)
def _(v):
    schema = {
        **POLL_SCHEMA["schema"],
        "properties": {**POLL_SCHEMA["schema"]["properties"], "pct_estimate": {"type": ["number", "null"], "maximum": 40}},
    }
    checked = json_schema.with_schema_errors(_schema_case(v), "document", schema, "e")
    shown = F.transform("e", lambda x: F.concat_ws(": ", x["path"], F.regexp_replace(x["message"], r"^[0-9.]+ ", "")))
    return checked.select("order_id", "line_no", F.array_join(shown, " / ").alias("errors"))


@query(
    "v4_schema_alternatives",
    f"""SELECT order_id, line_no, concat_ws(',', CASE WHEN cycle IS NULL THEN 'cycle/2' END, CASE WHEN line_no % 3 = 0 THEN 'kind/0' END,
               CASE WHEN pct_estimate < 25 THEN 'pct/2' END) AS errors, CASE WHEN pct_estimate < 25 THEN pct_estimate::DOUBLE END AS failed_pct FROM ({_TRANSFORM})""",
)
def _(v):
    """A number of at least 25 or null, by anyOf; a kind that is not L0; a cycle that is a whole number or a text."""
    cleaned = cleaners.poll_columns(v.raw_polls(), "2.0.0", YEAR)
    parts = F.struct(
        F.col("pct_estimate").cast("double").alias("pct"), F.concat(F.lit("L"), (F.col("line_no") % 3).cast("string")).alias("kind"), "cycle"
    )
    schema = {
        "properties": {
            "pct": {"anyOf": [{"type": "number", "minimum": 25}, {"type": "null"}]},
            "kind": {"not": {"const": "L0"}},
            "cycle": {"$ref": "#/definitions/name_or_number"},
        },
        "definitions": {"name_or_number": {"oneOf": [{"type": "integer"}, {"type": "string"}]}},
    }
    checked = json_schema.with_schema_errors(cleaned.withColumn("document", F.to_variant_object(parts)), "document", schema, "e")
    shown = F.transform("e", lambda x: F.concat_ws("/", x["path"], F.size(x["sub_errors"]).cast("string")))
    failed = F.get(F.filter("e", lambda x: x["path"] == "pct"), 0)["failed_value"].cast("double")
    return checked.select("order_id", "line_no", F.array_join(shown, ",").alias("errors"), failed.alias("failed_pct"))


@query(
    "v5_active_schemas",
    f"""WITH {SCHEMAS_SQL} SELECT id AS schema_id, json_extract_string(metadata_schema, '$.cleaner_name') AS name,
        json_extract_string(metadata_schema, '$.current_schema_version') AS version FROM stored_schemas""",
)
def _(v):
    older = _schemas(v).withColumns({"id": F.col("id") - 100000, "created_at": F.col("created_at") - F.make_dt_interval(days=F.lit(1))})
    return json_schema.active_schemas(_schemas(v).unionByName(older)).select("schema_id", "name", "version")


@query(
    "v5_schema_info",
    f"""WITH {SCHEMAS_SQL} SELECT s.id AS schema_id, json_extract_string(metadata_schema, '$.cleaner_name') AS name, s.created_at, count(r.id) AS row_count
        FROM stored_schemas s LEFT JOIN raw_data r ON r.raw_data_metadata_schema_id = s.id GROUP BY 1, 2, 3""",
)
def _(v):
    info = json_schema.schema_info(_schemas(v), v.raw_data(), "raw_data_metadata_schema_id")
    return info.select("schema_id", "name", "created_at", "row_count")


@query(
    "v6_route",
    f"""SELECT doc_id, CASE WHEN lang IN ('de', 'fr') THEN 'invalid' ELSE 'valid' END AS validation_status,
               CASE lang WHEN 'de' THEN '{{"validation_errors":["Missing required field: title"]}}'
                         WHEN 'fr' THEN '{{"validation_errors":["Empty required field: collected_at"]}}' END AS validation_error FROM documents_noised""",
)
def _(v):
    records = _checked_records(v)
    checked = records.withColumn("errors", validation.article_errors(validation.Fields(records)))
    return validation.route(checked).select("doc_id", "validation_status", "validation_error")


@query(
    "v7_target_outcomes",
    """SELECT t.id, count(a.id) AS saved_count, CASE WHEN count(a.id) > 0 THEN 'collected' ELSE 'failed' END AS collection_status_name
       FROM collection_targets t LEFT JOIN collection_attempts a ON a.collection_target_id = t.id AND a.attempt_status_id = 1 GROUP BY t.id""",
)
def _(v):
    return validation.target_outcomes(v.collection_targets(), v.collection_attempts().filter("attempt_status_id = 1"))


@query("v7_failed_checks", "SELECT DISTINCT collection_target_id AS id, 'check_failed' AS collection_status_name FROM check_collection_targets WHERE test_status <> 'success'")
def _(v):
    return validation.failed_check_targets(v.check_collection_targets())


@query(
    "v8_unknown_inputs",
    """SELECT kind, name FROM (VALUES ('type', '1-URGENT'), ('type', '9-NEVER'), ('language', 'NATION_4'), ('language', 'xx'), ('status', 'lost')) AS r(kind, name)
       WHERE NOT EXISTS (SELECT 1 FROM collection_targets c JOIN collection_types t ON c.collection_type_id = t.id WHERE r.kind = 'type' AND t.name = r.name)
         AND NOT EXISTS (SELECT 1 FROM collection_targets c WHERE r.kind = 'language' AND c.language_code = r.name)
         AND NOT EXISTS (SELECT 1 FROM collection_statuses s WHERE r.kind = 'status' AND s.name = r.name)""",
)
def _(v):
    available = validation.available_inputs(v.collection_targets(), v.collection_types(), v.collection_statuses())
    return validation.unknown_inputs(
        available, {"type": ["1-URGENT", "9-NEVER"], "language": ["NATION_4", "xx"], "status": ["lost"]}
    )


