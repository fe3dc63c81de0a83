"""Names and constants of the data model."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

# Status, type and error names stored in the lookup tables.
COLLECTION_STATUSES = ["not_collected", "collected", "failed", "check_failed"]
ATTEMPT_STATUSES = ["success", "failed", "pending", "timed out", "cancelled"]
VALIDATION_STATUSES = ["valid", "invalid", "pending", "warning", "skipped"]
COLLECTION_TYPES = ["2020-2024", "1968-2016"]
ERROR_TYPES = [
    "page_not_found",
    "disambiguation_error",
    "network_timeout",
    "api_rate_limit",
    "invalid_language_code",
    "content_too_short",
    "access_denied_error",
    "server_error",
    "parsing_error",
    "encoding_error",
    "unknown_error",
]

# Default limits of the collecting jobs.
BATCH_SIZE = 10
IMPORT_BATCH_SIZE = 2000
MIN_CONTENT_LENGTH = 1
ERROR_LIMIT = 10
MAX_RETRIES = 5
SEARCH_MAX_RESULTS = 10
SUGGESTIONS_SHOWN = 5
RECURSIVE_LIMIT = 1

# Text that shows a broken UTF-8 decode, and required article fields.
MOJIBAKE_PATTERNS = [
    "Ã©", "Ã¨", "Ã ", "Ã¡", "Ã¢", "Ã¤", "Ã§", "Ã¯", "Ã´", "Ã¹", "Ã»", "Ã¼",
    "â€™", "â€œ", "â€", "â€¢", "Â", "Ž", "â€ž", "â€º",
]
ARTICLE_REQUIRED = ["title", "content", "language", "collected_at"]

# Names and versions of the two cleaners.
ARTICLE_CLEANER = ("wikipedia_cleaner", "1.0.0")
POLL_CLEANER = ("fivethirtyeight_cleaner", "2.0.0")
POLL_COLLECTION_SOURCE = "fivethirtyeight_csv"

# Operation names recorded with every cleaned row.
ARTICLE_OPERATIONS = [
    "citation_removal",
    "unicode_normalization",
    "whitespace_normalization",
    "newline_normalization",
    "category_deduplication",
    "link_deduplication",
    "content_validation",
]
POLL_OPERATIONS = [
    "state_normalization",
    "candidate_name_normalization",
    "date_parsing",
    "percentage_validation",
    "data_type_conversion",
    "outlier_detection",
    "data_quality_scoring",
]

# Candidate aliases and election days by cycle.
CANDIDATE_ALIASES = {
    "Hillary Rodham Clinton": "Hillary Clinton",
    "Donald J. Trump": "Donald Trump",
    "Bernard Sanders": "Bernie Sanders",
}
ELECTION_DAYS = {2020: "11/3/2020", 2024: "11/5/2024"}

# Forecast model constants.
DECAY_RATE = 0.05
VOTES_NEEDED = 270
BONUS_VOTES = 3
BONUS_SURNAMES = ["Clinton", "Biden", "Harris", "Obama"]
LEAN_LEFT = ["California", "New_York", "Illinois", "Massachusetts", "Washington"]
LEAN_RIGHT = ["Texas", "Alabama", "Wyoming", "Oklahoma", "Utah"]
SWING = ["Florida", "Pennsylvania", "Michigan", "Wisconsin", "North_Carolina"]
DEFAULT_SUPPORT = 45.0
DEFAULT_DAYS = 30
ROW_WINDOWS = [7, 14, 30]

# Electoral votes by state.
STATE_VOTES = {
    "Alabama": 9, "Alaska": 3, "Arizona": 11, "Arkansas": 6, "California": 55,
    "Colorado": 9, "Connecticut": 7, "Delaware": 3, "Florida": 29, "Georgia": 16,
    "Hawaii": 4, "Idaho": 4, "Illinois": 20, "Indiana": 11, "Iowa": 6,
    "Kansas": 6, "Kentucky": 8, "Louisiana": 8, "Maine": 4, "Maryland": 10,
    "Massachusetts": 11, "Michigan": 16, "Minnesota": 10, "Mississippi": 6, "Missouri": 10,
    "Montana": 3, "Nebraska": 5, "Nevada": 6, "New_Hampshire": 4, "New_Jersey": 14,
    "New_Mexico": 5, "New_York": 29, "North_Carolina": 15, "North_Dakota": 3, "Ohio": 18,
    "Oklahoma": 7, "Oregon": 7, "Pennsylvania": 20, "Rhode_Island": 4, "South_Carolina": 9,
    "South_Dakota": 3, "Tennessee": 11, "Texas": 38, "Utah": 6, "Vermont": 3,
    "Virginia": 13, "Washington": 12, "West_Virginia": 5, "Wisconsin": 10, "Wyoming": 3,
    "National": 0,
}


def sql_literal(value: object) -> str:
    """A SQL literal for a vocabulary value."""
    if value is None:
        return "NULL"
    if isinstance(value, float) and not math.isfinite(value):
        return f"CAST('{value}' AS DOUBLE)"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_frame(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small literal table whose size the optimizer knows.

    ``columns`` is a DDL string such as ``id BIGINT, name STRING``.
    """
    names = [part.strip().split()[0] for part in columns.split(",")]
    types = [part.strip().split(None, 1)[1] for part in columns.split(",")]
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    if not rows:
        nulls = ", ".join("NULL" for _ in names)
        return spark.sql(f"SELECT {casts} FROM VALUES ({nulls}) AS v({', '.join(names)}) WHERE false")
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS v({', '.join(names)})")


def lookup(spark: SparkSession, names: list[str]) -> DataFrame:
    """Lookup table ``(id, name)`` numbered from 1 in list order."""
    return values_frame(spark, "id BIGINT, name STRING", list(enumerate(names, start=1)))
