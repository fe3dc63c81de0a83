"""Explicit schemas: model tables and the two poll file layouts."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(columns: str) -> T.StructType:
    """``name TYPE, ...`` → schema, without needing a running session."""
    pairs = (part.split() for part in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


LOOKUP = _struct("id BIGINT, name STRING, updated_at TIMESTAMP, created_at TIMESTAMP")
METADATA_SCHEMAS = _struct("id BIGINT, metadata_schema STRING, updated_at TIMESTAMP, created_at TIMESTAMP")
COLLECTION_TARGETS = _struct(
    "id BIGINT, collector_name_id BIGINT, collection_type_id BIGINT, language_code STRING, "
    "collection_name STRING, collection_status_id BIGINT, updated_at TIMESTAMP, created_at TIMESTAMP"
)
COLLECTION_ATTEMPTS = _struct(
    "id BIGINT, collection_target_id BIGINT, language_code STRING, search_term_used STRING, "
    "attempt_status_id BIGINT, error_type_id BIGINT, error_message STRING, created_at TIMESTAMP"
)
RAW_DATA = _struct(
    "id BIGINT, collection_attempt_id BIGINT, raw_data_metadata_schema_id BIGINT, title STRING, "
    "language_code STRING, url STRING, metadata STRING, validation_status_id BIGINT, "
    "validation_error STRING, filepath_of_save STRING, created_at TIMESTAMP"
)
CHECK_COLLECTION_TARGETS = _struct(
    "id BIGINT, collection_target_id BIGINT, search_term_used STRING, language_code STRING, "
    "test_status STRING, search_results_found STRING, error_message STRING, test_duration BIGINT, "
    "created_at TIMESTAMP"
)
RUN_COLLECTION_METADATA = _struct(
    "id BIGINT, collection_attempt_id BIGINT, run_type_id BIGINT, run_status_id BIGINT, "
    "attempts_successful BIGINT, attempts_failed BIGINT, config_used STRING, "
    "completed_at TIMESTAMP, created_at TIMESTAMP"
)
LINK_ATTEMPTS_TO_RUNS = _struct("id BIGINT, collection_attempt_id BIGINT, run_collection_metadata_id BIGINT")
CLEANED_DATA = _struct(
    "id BIGINT, raw_data_id BIGINT, cleaned_data_metadata_schema_id BIGINT, title STRING, "
    "language_code STRING, url STRING, metadata STRING, validation_status_id BIGINT, "
    "validation_error STRING, cleaner_used STRING, cleaner_version STRING, cleaning_time_ms BIGINT, "
    "cleaned_at TIMESTAMP, created_at TIMESTAMP"
)

# Model-internal columns of the older poll file, kept when present.
POLL_MODEL_COLUMNS = [
    "_medpoly2",
    "trend_medpoly2",
    "_shortpoly0",
    "trend_shortpoly0",
    "sum_weight_medium",
    "sum_weight_short",
    "sum_influence",
    "sum_nat_influence",
    "_minpoints",
    "_defaultbasetime",
    "_numloops",
    "_state_houseeffects_weight",
    "_state_trendline_weight",
    "_out_of_state_house_discount",
    "_house_effects_multiplier",
    "_attenuate_endpoints",
    "_nonlinear_polynomial_degree",
    "_shortpoly_combpoly_weight",
    "_nat_shortpoly_combpoly_weight",
]

# Fields of a stored poll record and of a stored article record.
POLL_STORED_FIELDS = [
    "cycle", "state", "modeldate", "candidate_name", "candidate_id", "pct_estimate",
    "pct_trend_adjusted", "timestamp", "comment", "election_date", "election_qdate",
    "last_qdate", "last_enddate", "language", "collected_at", "collection_source",
    "original_row_index",
]
ARTICLE_STORED_FIELDS = [
    "title", "content", "url", "language", "page_id", "word_count", "timestamp", "collected_at",
]

CORRUPT = "_corrupt_record"

POLL_CSV_1968_2016 = T.StructType(
    [
        T.StructField("cycle", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("modeldate", T.StringType()),
        T.StructField("candidate_name", T.StringType()),
        T.StructField("candidate_id", T.LongType()),
        T.StructField("pct_estimate", T.DoubleType()),
        T.StructField("pct_trend_adjusted", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("comment", T.StringType()),
        T.StructField("election_date", T.StringType()),
        T.StructField("election_qdate", T.StringType()),
        T.StructField("last_qdate", T.StringType()),
        T.StructField("last_enddate", T.StringType()),
    ]
    + [T.StructField(name, T.DoubleType()) for name in POLL_MODEL_COLUMNS]
    + [T.StructField(CORRUPT, T.StringType())]
)
POLL_CSV_2020_2024 = _struct(
    "candidate STRING, date STRING, pct_trend_adjusted DOUBLE, state STRING, cycle INT, "
    f"party STRING, pct_estimate DOUBLE, hi DOUBLE, lo DOUBLE, {CORRUPT} STRING"
)
POLL_CSV_LAYOUTS = {"1968-2016": POLL_CSV_1968_2016, "2020-2024": POLL_CSV_2020_2024}
