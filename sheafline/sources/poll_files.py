"""Poll CSV files in two layouts, poll records, and the targets made from their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.polls import election_day
from ..schemas import CORRUPT, POLL_CSV_LAYOUTS, POLL_MODEL_COLUMNS, POLL_STORED_FIELDS
from ..vocab import POLL_COLLECTION_SOURCE


def header_schema(spark: SparkSession, path: str, layout: str) -> T.StructType:
    """Typed schema in the column order of the file; only the header line is read."""
    known = {field.name: field.dataType for field in POLL_CSV_LAYOUTS[layout].fields}
    names = spark.read.option("header", True).option("maxColumns", 1000).csv(path, inferSchema=False).columns
    fields = [T.StructField(name, known.get(name, T.StringType())) for name in names]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


def read_poll_csv(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Read one layout; types are declared, a broken line keeps its text in ``_corrupt_record``."""
    return (
        spark.read.schema(header_schema(spark, path, layout))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("escape", '"')
        .csv(path)
    )


def with_row_index(df: DataFrame, name: str = "original_row_index") -> DataFrame:
    """Add the 0-based place of each row in the order of one file.

    Done once at ingest and stored: later jobs join on the stored number. The
    file is scanned twice, to count the rows of each split and to number them;
    only one count per split is moved.
    """
    part = F.spark_partition_id()
    counts = df.select(part.alias("_part")).groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per file split, so one task is enough for the running sum.
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = df.withColumns(
        {"_part": part, "_pos": F.monotonically_increasing_id() - F.shiftleft(part.cast("bigint"), 33)}
    )
    return placed.join(starts, "_part").select(*df.columns, (F.col("_start") + F.col("_pos")).alias(name))


def _first_present(df: DataFrame, names: list[str]) -> Column:
    columns = [F.col(name).cast("string") for name in names if name in df.columns]
    return F.coalesce(*columns) if columns else F.lit(None).cast("string")


def _underscored(c: Column) -> Column:
    return F.translate(c, " ", "_")


def target_names(rows: DataFrame, row_index: str = "original_row_index") -> DataFrame:
    """``collection_name`` of each file row: cycle, state, candidate, and line number in the file.

    Line numbers start at 1 and the header takes the first, hence the 2.
    """
    return rows.withColumn(
        "collection_name",
        F.concat_ws(
            "_",
            F.coalesce(F.col("cycle").cast("string"), F.lit("unknown")),
            _underscored(F.coalesce(F.col("state"), F.lit("unknown"))),
            _underscored(F.coalesce(_first_present(rows, ["candidate_name", "candidate"]), F.lit("unknown"))),
            (F.col(row_index) + 2).cast("string"),
        ),
    )


def import_targets(rows: DataFrame, collector_name_id: int, collection_type_id: int, status_id: int, language: str = "en") -> DataFrame:
    """Targets for every file row, ready for the bulk insert. A dry run is ``.count()`` of this."""
    return target_names(rows).select(
        F.lit(collector_name_id).cast("bigint").alias("collector_name_id"),
        F.lit(collection_type_id).cast("bigint").alias("collection_type_id"),
        F.lit(language).alias("language_code"),
        "collection_name",
        F.lit(status_id).cast("bigint").alias("collection_status_id"),
    )


def poll_records(rows: DataFrame, collected_at: str, row_index: str = "original_row_index") -> DataFrame:
    """Poll record of each file row: file columns plus names, dates, constants, title, content."""
    candidate = F.coalesce(_first_present(rows, ["candidate_name", "candidate"]), F.lit("Unknown"))
    state = F.coalesce(F.col("state"), F.lit("Unknown"))
    cycle = F.coalesce(F.col("cycle").cast("string"), F.lit("Unknown"))
    estimate = F.coalesce(F.col("pct_estimate").cast("string"), F.lit("N/A"))
    day = _first_present(rows, ["election_date"])
    from_cycle = election_day(F.col("cycle")) if "date" in rows.columns else F.lit(None).cast("string")
    out = rows.withColumns(
        {
            "candidate_name": _first_present(rows, ["candidate_name", "candidate"]),
            "modeldate": _first_present(rows, ["date", "modeldate"]),
            "election_date": F.coalesce(F.when(day != "", day), from_cycle),
            "language": F.lit("en"),
            "collected_at": F.lit(collected_at),
            "collection_source": F.lit(POLL_COLLECTION_SOURCE),
            "title": F.concat_ws(" - ", _underscored(candidate), _underscored(state), cycle),
            "content": F.format_string(
                "Polling data for %s in %s (%s): %s%% estimate",
                _underscored(candidate),
                _underscored(state),
                cycle,
                estimate,
            ),
        }
    )
    return out.drop(CORRUPT) if CORRUPT in out.columns else out


def stored_poll_fields(records: DataFrame) -> DataFrame:
    """Storage projection: the stored fields and the model-internal columns that are present."""
    wanted = [*POLL_STORED_FIELDS, *POLL_MODEL_COLUMNS]
    return records.select(*[c for c in wanted if c in records.columns])


def poll_metadata(records: DataFrame) -> Column:
    """The same projection as one JSON column; nulls are kept."""
    wanted = [c for c in [*POLL_STORED_FIELDS, *POLL_MODEL_COLUMNS] if c in records.columns]
    return F.to_json(F.struct(*wanted), {"ignoreNullFields": "false"})


def source_row_index(name: Column) -> Column:
    """Row index named by a target: the last ``_`` part less 2; null when the name is malformed."""
    parts = F.split(name, "_")
    number = F.element_at(parts, -1).try_cast("bigint") - 2
    return F.when((F.size(parts) >= 4) & (number >= 0), number)


def match_targets_to_rows(targets: DataFrame, rows: DataFrame, row_index: str = "original_row_index", how: str = "inner") -> DataFrame:
    """Targets with the file row each one names; an index past the end finds nothing."""
    keyed = targets.withColumn("_row", source_row_index(F.col("collection_name")))
    right = rows.withColumnRenamed(row_index, "_row")
    return keyed.join(right, "_row", how).withColumnRenamed("_row", row_index)
