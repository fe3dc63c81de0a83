"""Model tables built from the given tables.

Every view is a plain select or join over whole tables, so its work grows with
them. The mapping gives each model column a source with similar behaviour
(repeated titles, several attempts per target, late and failed rows).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stage
from ..vocab import ATTEMPT_STATUSES, COLLECTION_STATUSES, ERROR_TYPES, VALIDATION_STATUSES, lookup
from .pages import page_catalogue
from .tables import dealt_finely, spread

# Names given to values of the given tables.
TARGET_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
COLLECTORS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
RUN_STATUSES = ["completed", "failed", "running"]
LANGUAGES = ["en", "fr", "de", "es"]
CLEANER_BY_LANG = {"en": "article_cleaner", "fr": "poll_cleaner"}
OTHER_CLEANER = "table_cleaner"


_SCHEMAS: dict[str, StructType] = {}


def _index(c: Column, names: list[str]) -> Column:
    """1-based place of a value in a list, null when it is not in it."""
    out = F.lit(None).cast("bigint")
    for place, name in enumerate(names, start=1):
        out = F.when(c == name, F.lit(place).cast("bigint")).otherwise(out)
    return out


@dataclass(frozen=True)
class ModelViews:
    """Lazy access to the model tables over one folder of Parquet tables."""

    spark: SparkSession
    folder: str
    _staged: dict[str, DataFrame] = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> DataFrame:
        """One given table. Its schema is read from a file footer once and then declared."""
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # Lookups

    def validation_statuses(self) -> DataFrame:
        return lookup(self.spark, VALIDATION_STATUSES)

    def attempt_statuses(self) -> DataFrame:
        return lookup(self.spark, ATTEMPT_STATUSES)

    def collection_statuses(self) -> DataFrame:
        return lookup(self.spark, COLLECTION_STATUSES)

    def error_types(self) -> DataFrame:
        return lookup(self.spark, ERROR_TYPES)

    def collection_types(self) -> DataFrame:
        return lookup(self.spark, TARGET_TYPES)

    def collector_names(self) -> DataFrame:
        return lookup(self.spark, COLLECTORS)

    def run_types(self) -> DataFrame:
        return lookup(self.spark, TARGET_TYPES)

    def run_statuses(self) -> DataFrame:
        return lookup(self.spark, RUN_STATUSES)

    # Main tables

    def raw_data(self) -> DataFrame:
        """Documents with their labels; a title is a document's first line."""
        return self._raw_and_size().drop("n_chars")

    def _raw_and_size(self) -> DataFrame:
        labels = self.table("labels").select("doc_id", "quality")
        docs = self.table("documents").join(labels, "doc_id", "left")
        status = F.when(F.col("quality") == 1, 1).when(F.col("quality") == 0, 2).otherwise(3).cast("bigint")
        return docs.select(
            F.col("doc_id").alias("id"),
            F.col("doc_id").alias("collection_attempt_id"),
            F.when(F.col("n_chars") > 1000, 2).otherwise(1).cast("bigint").alias("raw_data_metadata_schema_id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.col("lang").alias("language_code"),
            F.concat(F.lit("https://example.com/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string")).alias("url"),
            F.to_json(
                F.struct(F.col("text").alias("content"), "source", "n_chars", F.col("lang").alias("language"))
            ).alias("metadata"),
            status.alias("validation_status_id"),
            F.lit(None).cast("string").alias("validation_error"),
            F.concat(F.lit("store/"), F.col("source"), F.lit(".json")).alias("filepath_of_save"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.col("doc_id") * F.make_dt_interval(mins=F.lit(1))).alias("created_at"),
            "n_chars",
        )

    def cleaned_data(self) -> DataFrame:
        """Raw rows that are labelled valid or invalid; pending rows are not cleaned yet."""
        raw = self._raw_and_size().filter(F.col("validation_status_id") != 3)
        cleaner = F.lit(OTHER_CLEANER)
        for lang, name in CLEANER_BY_LANG.items():
            cleaner = F.when(F.col("language_code") == lang, name).otherwise(cleaner)
        n_chars = F.col("n_chars")
        return raw.select(
            F.col("id").alias("id"),
            F.col("id").alias("raw_data_id"),
            F.col("raw_data_metadata_schema_id").alias("cleaned_data_metadata_schema_id"),
            "title",
            "language_code",
            "url",
            "metadata",
            "validation_status_id",
            "validation_error",
            cleaner.alias("cleaner_used"),
            F.when(n_chars > 1000, "2.0.0").otherwise("1.0.0").alias("cleaner_version"),
            (n_chars % 97).alias("cleaning_time_ms"),
            F.col("created_at").alias("cleaned_at"),
            "created_at",
        )

    def collection_targets(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        nations = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_orderdate", "o_orderpriority")
        joined = orders.join(customers, "c_custkey").join(nations, "c_nationkey")
        return joined.select(
            F.col("o_orderkey").alias("id"),
            _index(F.col("c_mktsegment"), COLLECTORS).alias("collector_name_id"),
            _index(F.col("o_orderpriority"), TARGET_TYPES).alias("collection_type_id"),
            F.col("n_name").alias("language_code"),
            F.col("c_name").alias("collection_name"),
            F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).cast("bigint").alias("collection_status_id"),
            F.col("o_orderdate").alias("updated_at"),
            F.col("o_orderdate").alias("created_at"),
        )

    def collection_attempts(self) -> DataFrame:
        k = F.get_json_object("props", "$.k").cast("bigint")
        failed = F.col("event_type") == "error"
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("collection_target_id"),
            self._user_language().alias("language_code"),
            F.concat_ws(" ", "event_type", k.cast("string")).alias("search_term_used"),
            F.when(failed, 2).when(F.col("event_type") == "signup", 3).otherwise(1).cast("bigint").alias("attempt_status_id"),
            F.when(failed, k % 11 + 1).alias("error_type_id"),
            F.when(failed, F.col("props")).alias("error_message"),
            F.col("ts").alias("created_at"),
        )

    def _user_language(self) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]), (F.col("user_id") % 4 + 1).cast("int"))

    def check_collection_targets(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("collection_target_id"),
            F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k")).alias("search_term_used"),
            self._user_language().alias("language_code"),
            F.when(kind == "purchase", "success").when(kind == "error", "failed").otherwise("failed_with_suggestions").alias("test_status"),
            F.lit("[]").alias("search_results_found"),
            F.when(kind == "purchase", "").otherwise(F.col("props")).alias("error_message"),
            F.floor("value").cast("bigint").alias("test_duration"),
            F.col("ts").alias("created_at"),
        )

    def run_collection_metadata(self) -> DataFrame:
        lines = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.count_if(F.col("l_linestatus") == "F").alias("attempts_successful"),
            F.count_if(F.col("l_linestatus") == "O").alias("attempts_failed"),
            F.max("l_shipdate").alias("_shipped"),
        )
        status = F.col("o_orderstatus")
        return self.table("orders").join(lines, "o_orderkey").select(
            F.col("o_orderkey").alias("id"),
            F.lit(None).cast("bigint").alias("collection_attempt_id"),
            _index(F.col("o_orderpriority"), TARGET_TYPES).alias("run_type_id"),
            F.when(status == "O", 1).when(status == "F", 2).otherwise(3).cast("bigint").alias("run_status_id"),
            "attempts_successful",
            "attempts_failed",
            F.lit(None).cast("string").alias("config_used"),
            F.when(status != "P", F.col("_shipped")).alias("completed_at"),
            F.col("o_orderdate").alias("created_at"),
        )

    def link_attempts_to_runs(self) -> DataFrame:
        # Nearly all pairs differ, so the whole table is held by the tasks that drop repeated ones.
        lines = dealt_finely(self.table("lineitem").select("l_partkey", "l_orderkey"), "l_partkey", "l_orderkey")
        return lines.select(
            F.col("l_partkey").alias("collection_attempt_id"), F.col("l_orderkey").alias("run_collection_metadata_id")
        ).distinct()

    def polls(self, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        """Cleaned polls: one per line item, in the state of its supplier.

        A range of days becomes a predicate on the stored time, which reaches the scan.
        """
        suppliers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        nations = self.table("nation").select("n_nationkey", "n_name")
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity", "l_discount", "l_tax", "l_shipdate"
        )
        kind = lines.schema["l_shipdate"].dataType
        if first_day is not None:
            lines = lines.filter(F.col("l_shipdate") >= F.lit(first_day).cast(kind))
        if last_day is not None:
            lines = lines.filter(F.col("l_shipdate") < F.date_add(F.lit(last_day).cast("date"), 1).cast(kind))
        return lines.join(suppliers, "l_suppkey").join(nations, "n_nationkey").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("poll_id"),
            F.year("l_shipdate").alias("cycle"),
            F.col("n_name").alias("cleaned_state"),
            F.col("l_returnflag").alias("cleaned_candidate_name"),
            F.col("l_quantity").alias("pct_estimate"),
            (F.col("l_quantity") + F.lit(100.0) * (F.col("l_discount") - F.lit(0.05))).alias("pct_trend_adjusted"),
            F.to_date("l_shipdate").alias("model_date"),
            F.abs("l_tax").alias("sum_influence"),
        )

    def raw_polls(self) -> DataFrame:
        """Uncleaned poll records as text, with the flaws found in such files."""
        suppliers = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        nations = self.table("nation").select("n_nationkey", "n_name")
        lines = spread(
            self.table("lineitem").select(
                "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity", "l_tax", "l_shipdate"
            ),
            "l_orderkey",
        )
        joined = lines.join(suppliers, "l_suppkey").join(nations, "n_nationkey")
        number, day = F.col("l_linenumber"), F.col("l_shipdate")
        quantity = F.col("l_quantity").cast("int")
        us_day = F.concat_ws("/", F.month(day).cast("string"), F.dayofmonth(day).cast("string"), F.year(day).cast("string"))
        iso_day = F.date_format(day, "yyyy-MM-dd")
        return joined.select(
            F.col("l_orderkey").alias("order_id"),
            number.alias("line_no"),
            F.when(number == 6, F.lit(None)).when(number == 5, F.concat(F.year(day).cast("string"), F.lit(".0"))).otherwise(F.year(day).cast("string")).alias("cycle"),
            F.concat(F.lit(" "), F.replace("n_name", F.lit("_"), F.lit(" ")), F.lit("\t")).alias("state"),
            F.when(F.col("l_returnflag") == "A", "Donald  J. Trump ").when(F.col("l_returnflag") == "N", " Hillary Rodham Clinton").otherwise("Bernie Sanders").alias("candidate_name"),
            F.when(number == 1, F.concat(F.lit("-"), quantity.cast("string")))
            .when(number == 2, (quantity + 100).cast("string"))
            .when(number == 3, "n/a")
            .otherwise(F.concat(quantity.cast("string"), F.lit(".1234567")))
            .alias("pct_estimate"),
            F.when(number != 4, (quantity * 2).cast("string")).alias("pct_trend_adjusted"),
            F.when(number <= 3, us_day).when(number == 4, F.concat(iso_day, F.lit("T00:00:00"))).when(number == 5, "13-2020").otherwise(iso_day).alias("modeldate"),
            F.lit("11/3/2020").alias("election_date"),
            F.when(F.col("l_linestatus") == "F", (F.abs("l_tax") * 100).cast("int").cast("string")).alias("sum_influence"),
        )

    def documents_noised(self) -> DataFrame:
        """Whole documents with the flaws the text cleaner removes, put in by document number."""
        n = F.col("doc_id")
        noise = (
            F.when(n % 5 == 0, F.concat(F.lit("  "), "text", F.lit("[12] end[3]")))
            .when(n % 5 == 1, F.concat(F.lit("“"), "text", F.lit("” it’s ‘so’")))
            .when(n % 5 == 2, F.concat("text", F.lit(" — a–b")))
            .when(n % 5 == 3, F.concat("text", F.lit("\n\n\n\nlast\n \n\nline\n")))
            .otherwise(F.concat("text", F.lit("  two\t\tgaps [citation needed] x[clarification needed] ")))
        )
        mojibake = F.when(n % 50 == 7, F.concat(noise, F.lit("Ã©"))).otherwise(noise)
        docs = spread(self.table("documents").select("doc_id", "text", "lang", "source"), "doc_id")
        return docs.select("doc_id", "lang", "source", mojibake.alias("content"))

    def pages(self) -> DataFrame:
        return spread(self.table("pages"), "page_id")

    def stored_page_catalogue(self) -> DataFrame:
        """The catalogue as a table written once, for jobs that read it several times."""
        if "page_catalogue" not in self._staged:
            self._staged["page_catalogue"] = stage(self.page_catalogue(), "page-catalogue")
        return self._staged["page_catalogue"].select("*")

    def page_catalogue(self) -> DataFrame:
        return page_catalogue(self.pages())
