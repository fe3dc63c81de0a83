"""Bulk table maintenance: repeat-safe appends, keyed updates, retention, deletes, numbering.

Each function returns the rows to write, or the new state of the table; the
caller writes it. Nothing is changed in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonio import canonical
from .ordering import assign_ids, first_per_key
from .selectors import cutoff

CLEANED_KEY = ["cleaner_used", "cleaner_version", "raw_data_id"]
TARGET_KEY = ["collector_name_id", "collection_type_id", "language_code", "collection_name"]
LINK_KEY = ["collection_attempt_id", "run_collection_metadata_id"]


def first_of_batch(batch: DataFrame, keys: list[str], order: list[Column] | None) -> DataFrame:
    """One row per key: the first in ``order``, or any."""
    return first_per_key(batch, keys, order) if order else batch.dropDuplicates(keys)


def new_rows(batch: DataFrame, table: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Batch rows to append: one per key, and none whose key the table already holds.

    Running the same batch twice appends nothing the second time. ``order``
    decides which row of a repeated key is kept.
    """
    return first_of_batch(batch, keys, order).join(table.select(*keys), keys, "left_anti")


def conflicts(batch: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Batch keys the table already holds, or that the batch repeats: an all-or-nothing insert stops on any."""
    repeated = batch.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > 1).select(*keys)
    known = batch.select(*keys).join(table.select(*keys), keys, "left_semi")
    return known.unionByName(repeated).distinct()


def merge_update(
    table: DataFrame, updates: DataFrame, key: str, columns: list[str], order: list[Column] | None = None, unique: bool = False
) -> DataFrame:
    """New state of a table after setting ``columns`` for the keys in ``updates``.

    A matched flag carries the match, so null can be set. Of repeated keys one
    update is used (the first in ``order``); ``unique`` says there are none.
    """
    one = updates if unique else first_of_batch(updates, [key], order)
    new = one.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched"))
    joined = table.join(new, key, "left")
    return joined.select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in table.columns
        ]
    )


def matched_count(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """How many rows an update changes."""
    return table.join(updates.select(key), key, "left_semi").agg(F.count("*").alias("updated_count"))


def set_status(table: DataFrame, ids: DataFrame, status_col: str, status_id: int | Column, key: str = "id") -> DataFrame:
    """New state of a table with one status set for a set of keys."""
    value = status_id if isinstance(status_id, Column) else F.lit(status_id).cast("bigint")
    return merge_update(table, ids.select(key).withColumn(status_col, value), key, [status_col])


def older_than(table: DataFrame, days: int, as_of: str, time: str = "created_at") -> DataFrame:
    """Rows that retention removes."""
    return table.filter(F.col(time) < cutoff(table, time, as_of, days=days))


def keep_recent(table: DataFrame, days: int, as_of: str, time: str = "created_at") -> DataFrame:
    """Rows that retention keeps (a null time is kept)."""
    return table.filter(F.col(time).isNull() | (F.col(time) >= cutoff(table, time, as_of, days=days)))


def delete_keys(table: DataFrame, keys: DataFrame, key: str = "id") -> DataFrame:
    """Table without the rows named by a key table."""
    gone = keys.select(F.col(keys.columns[0]).alias("_gone"))
    return table.join(gone, table[key] == gone["_gone"], "left_anti")


def next_ids(
    batch: DataFrame, table: DataFrame, unique_key: Column, key: str = "id", buckets: int | None = None, table_key: str | None = None
) -> DataFrame:
    """Number a batch after the largest id of the table."""
    start = table.select(F.coalesce(F.max(table_key or key), F.lit(0))).scalar()
    return assign_ids(batch, unique_key, start, key, buckets)


def get_or_create(lookup: DataFrame, names: DataFrame, name_col: str, buckets: int | None = None) -> DataFrame:
    """Lookup table with every name of ``names`` in it; new names get the next ids.

    Names are made distinct before anything else, so the work is that of the
    vocabulary and not of the rows.
    """
    wanted = names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
    fresh = wanted.join(lookup.select("name"), "name", "left_anti")
    numbered = next_ids(fresh, lookup, F.col("name"), buckets=buckets)
    return lookup.select("id", "name").unionByName(numbered.select("id", "name"))


def get_or_create_schemas(schemas: DataFrame, documents: DataFrame, document_col: str, buckets: int | None = None) -> DataFrame:
    """Per different document: its text, the schema_id it has or gets, and whether it is new.

    Documents are the same if they are equal as JSON, whatever their order of keys and
    spaces. They meet by a hash of the canonical text and are then compared by the text
    itself. Of equal stored ones the smallest id counts; new ones get the next ids.
    Malformed documents and nulls are left out.
    """

    def keyed(rows: DataFrame, text: str) -> DataFrame:
        out = rows.withColumn("_document", canonical(F.col(text))).filter(F.col("_document").isNotNull())
        return out.withColumn("_hash", F.xxhash64("_document"))

    stored = keyed(schemas.select("id", "metadata_schema"), "metadata_schema")
    known = stored.groupBy("_hash", "_document").agg(F.min("id").alias("schema_id"))
    wanted = keyed(documents.select(document_col), document_col).select("_hash", "_document").distinct()
    # Schemas are few beside rows, and each is looked up once.
    found = wanted.join(known, ["_hash", "_document"])
    fresh = wanted.join(known, ["_hash", "_document"], "left_anti")
    numbered = next_ids(fresh, schemas, F.col("_document"), "schema_id", buckets, table_key="id")
    columns = [F.col("_document").alias("document"), "schema_id"]
    return found.select(*columns, F.lit(False).alias("is_new")).unionByName(numbered.select(*columns, F.lit(True).alias("is_new")))


def link_rows(attempt_ids: DataFrame, run_id: int | Column, links: DataFrame) -> DataFrame:
    """New bridge rows between attempts and a run; known pairs are left out."""
    value = run_id if isinstance(run_id, Column) else F.lit(run_id).cast("bigint")
    batch = attempt_ids.select(
        F.col(attempt_ids.columns[0]).alias("collection_attempt_id"), value.alias("run_collection_metadata_id")
    )
    return new_rows(batch, links, LINK_KEY)


def append_rows(batch: DataFrame, table: DataFrame, unique_key: Column, buckets: int | None = None) -> DataFrame:
    """Log rows in the table's own column order, with new ids; columns a batch lacks become null."""
    numbered = next_ids(batch, table, unique_key, buckets=buckets)
    present = set(numbered.columns)
    return numbered.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.schema.fields
        ]
    )
