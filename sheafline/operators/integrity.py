"""Reference and uniqueness rules as reports, and delete rules as joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reference:
    """``child.column`` refers to ``parent.id``; ``on_delete`` is restrict, cascade or set_null."""

    child: str
    column: str
    parent: str
    on_delete: str = "restrict"


# The reference rules of the data model.
REFERENCES = [
    Reference("collection_targets", "collector_name_id", "collector_names"),
    Reference("collection_targets", "collection_type_id", "collection_types"),
    Reference("collection_targets", "collection_status_id", "collection_statuses"),
    Reference("collection_attempts", "collection_target_id", "collection_targets"),
    Reference("collection_attempts", "attempt_status_id", "attempt_statuses"),
    Reference("collection_attempts", "error_type_id", "error_types"),
    Reference("raw_data", "collection_attempt_id", "collection_attempts", "cascade"),
    Reference("raw_data", "raw_data_metadata_schema_id", "raw_data_metadata_schemas"),
    Reference("raw_data", "validation_status_id", "validation_statuses"),
    Reference("check_collection_targets", "collection_target_id", "collection_targets", "cascade"),
    Reference("run_collection_metadata", "collection_attempt_id", "collection_attempts", "set_null"),
    Reference("run_collection_metadata", "run_type_id", "run_types"),
    Reference("run_collection_metadata", "run_status_id", "run_statuses"),
    Reference("link_attempts_to_runs", "collection_attempt_id", "collection_attempts", "cascade"),
    Reference("link_attempts_to_runs", "run_collection_metadata_id", "run_collection_metadata", "cascade"),
    Reference("cleaned_data", "raw_data_id", "raw_data", "cascade"),
    Reference("cleaned_data", "cleaned_data_metadata_schema_id", "cleaned_data_metadata_schemas"),
    Reference("cleaned_data", "validation_status_id", "validation_statuses"),
]

# The uniqueness rules of the data model.
UNIQUE_KEYS = {
    "collection_targets": ["collector_name_id", "collection_type_id", "language_code", "collection_name"],
    "link_attempts_to_runs": ["collection_attempt_id", "run_collection_metadata_id"],
    "cleaned_data": ["cleaner_used", "cleaner_version", "raw_data_id"],
}


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Child rows whose non-null reference has no parent row."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(column).isNotNull()).join(keys, child[column] == keys["_parent"], "left_anti")


def orphan_report(tables: dict[str, DataFrame], references: list[Reference] = REFERENCES) -> DataFrame:
    """Orphan count of each reference whose two tables are given."""
    parts = [
        orphans(tables[r.child], r.column, tables[r.parent]).agg(F.count("*").alias("orphan_count")).select(
            F.lit(r.child).alias("child"), F.lit(r.column).alias("column_name"), F.lit(r.parent).alias("parent"), "orphan_count"
        )
        for r in references
        if r.child in tables and r.parent in tables
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with the count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def restricted(deletes: DataFrame, child: DataFrame, column: str, key: str = "id") -> DataFrame:
    """Keys that may not be deleted because a child row refers to them."""
    used = child.select(F.col(column).alias("_ref"))
    return deletes.join(used, deletes[key] == used["_ref"], "left_semi")


def cascade(child: DataFrame, column: str, deletes: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Child rows that stay, and child rows that go with their parents."""
    gone = deletes.select(F.col(key).alias("_gone"))
    test = child[column] == gone["_gone"]
    return child.join(gone, test, "left_anti"), child.join(gone, test, "left_semi")


def set_null(child: DataFrame, column: str, deletes: DataFrame, key: str = "id") -> DataFrame:
    """Child rows with references to deleted parents set to null."""
    gone = deletes.select(F.col(key).alias("_gone")).distinct()
    joined = child.join(gone, child[column] == gone["_gone"], "left")
    return joined.select(
        *[
            F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == column else F.col(c)
            for c in child.columns
        ]
    )


def delete_with_rules(
    tables: dict[str, DataFrame], name: str, deletes: DataFrame, references: list[Reference] = REFERENCES
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Delete keys from a table and apply every rule that follows from it.

    Keys under a restrict rule are kept. Returns the tables after the delete and
    the refused keys. Rules run along the references, which hold no cycle.
    """
    refused = None
    for rule in references:
        if rule.parent == name and rule.on_delete == "restrict" and rule.child in tables:
            hit = restricted(deletes.select("id"), tables[rule.child], rule.column)
            refused = hit if refused is None else refused.unionByName(hit)
    if refused is None:
        refused = deletes.select("id").filter(F.lit(False))
    refused = refused.distinct()
    allowed = deletes.select("id").join(refused, "id", "left_anti")
    after = dict(tables)
    after[name] = tables[name].join(allowed, "id", "left_anti")
    for rule in references:
        if rule.parent != name or rule.child not in tables:
            continue
        if rule.on_delete == "cascade":
            kept, gone = cascade(after[rule.child], rule.column, allowed)
            after[rule.child] = kept
            if any(r.parent == rule.child for r in references) and "id" in gone.columns:
                after, _ = delete_with_rules({**after, rule.child: kept.unionByName(gone)}, rule.child, gone.select("id"), references)
        elif rule.on_delete == "set_null":
            after[rule.child] = set_null(after[rule.child], rule.column, allowed)
    return after, refused
