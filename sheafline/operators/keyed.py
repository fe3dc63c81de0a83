"""Tables dealt into folders by a hash of their key, changed folder by folder.

A set of changes hits the folders its keys fall into; only these are read and
written, the others keep their files. Which folders are hit is one small number per
key at most, and never more numbers than there are folders.

A change has a name and happens in two steps. The new rows of the hit folders are
written beside the table, with a mark behind them; then they replace the
folders. A job that stops before the mark starts anew from the untouched table. One
that stops behind it is finished from the written rows by asking for the same change
again, and a change that was made already is not made twice.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stage
from .maintenance import delete_keys, first_of_batch, merge_update

BUCKET = "key_bucket"
_MARK = "affected bigint, buckets array<int>, schema string"


@dataclass(frozen=True)
class KeyedTable:
    """Where a table lies, its key, and the number of folders, which must stay the same."""

    path: str
    key: str = "id"
    buckets: int = 256

    def bucket(self, key: str | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(key or self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def changes(self, name: str) -> str:
        return f"{self.path.rstrip('/')}_changes/{name}"


def write_keyed(rows: DataFrame, table: KeyedTable) -> None:
    """Write a new table; folders are cut by size, so none is a task of its own however large."""
    dealt = rows.withColumn(BUCKET, table.bucket()).hint("rebalance", BUCKET)
    dealt.write.mode("errorifexists").partitionBy(BUCKET).parquet(table.path)


def read_keyed(spark: SparkSession, table: KeyedTable, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a table, or of some of its folders."""
    rows = spark.read.parquet(table.path)
    return (rows if buckets is None else rows.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)


def run_merge(
    spark: SparkSession, table: KeyedTable, updates: DataFrame, columns: list[str], change: str, order: list[Column] | None = None
) -> int:
    """Set ``columns`` for the keys in ``updates`` and return how many rows were changed.

    Null can be set. Of repeated keys the first in ``order`` is used; without an order
    keys must be unique, and a repeated one is an error.
    """
    new = updates.select(table.key, *columns)
    if order is None:
        many = F.raise_error(F.concat(F.lit("repeated key without an order: "), F.col(table.key).cast("string")))
        one = new.groupBy(table.key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in columns])
        new = one.withColumn(table.key, F.when(F.col("_n") > 1, many.cast(new.schema[table.key].dataType)).otherwise(F.col(table.key))).drop("_n")
    else:
        new = first_of_batch(updates, [table.key], order).select(table.key, *columns)

    def merged(rows: DataFrame, changes: DataFrame) -> DataFrame:
        return merge_update(rows, changes, table.key, columns, unique=True)

    return _run(spark, table, new, change, merged)


def run_status(spark: SparkSession, table: KeyedTable, keys: DataFrame, status_col: str, status_id: int, change: str) -> int:
    """Set one status for a set of keys (repeats allowed) and return how many rows were changed."""
    ids = keys.select(table.key).distinct().withColumn(status_col, F.lit(status_id).cast("bigint"))
    return _run(spark, table, ids, change, lambda rows, new: merge_update(rows, new, table.key, [status_col], unique=True))


def run_delete(spark: SparkSession, table: KeyedTable, keys: DataFrame, change: str) -> int:
    """Delete the rows of a set of keys (repeats allowed) and return how many went."""
    gone = keys.select(table.key).distinct()
    return _run(spark, table, gone, change, lambda rows, ids: delete_keys(rows, ids, table.key))


def _run(spark: SparkSession, table: KeyedTable, keyed: DataFrame, change: str, apply) -> int:
    """Prepare a change unless it is marked as prepared, put it in place, and return the rows it is about."""
    folder = table.changes(change)
    mark = _marked(spark, folder, "prepared")
    if mark is None:
        mark = _prepare(spark, table, stage(keyed, "changes"), folder, apply)
    if _marked(spark, folder, "placed") is None:
        _place(spark, table, folder, mark)
        _set_mark(spark, folder, "placed", mark)
    return mark["affected"]


def _prepare(spark: SparkSession, table: KeyedTable, keyed: DataFrame, folder: str, apply) -> dict:
    # At most table.buckets numbers.
    hit = sorted(r[0] for r in keyed.select(table.bucket()).distinct().collect())
    rows = read_keyed(spark, table, hit)
    affected = rows.join(keyed.select(table.key), table.key, "left_semi").count()
    new = apply(rows, keyed).select(*rows.columns).withColumn(BUCKET, table.bucket()).hint("rebalance", BUCKET)
    new.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{folder}/rows")
    return _set_mark(spark, folder, "prepared", {"affected": affected, "buckets": hit, "schema": new.schema.json()})


def _place(spark: SparkSession, table: KeyedTable, folder: str, mark: dict) -> None:
    rows = spark.read.schema(StructType.fromJson(json.loads(mark["schema"]))).parquet(f"{folder}/rows")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(table.path)
    # A folder that lost all its rows is not among those written.
    filled = {r[0] for r in rows.select(BUCKET).distinct().collect()}
    for bucket in sorted(set(mark["buckets"]) - filled):
        rows.drop(BUCKET).limit(0).write.mode("overwrite").parquet(f"{table.path.rstrip('/')}/{BUCKET}={bucket}")


def _set_mark(spark: SparkSession, folder: str, step: str, mark: dict) -> dict:
    spark.createDataFrame([mark], _MARK).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{step}")
    return mark


def _marked(spark: SparkSession, folder: str, step: str) -> dict | None:
    try:
        row = spark.read.schema(_MARK).parquet(f"{folder}/{step}").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row.asDict() if row else None
