"""Table readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("csv", "json", "parquet", "orc")


def read_table(spark: SparkSession, location: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path. Nothing is collected."""
    if "/" not in location:
        return spark.table(location)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(location)


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Save a catalog table dealt by a hash of its key, and sorted by it inside each bucket.

    Tables dealt by the same key into the same number of buckets are joined without a
    shuffle on either side. Rows are brought together by bucket first, so a bucket is
    one file per write and not one per task.
    """
    writer = df.repartition(buckets, key).write.format("parquet").mode("errorifexists").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_table(df: DataFrame, location: str) -> None:
    """Append rows to a catalog table by name, in its own buckets, or to a Parquet folder by path."""
    if "/" in location:
        df.write.mode("append").parquet(location)
    else:
        df.select(*df.sparkSession.table(location).columns).write.insertInto(location)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a table scan over all cores when it comes in fewer splits than there are cores.

    For costly work per row on a table of few files. A scan with enough splits,
    as any large one has, is returned as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


def dealt_finely(scan: DataFrame, *keys: str) -> DataFrame:
    """Deal a table scan by ``keys`` into parts far smaller than its splits, when there are splits for all cores.

    For work that holds many keys in memory, as ``distinct`` does. The parts are eight to
    a split, and a split has a largest size, so the rows of a task stop growing with the
    table; adaptive execution does not join parts of a given number. A smaller table is
    left as it is.
    """
    splits = scan.rdd.getNumPartitions()
    return scan.repartition(8 * splits, *keys) if splits >= scan.sparkSession.sparkContext.defaultParallelism else scan


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a table schema; columns that are absent become null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(field.name) if field.name in present else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in schema.fields
        ]
    )


def output_format(wanted: str) -> str:
    """The format to write; an unknown one falls back to csv."""
    name = wanted.lower()
    return name if name in FORMATS else "csv"


def write_records(records: DataFrame, data_type: str, base: str, stamp: str, file_format: str = "csv") -> str | None:
    """Write records once to ``base/{data_type}_{stamp}``; an empty input writes nothing.

    Returns the folder, or None when there was nothing to write. ``errorifexists``
    keeps an earlier result. Array, map and struct columns become JSON text in csv.
    """
    if records.isEmpty():
        return None
    chosen = output_format(file_format)
    folder = f"{base.rstrip('/')}/{data_type}_{stamp}"
    if chosen == "csv":
        records = records.select(
            *[
                F.to_json(F.col(f"`{f.name}`")).alias(f.name)
                if f.dataType.typeName() in ("array", "map", "struct", "variant")
                else F.col(f"`{f.name}`")
                for f in records.schema.fields
            ]
        )
    writer = records.write.format(chosen).mode("errorifexists")
    if chosen == "csv":
        # Quotes are doubled and line breaks stay inside quotes, so whole texts survive.
        writer = writer.option("header", True).option("escape", '"')
    writer.save(folder)
    return folder
