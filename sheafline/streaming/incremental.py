"""Repeat-safe incremental jobs: new files in, cleaned or collected rows out."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.lookups import not_cleaned
from ..plans.clean_job import checked_rows
from ..plans.cleaners import Cleaner


def state_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one whose streams keep their state in RocksDB: on disk, not in the heap."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return own


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder (or a glob) as a stream, a bounded number per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def write_batch_once(batch: DataFrame, folder: str, batch_id: int) -> None:
    """Write one micro-batch to a folder of its own; a repeated batch replaces itself."""
    batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch_id={batch_id}")


_SEED = "id bigint"


def _seed(spark: SparkSession, done: DataFrame | None, cleaner: Cleaner, seeds: str) -> None:
    """Write the keys of ``done`` that no earlier run has written."""
    spark.createDataFrame([], _SEED).write.mode("ignore").parquet(seeds)
    if done is None:
        return
    own = done.filter((F.col("cleaner_used") == cleaner.name) & (F.col("cleaner_version") == cleaner.version))
    keys = own.select(F.col("raw_data_id").cast("bigint").alias("id")).distinct()
    new = keys.join(spark.read.schema(_SEED).parquet(seeds), "id", "left_anti")
    if not new.isEmpty():
        new.write.mode("append").parquet(seeds)


def start_clean(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    cleaner: Cleaner,
    schema_id: int,
    schema: dict,
    as_of: str,
    done: DataFrame | None = None,
    seeds: str | None = None,
) -> StreamingQuery:
    """Clean raw rows as their files arrive and stop when all are read.

    A row is cleaned once, however late it comes: the stream's own state holds the
    ids met so far, without a watermark, so a batch looks up its own ids and
    reads nothing that earlier batches wrote. Of repeated ids in one batch any row
    is cleaned; rows without an id count as one id.

    ``done`` are rows cleaned by other jobs. Their ids come in once, as a second
    source beside the raw files (``seeds``, by default ``out`` with ``_seeds``), and
    are state from then on. All new ones are in the first batch of a run, where a raw
    row may stand beside its own seed; only this batch is compared with ``done``
    itself.

    The state grows by one id per row and is kept where the session says:
    ``state_session`` gives one that keeps it in RocksDB. Batches are numbered by the
    checkpoint, and one output folder belongs to one checkpoint; a batch that is run
    again starts from the state before it and replaces its own rows.
    """
    spark = raw.sparkSession
    seeds = seeds or f"{out.rstrip('/')}_seeds"
    _seed(spark, done, cleaner, seeds)
    known = spark.readStream.schema(_SEED).parquet(seeds).withColumn("_known", F.lit(True))
    both = raw.withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True)
    beside_seeds = [done] if done is not None else []

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = batch.filter(~F.col("_known")).drop("_known")
        for cleaned in beside_seeds:
            rows = not_cleaned(rows, cleaned, cleaner.name, cleaner.version)
        write_batch_once(checked_rows(rows, cleaner, schema_id, schema, as_of), out, batch_id)
        beside_seeds.clear()

    return (
        both.dropDuplicates(["id"])
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_sink(records: DataFrame, out: str, checkpoint: str, keys: list[str]) -> StreamingQuery:
    """Incremental sink: each micro-batch is written once, clustered by target and language.

    Rows are dealt by their keys and then by size: a hot key is split over several
    files, small keys share one. The batch's counts per key go beside it, for the
    outcome of each target.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            write_batch_once(clustered(batch, keys), f"{out}/rows", batch_id)
        written = batch.sparkSession.read.parquet(f"{out}/rows/batch_id={batch_id}")
        write_batch_once(written.groupBy(*keys).agg(F.count("*").alias("saved_count")), f"{out}/counts", batch_id)

    return (
        records.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for a write inside a micro-batch.

    A stream runs in a copy of its session with adaptive execution off, since the
    number of partitions of its state is fixed. What is done with the rows of a batch
    has no state; the copy's setting is put back for the next batch.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def clustered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows dealt by ``keys`` into parts of about the session's advisory size, for a write.

    Adaptive execution measures the parts: it splits a large one, also if it is one
    key, and joins small ones.
    """
    return rows.hint("rebalance", *keys)
