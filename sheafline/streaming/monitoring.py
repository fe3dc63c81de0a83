"""Running figures over attempts and checks: windows that take rows of any age, and the newest row per target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .incremental import write_batch_once


def status_windows(events: DataFrame, status: str, duration: str, time: str = "created_at", width: str = "1 hour") -> DataFrame:
    """Count, failures and mean duration per (window, status). The same on batch and stream."""
    return (
        events.groupBy(F.window(time, width), F.col(status).alias("status"))
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(F.col(status) == "failed").alias("failed_count"),
            F.avg(duration).alias("avg_duration"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "status", "event_count", "failed_count", "avg_duration")
    )


def window_parts(events: DataFrame, status: str, duration: str, time: str = "created_at", width: str = "1 hour") -> DataFrame:
    """Sums per (window, status) that can be added up over any parts of the events."""
    return (
        events.groupBy(F.window(time, width), F.col(status).alias("status"))
        .agg(
            F.count("*").alias("event_count"),
            F.count_if(F.col(status) == "failed").alias("failed_count"),
            F.sum(duration).alias("duration_sum"),
            F.count(duration).alias("duration_count"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "status", "event_count", "failed_count", "duration_sum", "duration_count")
    )


def window_figures(parts: DataFrame) -> DataFrame:
    """The figures of ``status_windows`` from the parts written so far."""
    sums = [F.sum(c).alias(c) for c in ("event_count", "failed_count", "duration_sum", "duration_count")]
    added = parts.groupBy("window_start", "window_end", "status").agg(*sums)
    mean = F.when(F.col("duration_count") > 0, F.col("duration_sum") / F.col("duration_count"))
    return added.withColumn("avg_duration", mean).drop("duration_sum", "duration_count")


def start_status_windows(
    events: DataFrame, out: str, checkpoint: str, status: str, duration: str, time: str = "created_at", width: str = "1 hour"
) -> StreamingQuery:
    """Write the sums of each micro-batch; ``window_figures`` adds them up.

    No event is too late: a batch writes a part for every window it has rows of, and
    no window has to be closed. The parts of a batch that is run again replace its
    own.
    """
    return (
        events.writeStream.foreachBatch(
            lambda batch, batch_id: write_batch_once(window_parts(batch, status, duration, time, width), out, batch_id)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_rows(events: DataFrame, key: str, time: str = "created_at", row_id: str = "id") -> DataFrame:
    """The newest row of each key as a running aggregate (ties by the larger id)."""
    columns = [c for c in events.columns if c != key]
    newest = F.max_by(F.struct(*columns), F.struct(time, row_id)).alias("_row")
    return events.groupBy(key).agg(newest).select(key, "_row.*")


def start_newest_rows(
    events: DataFrame, out: str, checkpoint: str, key: str, time: str = "created_at", row_id: str = "id", base_every: int = 50
) -> StreamingQuery:
    """Keep the newest row per key as state; each micro-batch writes the keys that changed.

    After every ``base_every`` batches the whole state is written too, from the base
    before and the changes since. ``newest_state`` reads the last base and the changes
    behind it, so it never folds more than that many batches. A base counts once its
    mark is written; a batch that is run again replaces its changes, base and mark.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            write_base(batch.limit(0), spark, out, -1, 0)
        write_batch_once(batch, f"{out}/changes", batch_id)
        if (batch_id + 1) % base_every == 0:
            write_base(newest_state(spark, out, key, batch_id), spark, out, batch_id, batch_id)

    return (
        newest_rows(events, key, time, row_id)
        .writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_base(state: DataFrame, spark: SparkSession, out: str, upto: int, batch_id: int) -> None:
    """Write the state after batch ``upto`` and then its mark, under the batch that writes them."""
    state.write.mode("overwrite").parquet(f"{out}/base/upto={upto}")
    mark = spark.range(1).select(F.lit(upto).cast("bigint").alias("upto"))
    mark.write.mode("overwrite").parquet(f"{out}/marks/by={batch_id if upto >= 0 else 'start'}")


def newest_state(spark: SparkSession, out: str, key: str, before: int | None = None) -> DataFrame:
    """Current row per key: the last base (of a batch ahead of ``before``, if given) and the changes behind it."""
    marks = spark.read.schema("upto bigint").parquet(f"{out}/marks")
    if before is not None:
        marks = marks.filter(F.col("upto") < before)
    # One row per base.
    upto = marks.agg(F.max("upto")).first()[0]
    base = spark.read.parquet(f"{out}/base/upto={upto}").withColumn("batch_id", F.lit(upto).cast("bigint"))
    changes = spark.read.schema(base.schema).option("basePath", f"{out}/changes").parquet(f"{out}/changes")
    return latest_state(base.unionByName(changes.filter(F.col("batch_id") > upto)), key)


def latest_state(changes: DataFrame, key: str) -> DataFrame:
    """Current row per key from written changes: the one of the last batch that changed it."""
    columns = [c for c in changes.columns if c not in (key, "batch_id")]
    last = F.max_by(F.struct(*columns), "batch_id").alias("_row")
    return changes.groupBy(key).agg(last).select(key, "_row.*")
