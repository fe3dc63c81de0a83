"""Order, limits, newest rows per key, numbering and exact medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage


def newest_first(df: DataFrame, limit: int | None = None, time: str = "created_at", key: str = "id") -> DataFrame:
    """Newest rows first, ties by key; no limit for None or 0.

    With a limit this is a top-k: each task keeps ``limit`` rows.
    """
    ordered = df.orderBy(F.col(time).desc(), F.col(key).desc())
    return ordered.limit(limit) if limit else ordered


def listed(df: DataFrame, limit: int | None = None, ordered: bool = False, time: str = "created_at", key: str = "id") -> DataFrame:
    """A selection as a list, newest first, when a limit or an order is asked for.

    Without either the rows stay as they are: a selection that feeds another step
    needs no sort of all its rows.
    """
    return newest_first(df, limit, time, key) if limit or ordered else df


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` is cut down to one row per key in every map task before
    the shuffle, so a hot key costs one row per task and not its whole group.
    """
    return first_n_per_key(df, keys, order, 1).drop("_rank")


def first_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, with their place in ``_rank``."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n)


def latest_per_key(df: DataFrame, keys: list[str], time: str = "created_at", key: str = "id") -> DataFrame:
    """The newest row of each key, ties by the larger id."""
    return first_per_key(df, keys, [F.col(time).desc(), F.col(key).desc()])


#: Rows that are numbered by one task, about.
BUCKET_ROWS = 100_000


def stable_number(c: Column) -> Column:
    """A value → 32-bit number that is the same in every run (from MD5)."""
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("bigint")


def assign_ids(
    df: DataFrame, unique_key: Column, start: Column | int, name: str = "id", buckets: int | None = None
) -> DataFrame:
    """Number rows from ``start + 1`` without gaps, the same way in every run.

    Rows fall into hash buckets of their unique key; each bucket is numbered on
    its own and shifted by the sizes of the earlier ones, so no task orders more
    than a bucket. By default the rows are counted, and a bucket has about
    ``BUCKET_ROWS`` of them at any size.
    """
    if buckets is None:
        buckets = max(1, -(-df.count() // BUCKET_ROWS))
    first = start if isinstance(start, Column) else F.lit(start)
    keyed = df.withColumns({"_key": unique_key, "_bucket": stable_number(unique_key) % buckets})
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    # At most ``buckets`` rows.
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = keyed.withColumn("_pos", F.row_number().over(W.partitionBy("_bucket").orderBy("_key")))
    return numbered.join(starts, "_bucket").select(
        (first + F.col("_start") + F.col("_pos")).cast("bigint").alias(name),
        *[F.col(c) for c in df.columns if c != name],
    )


def exact_median(df: DataFrame, keys: list[str], value: str, name: str = "median") -> DataFrame:
    """Exact interpolating median of ``value`` per key; nulls are left out.

    Equal values are counted first, so a group costs its distinct values and not
    its rows, and the running count over them can spill. Meant for whole-number
    measures (durations, lengths), whose distinct values are bounded; ``run_median``
    takes any.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    group = W.partitionBy(*keys)
    reached = F.sum("_n").over(group.orderBy(value).rowsBetween(W.unboundedPreceding, 0))
    placed = counts.select(*keys, value, "_n", reached.alias("_to"), F.sum("_n").over(group).alias("_all"))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)

    def holds(place: Column) -> Column:
        return (F.col("_to") > place) & (F.col("_to") - F.col("_n") <= place)

    middle = placed.filter(holds(low) | holds(high))
    return middle.groupBy(*keys).agg(
        ((F.max(F.when(holds(low), F.col(value))) + F.max(F.when(holds(high), F.col(value)))) / 2).alias(name)
    )


#: Ranges a span of values is cut into, and values that are put in order at the end.
MEDIAN_RANGES = 1024
MEDIAN_ROWS = 10_000


def run_median(
    df: DataFrame, keys: list[str], value: str, name: str = "median", ranges: int = MEDIAN_RANGES, few: int = MEDIAN_ROWS
) -> DataFrame:
    """Exact interpolating median of any numbers per key, by counting ranges; nulls and NaN are left out.

    The values of a group are counted by ranges between its smallest and its largest;
    the range that holds the middle is cut again, between its own smallest and
    largest value, until it has few rows or a single value. Each round counts the rows
    that are left before the shuffle, and a task sees at most ``ranges`` counts of a
    group; only the last few values of a group are put in order. The rows left are
    written to the shared folder after each round.
    """
    number = F.col(value).cast("double")
    rows = df.select(*keys, number.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    spans = rows.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_n"))
    # One target per place of the middle: two where the number of values is even.
    places = F.array_distinct(F.array(F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)))
    spans = stage(spans.withColumn("_place", F.explode(places)).withColumn("_before", F.lit(0).cast("bigint")), "spans")
    span_columns = ["_low", "_high", "_n", "_place", "_before"]

    def inside(rows: DataFrame, spans: DataFrame) -> DataFrame:
        return _null_safe_join(rows, spans, keys).filter(F.col("_v").between(F.col("_low"), F.col("_high")))

    while not spans.filter((F.col("_n") > few) & (F.col("_low") < F.col("_high"))).isEmpty():
        # Halves keep the width of a span of huge numbers finite.
        width = F.col("_high") / 2 - F.col("_low") / 2
        part = F.when(width > 0, (F.col("_v") / 2 - F.col("_low") / 2) / width).otherwise(0.0)
        # The largest value is in the last range, so every round parts a span of several values.
        last = (F.col("_v") == F.col("_high")) & (F.col("_low") < F.col("_high"))
        cut = F.when(last, F.lit(ranges - 1)).otherwise(F.least(F.floor(part * ranges), F.lit(ranges - 1))).alias("_range")
        counts = inside(rows, spans).select(*keys, "_place", "_before", "_v", cut)
        counts = counts.groupBy(*keys, "_place", "_before", "_range").agg(
            F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_n")
        )
        reached = F.sum("_n").over(W.partitionBy(*keys, "_place").orderBy("_range")) + F.col("_before")
        placed = counts.withColumn("_to", reached).filter((F.col("_to") > F.col("_place")) & (F.col("_to") - F.col("_n") <= F.col("_place")))
        spans = stage(placed.withColumn("_before", F.col("_to") - F.col("_n")).select(*keys, *span_columns), "spans")
        kept = spans.groupBy(*keys).agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
        rows = stage(inside(rows, kept).select(*keys, "_v"), "middle")

    counts = inside(rows, spans).groupBy(*keys, "_place", "_before", "_v").agg(F.count("*").alias("_n"))
    reached = F.sum("_n").over(W.partitionBy(*keys, "_place").orderBy("_v")) + F.col("_before")
    middle = counts.withColumn("_to", reached).filter((F.col("_to") > F.col("_place")) & (F.col("_to") - F.col("_n") <= F.col("_place")))
    return middle.groupBy(*keys).agg((F.sum("_v") / F.count("_v")).alias(name))


def _null_safe_join(rows: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their group's spans; a null key is a group. One row per key and place on the right."""
    right = spans.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in spans.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return rows.join(right, on).drop(*[f"_key_{k}" for k in keys])


def sample_by_hash(df: DataFrame, key: Column, cap: int = 1000) -> DataFrame:
    """A fixed sample of ``cap`` rows, chosen by the hash of a unique key: the same in every run."""
    return df.orderBy(F.md5(key.cast("string")), key).limit(cap)


def map_blocks(df: DataFrame, keys: list[str], name: str, value: str, width: int = 10_000) -> DataFrame:
    """``{name: value}`` maps per key, in blocks of bounded size.

    A group may be of any size, so it is cut by ``value div width``: with unique
    integer values no map holds more than ``width`` entries, and the blocks of a
    hot group spread over the cluster. ``name`` must be unique within a key.
    """
    block = F.floor(F.col(value) / width).alias("block")
    return df.groupBy(*keys, block).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, value)))).alias("entries")
    )


def id_blocks(df: DataFrame, keys: list[str], id_col: str, width: int = 10_000) -> DataFrame:
    """Sorted id arrays per key, in blocks of at most ``width`` ids (see ``map_blocks``)."""
    block = F.floor(F.col(id_col) / width).alias("block")
    return df.groupBy(*keys, block).agg(F.sort_array(F.collect_list(id_col)).alias("ids"))
