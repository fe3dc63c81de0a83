"""Trailing means over row windows, for groups of any size.

A row window needs its group in order, and one group may hold a third of all
rows. So all rows are dealt by range of (group, day, id) into parts, with cuts that
Spark takes from a sample of the data itself, and each part is cut in order into
blocks of equal size. Parts are as many as a shuffle bears, however small the blocks
are. Each block is given the few rows that come just before it in its group, and the
window runs per group and block. The result is that of one window over the whole group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage


#: Rows of a part of several blocks, and parts a core, so that a small table fills the cores as well.
PART_ROWS = 250_000
PARTS_A_CORE = 2


def with_blocks(df: DataFrame, keys: list[str], order: list[str], block_rows: int) -> DataFrame:
    """``df`` with ``_block``: a cut of its rows in the order of ``keys`` and ``order`` into at most about ``block_rows`` rows.

    The source is evaluated once; the cuts come from a sample of what it gave. Blocks
    are numbered in that order, with gaps. Small blocks share a part of the shuffle.
    """
    rows = stage(df, "rows")
    count = rows.count()
    blocks = max(1, -(-count // block_rows))
    parts = min(blocks, max(-(-count // PART_ROWS), PARTS_A_CORE * df.sparkSession.sparkContext.defaultParallelism))
    by = list(dict.fromkeys([*keys, *order]))
    dealt = rows.repartitionByRange(parts, *by)
    if parts == blocks:
        return stage(dealt.withColumn("_block", F.spark_partition_id().cast("bigint")), "blocks")
    # The place holds the part in its upper bits and the row within the part in the lower 33.
    place = F.monotonically_increasing_id()
    cut = dealt.sortWithinPartitions(*by).withColumn("_place", place)
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return stage(cut.withColumn("_block", F.col("_place") - row + F.floor(row / block_rows)).drop("_place"), "blocks")


def trailing_means(
    df: DataFrame,
    keys: list[str],
    day: str,
    row_id: str,
    value: str,
    windows: dict[str, int],
    tie: list[str] | None = None,
    block_rows: int = 1_000_000,
) -> DataFrame:
    """Add the mean of ``value`` over the last ``n`` rows for each ``{name: n}`` of ``windows``.

    Rows are ordered by ``day``, ``row_id`` and the ``tie`` columns within ``keys``. The
    rows are written to the shared folder, once as they come and once in blocks.
    """
    # With the value last, rows that are equal in all of these can stand for each other.
    carried_cols = list(dict.fromkeys([day, row_id, *(tie or []), value]))
    longest = max(windows.values())
    blocked = with_blocks(df, keys, carried_cols, block_rows)
    order = [F.col(c).asc() for c in carried_cols]

    # Per group and block (few rows): the blocks that come next, as far as a window reaches back from
    # their first row, each with the rows that lie between. A block has a row at least.
    in_group = W.partitionBy(*keys).orderBy("_block")
    sizes = blocked.groupBy(*keys, "_block").agg(F.count("*").alias("_rows")).withColumn("_end", F.sum("_rows").over(in_group))
    later = F.collect_list(F.struct(F.col("_block").alias("block"), (F.col("_end") - F.col("_rows")).alias("start")))
    ends = sizes.withColumn("_later", later.over(in_group.rowsBetween(1, max(1, longest - 1))))
    near = F.filter("_later", lambda n: n["start"] - F.col("_end") < longest - 1)
    ends = ends.select(*keys, "_block", "_end", near.alias("_later")).filter(F.size("_later") > 0)

    # The last rows of every block (cut down in each map task before the shuffle) go to those blocks.
    backwards = W.partitionBy(*keys, "_block").orderBy(*[F.col(c).desc() for c in carried_cols])
    slim = blocked.select(*dict.fromkeys([*keys, "_block", *carried_cols]))
    tails = slim.withColumn("_back", F.row_number().over(backwards)).filter(F.col("_back") < longest)
    same_block = [F.col(f"r.{k}").eqNullSafe(F.col(f"e.{k}")) for k in [*keys, "_block"]]
    tail_cols = [c for c in tails.columns if c != "_block"]
    carried = (
        tails.alias("r").join(ends.alias("e"), same_block)
        .select(*[F.col(f"r.{c}") for c in tail_cols], "_end", F.explode("_later").alias("_to"))
        .filter(F.col("_to.start") - F.col("_end") + F.col("_back") < longest)
        .select(*[c for c in tail_cols if c != "_back"], F.col("_to.block").alias("_block"), F.lit(True).alias("_carried"))
    )

    rows = blocked.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    in_block = W.partitionBy(*keys, "_block").orderBy(F.col("_carried").desc(), *order)
    means = {name: F.avg(value).over(in_block.rowsBetween(-(n - 1), 0)) for name, n in windows.items()}
    return rows.withColumns(means).filter(~F.col("_carried")).drop("_carried", "_block")


def trailing_means_by_days(
    df: DataFrame, keys: list[str], day: str, value: str, windows: dict[str, int]
) -> DataFrame:
    """The same over whole days: mean of all values at most ``n - 1`` days before.

    Sums per (group, day) are taken first, so the window runs over days.
    """
    daily = df.groupBy(*keys, day).agg(F.sum(value).alias("_sum"), F.count(value).alias("_count"))
    order = W.partitionBy(*keys).orderBy(day)
    means = {
        name: F.sum("_sum").over(order.rangeBetween(-(n - 1), 0)) / F.sum("_count").over(order.rangeBetween(-(n - 1), 0))
        for name, n in windows.items()
    }
    return df.join(daily.withColumns(means).drop("_sum", "_count"), [*keys, day])
