import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheafline.operators.trailing import trailing_means, trailing_means_by_days, with_blocks

WINDOWS = {"m7": 7, "m30": 30}


@pytest.fixture(scope="module")
def polls(spark):
    # Group "hot" holds most rows, and one of its days alone more than a block.
    n = F.col("id")
    group = F.when(n % 5 < 4, "hot").otherwise(F.concat(F.lit("g"), n % 7))
    day = F.when((n % 5 < 4) & (n % 3 == 0), 17).otherwise((n * 7919) % 60)
    return spark.range(6000).select(n.alias("row_id"), group.alias("g"), day.cast("bigint").alias("day"), ((n * 104729) % 97).cast("double").alias("x")).persist()


@pytest.mark.parametrize("block_rows", [50, 400, 1_000_000])
def test_cut_groups_equal_one_window(polls, block_rows):
    w = W.partitionBy("g").orderBy("day", "row_id")
    want = polls.withColumns({k: F.avg("x").over(w.rowsBetween(-(n - 1), 0)) for k, n in WINDOWS.items()})
    got = trailing_means(polls, ["g"], "day", "row_id", "x", WINDOWS, block_rows=block_rows)
    joined = got.alias("a").join(want.alias("b"), "row_id")
    bad = joined.filter((F.abs(F.col("a.m7") - F.col("b.m7")) > 1e-9) | (F.abs(F.col("a.m30") - F.col("b.m30")) > 1e-9))
    assert got.count() == polls.count() and joined.count() == 6000 and bad.count() == 0


def test_blocks_are_bounded_by_the_data_and_not_by_its_ids(spark, polls):
    # Nearly all ids of the hot group lie close together and one lies far away.
    far = polls.withColumn("row_id", F.when(F.col("row_id") == 5, F.lit(10**15)).otherwise(F.col("row_id")))
    blocks = with_blocks(far, ["g"], ["day", "row_id"], 100)
    sizes = blocks.groupBy("_block").agg(F.count("*").alias("n"), F.min(F.struct("g", "day", "row_id")).alias("low"), F.max(F.struct("g", "day", "row_id")).alias("high"))
    rows = sizes.orderBy("_block").collect()
    assert max(r.n for r in rows) <= 200 and sum(r.n for r in rows) == 6000 and len(rows) >= 40
    assert all(tuple(a.high) < tuple(b.low) for a, b in zip(rows, rows[1:]))
    # The largest group, and its largest day, lie in several blocks.
    assert blocks.filter("g = 'hot' AND day = 17").select("_block").distinct().count() > 1


def test_far_ids_and_null_groups_equal_one_window(spark, polls):
    odd = polls.withColumns({"row_id": F.when(F.col("row_id") == 5, F.lit(10**15)).otherwise(F.col("row_id")), "g": F.when(F.col("g") != "hot", F.col("g"))})
    w = W.partitionBy("g").orderBy("day", "row_id")
    want = odd.withColumn("m", F.avg("x").over(w.rowsBetween(-6, 0)))
    got = trailing_means(odd, ["g"], "day", "row_id", "x", {"m": 7}, block_rows=150)
    assert got.count() == 6000
    bad = got.alias("a").join(want.alias("b"), "row_id").filter(F.abs(F.col("a.m") - F.col("b.m")) > 1e-9)
    assert bad.count() == 0


def test_the_source_is_read_once(spark, polls, tmp_path):
    polls.write.parquet(str(tmp_path / "p"))
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.read.parquet(str(tmp_path / "p"))
    counted = source.mapInArrow(touch, source.schema)
    assert trailing_means(counted, ["g"], "day", "row_id", "x", WINDOWS, block_rows=500).count() == 6000
    assert seen.value == 6000


def test_means_by_days(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 1, 20.0), ("a", 9, 40.0), ("a", 7, 30.0)], "g string, day bigint, x double")
    got = {(r.day, r.x): r.m for r in trailing_means_by_days(df, ["g"], "day", "x", {"m": 7}).collect()}
    assert got == {(1, 10.0): 15.0, (1, 20.0): 15.0, (7, 30.0): 20.0, (9, 40.0): 35.0}


def test_small_blocks_share_the_parts_of_the_shuffle(spark, polls):
    # One part of the shuffle a block would be 6000 tasks here, and 120,000 for 36 million rows in blocks of 300.
    before = spark._jsc.sc().dagScheduler().nextStageId()
    blocks = with_blocks(polls, ["g"], ["day", "row_id"], 1)
    stages = range(before, spark._jsc.sc().dagScheduler().nextStageId())
    infos = [spark.sparkContext.statusTracker().getStageInfo(s) for s in stages]
    assert max(i.numTasks for i in infos if i) <= 2 * spark.sparkContext.defaultParallelism
    assert blocks.select("_block").distinct().count() == 6000


@pytest.mark.parametrize("block_rows", [1, 3])
def test_windows_reach_over_several_blocks_and_equal_rows(spark, polls, block_rows):
    # Rows that are equal but for their value, and windows longer than a block.
    odd = polls.filter("row_id < 600").withColumn("row_id", F.floor(F.col("row_id") / 4))
    w = W.partitionBy("g").orderBy("day", "row_id", "x")
    want = odd.withColumns({k: F.round(F.avg("x").over(w.rowsBetween(-(n - 1), 0)), 9) for k, n in WINDOWS.items()})
    got = trailing_means(odd, ["g"], "day", "row_id", "x", WINDOWS, block_rows=block_rows)
    got = got.withColumns({k: F.round(k, 9) for k in WINDOWS}).select(*want.columns)
    assert got.count() == 600 and got.exceptAll(want).count() == 0
    alone = trailing_means(odd, ["g"], "day", "row_id", "x", {"m1": 1}, block_rows=block_rows)
    assert alone.filter("m1 = x").count() == 600
