import datetime as dt

from pyspark.sql import functions as F

from sheafline.plans import clean_job, cleaners
from sheafline.streaming import incremental, monitoring

RAW = "id bigint, title string, language_code string, url string, metadata string, created_at timestamp"


def raw_rows(spark, ids, day=1):
    rows = [(i, f"t{i}", "en", None, '{"title": "T", "content": "c [1]"}', dt.datetime(2024, 1, day)) for i in ids]
    return spark.createDataFrame(rows, RAW)


def clean(spark, source, out, mark, done=None):
    cleaner = cleaners.get_cleaner("wikipedia_cleaner", cleaned_at="now")
    stream = incremental.read_files(incremental.state_session(spark), source, raw_rows(spark, [0]).schema, files_per_batch=1)
    query = incremental.start_clean(stream, out, mark, cleaner, 1, clean_job.ARTICLE_SCHEMA["schema"], "2024-02-01", done=done)
    query.awaitTermination()
    return query, sorted(r.raw_data_id for r in spark.read.parquet(out).collect())


def done_rows(spark, *ids, version="1.0.0"):
    return spark.createDataFrame([("wikipedia_cleaner", version, i) for i in ids], "cleaner_used string, cleaner_version string, raw_data_id bigint")


def test_incremental_clean_is_repeat_safe(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    done = done_rows(spark, 3).unionByName(done_rows(spark, 1, version="0.9.0"))
    raw_rows(spark, [1, 2, 3]).coalesce(1).write.parquet(source)
    assert clean(spark, source, out, mark, done)[1] == [1, 2]
    assert clean(spark, source, out, mark, done)[1] == [1, 2]
    raw_rows(spark, [2, 3, 4], day=3).coalesce(1).write.mode("append").parquet(source)
    assert clean(spark, source, out, mark, done)[1] == [1, 2, 4]
    # Rows other jobs have done in the meantime, in the batch of their seeds and in a later one.
    for ids in ([5, 6], [5, 7]):
        raw_rows(spark, ids, day=4).coalesce(1).write.mode("append").parquet(source)
    assert clean(spark, source, out, mark, done_rows(spark, 3, 5))[1] == [1, 2, 4, 6, 7]
    raw_rows(spark, [3, 5, 8], day=5).coalesce(1).write.mode("append").parquet(source)
    assert clean(spark, source, out, mark)[1] == [1, 2, 4, 6, 7, 8]
    assert sorted(r.id for r in spark.read.parquet(out + "_seeds").collect()) == [3, 5]


def test_a_batch_that_is_run_again_replaces_itself(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    for ids in ([1, 2], [2, 3]):
        raw_rows(spark, ids).coalesce(1).write.mode("append").parquet(source)
        clean(spark, source, out, mark)
    last = max((tmp_path / "mark" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    last.unlink()
    assert clean(spark, source, out, mark)[1] == [1, 2, 3]


def test_older_files_that_land_later_are_cleaned_without_reading_what_was_written(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("raw", "out", "mark"))
    for ids, day in (([1, 2], 10), ([3, 4, 1], 1), ([5], 11), ([2, 6], 1)):
        raw_rows(spark, ids, day).coalesce(1).write.mode("append").parquet(source)
        query, found = clean(spark, source, out, mark)
    assert found == [1, 2, 3, 4, 5, 6]
    progress = query.lastProgress
    assert {s["description"].split("[")[-1].rstrip("]").split("/")[-1] for s in progress["sources"]} == {"raw", "out_seeds"}
    state = progress["stateOperators"][0]
    assert state["numRowsTotal"] == 6 and any(m.startswith("rocksdb") for m in state["customMetrics"])


def test_rows_are_dealt_by_size(spark, tmp_path):
    rows = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("target"), F.md5(F.col("id").cast("string")).alias("text"))
    dealt = incremental.clustered(rows, ["target"])
    assert "RebalancePartitions" in dealt._jdf.queryExecution().optimizedPlan().toString()
    # A part is split by the tasks that wrote to it, so there must be several.
    rows.write.parquet(str(tmp_path / "in"))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)

    def files(folder, target):
        return spark.read.parquet(str(tmp_path / folder)).filter(F.col("target") == target).select(F.input_file_name()).distinct().count()

    try:
        spark.conf.set(advisory, "500k")
        dealt.write.parquet(str(tmp_path / "once"))
        stream = incremental.read_files(spark, str(tmp_path / "in"), rows.schema)
        incremental.start_sink(stream, str(tmp_path / "out"), str(tmp_path / "mark"), ["target"]).awaitTermination()
    finally:
        spark.conf.set(advisory, before)
    for folder in ("once", "out/rows"):
        assert files(folder, 1) > 1
    counts = {r.target: r.saved_count for r in spark.read.parquet(str(tmp_path / "out/counts")).collect()}
    assert sum(counts.values()) == 200_000 and len(counts) == 50


def test_windows_on_stream_equal_batch_with_late_rows(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("ev", "out", "mark"))
    schema = "id bigint, status string, duration bigint, created_at timestamp"
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    files = [
        [(1, "failed", 5, at(0, 10)), (2, "success", 7, at(0, 20)), (3, "failed", 9, at(5, 0))],
        [(5, "success", 1, at(9, 0))],
        [(4, "failed", 100, at(0, 30)), (6, "pending", None, at(0, 40))],
    ]
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_files(spark, source, spark.createDataFrame(rows, schema).schema, files_per_batch=1)
        monitoring.start_status_windows(stream, out, mark, "status", "duration").awaitTermination()

    def figures(frame):
        return {(r.window_start, r.window_end, r.status): (r.event_count, r.failed_count, r.avg_duration) for r in frame.collect()}

    batch = monitoring.status_windows(spark.createDataFrame(sum(files, []), schema), "status", "duration")
    assert figures(monitoring.window_figures(spark.read.parquet(out))) == figures(batch)


def test_newest_row_per_target(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("ev", "out", "mark"))
    schema = "id bigint, target bigint, status string, created_at timestamp"
    at = lambda h: dt.datetime(2024, 1, 1, h)
    files = [[(1, 7, "a", at(1)), (2, 8, "b", at(2)), (9, 8, "b2", at(2))], [(3, 7, "c", at(3)), (4, 8, "old", at(0))]]
    for n, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_files(spark, source, spark.createDataFrame(rows, schema).schema, files_per_batch=1)
        monitoring.start_newest_rows(stream, out, mark, "target").awaitTermination()
    state = monitoring.newest_state(spark, out, "target")
    assert {r.target: (r.id, r.status) for r in state.collect()} == {7: (3, "c"), 8: (9, "b2")}


def test_newest_state_reads_the_last_base_and_later_changes(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("ev", "out", "mark"))
    schema = "id bigint, target bigint, status string, created_at timestamp"
    want = {}
    for n in range(7):
        rows = [(n, n % 3, f"s{n}", dt.datetime(2024, 1, 1, n))]
        want[n % 3] = (n, f"s{n}")
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_files(spark, source, spark.createDataFrame(rows, schema).schema, files_per_batch=1)
        monitoring.start_newest_rows(stream, out, mark, "target", base_every=3).awaitTermination()
        state = monitoring.newest_state(spark, out, "target")
        assert {r.target: (r.id, r.status) for r in state.collect()} == want
    assert sorted(r.upto for r in spark.read.parquet(f"{out}/marks").collect()) == [-1, 2, 5]
    # Only the base after batch 5 and batch 6 are read.
    read = {f.split("/out/")[1].rsplit("/", 1)[0] for f in state.inputFiles()}
    assert "base/upto=5" in read and not any(f.startswith("base/") and f != "base/upto=5" for f in read)
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan and "> 5)" in plan
    # A base that is made again after its mark is the same.
    again = monitoring.newest_state(spark, out, "target", before=5)
    assert {r.target: r.id for r in again.collect()} == {0: 6, 1: 4, 2: 5}


def test_sink_writes_each_batch_once(spark, tmp_path):
    batch = spark.range(5).select("id", (F.col("id") % 2).alias("k"))
    incremental.write_batch_once(batch, str(tmp_path / "o"), 0)
    incremental.write_batch_once(batch, str(tmp_path / "o"), 0)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5
