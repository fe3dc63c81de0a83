import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sheafline import vocab
from sheafline.operators import integrity, lookups, maintenance as mt, ordering, resolve, selectors, statistics as st
from sheafline.plans import clean_job, cleaners, collect_job
from sheafline.sources import tables


@pytest.mark.parametrize(
    "spec, want",
    [
        ("11", [(11, 11)]),
        ("1-3, 5", [(1, 3), (5, 5)]),
        ("1-2-3, 4", [(4, 4)]),
        ("9-2,7", [(7, 7)]),
        ("1-3, x", []),
        ("a-3, 5", []),
        ("-5", []),
        ("x", []),
        (" 2 , 2", [(2, 2), (2, 2)]),
    ],
)
def test_id_specs(spec, want):
    assert selectors.parse_id_spec(spec) == want


def test_selections(spark):
    df = spark.range(10).withColumn("created_at", F.lit("2024-01-01").cast("timestamp") + F.col("id") * F.make_dt_interval(hours=F.lit(1)))
    ids = lambda d: [r.id for r in d.collect()]
    assert ids(selectors.by_ids(df, [])) == [] and ids(selectors.by_ids(df, [3, 3, 99])) == [3]
    assert sorted(ids(selectors.by_ids(df, list(range(5, 2000))))) == [5, 6, 7, 8, 9]
    assert ids(selectors.select_ids(df, "x")) == []
    assert ids(selectors.recent(df, 2, "2024-01-01 09:00:00", ordered=True)) == [9, 8, 7]
    assert ids(selectors.recent(df, 5, "2024-01-01 09:00:00", limit=2)) == [9, 8]
    assert ids(ordering.newest_first(df, 3)) == [9, 8, 7] and len(ids(ordering.newest_first(df, 0))) == 10


def test_status_names_and_unknowns(spark):
    statuses = vocab.lookup(spark, vocab.VALIDATION_STATUSES)
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 77)], "id bigint, validation_status_id bigint")
    named = lookups.with_name(rows, statuses, "validation_status_id", "name", missing="unknown")
    assert {r.id: r.name for r in named.collect()} == {1: "valid", 2: "invalid", 3: "unknown", 4: "unknown"}
    counts = {r.status_name: (r.record_count, r.percentage) for r in st.status_counts(rows, statuses).collect()}
    assert counts == {"valid": (1, 25.0), "invalid": (1, 25.0)}
    usage = {r.name: r.usage_count for r in lookups.usage_counts(statuses, rows, "validation_status_id").collect()}
    assert usage["pending"] == 0 and usage["valid"] == 1


CLEANED = "id bigint, validation_status_id bigint, cleaning_time_ms bigint, created_at date, cleaner_used string, cleaner_version string"


def test_cleaner_summary_sample(spark):
    rows = [(1, 1, 100, dt.date(2023, 1, 1)), (2, 1, 200, dt.date(2023, 1, 2)), (3, 2, 50, dt.date(2023, 1, 3))]
    cleaned = spark.createDataFrame([(*r, "c", "1.0.0") for r in rows], CLEANED)
    got = st.cleaner_summary(cleaned, "c", "1.0.0", 1).first()
    assert (got.total_cleaned, got.valid_count, got.invalid_count) == (3, 2, 1)
    assert got.success_rate == pytest.approx(66.6667, abs=1e-3) and got.avg_cleaning_time_ms == pytest.approx(116.6667, abs=1e-3)
    assert (got.min_cleaning_time_ms, got.max_cleaning_time_ms) == (50, 200)
    assert (got.first_cleaned, got.last_cleaned) == (dt.date(2023, 1, 1), dt.date(2023, 1, 3))
    nothing = st.cleaner_summary(cleaned, "other", "1.0.0", 1).first()
    assert nothing.total_cleaned == 0 and nothing.success_rate == 0.0


@pytest.mark.parametrize(("ranges", "few"), [(4, 3), (16, 1), (1024, 10_000)])
def test_medians_by_ranges(spark, ranges, few):
    r = random.Random(11)
    groups = {
        "even": [r.random() for _ in range(200)],
        "odd": [r.gauss(0, 1e6) for _ in range(101)],
        "wide": [10.0 ** r.randint(-300, 300) * r.choice([-1, 1]) for _ in range(60)],
        "huge": [-1.7e308, 1.7e308, 1.6e308],
        "ties": [1.0] * 50 + [2.0] * 50,
        "one": [7.0],
        "same": [3.0] * 9,
        None: [1.0, 2.0, 10.0, 11.0],
        "none": [None, float("nan")],
    }
    rows = [(k, x) for k, xs in groups.items() for x in xs] + [("odd", None)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double")
    got = {row.k: row.median for row in ordering.run_median(df, ["k"], "x", ranges=ranges, few=few).collect()}
    assert got == {k: statistics.median(xs) for k, xs in groups.items() if k != "none"}


def test_medians(spark):
    rows = [("a", 1), ("a", 2), ("a", 2), ("a", 9), ("b", 5), ("c", None), ("d", 1), ("d", 4)]
    df = spark.createDataFrame(rows, "k string, x bigint")
    assert {r.k: r.median for r in ordering.exact_median(df, ["k"], "x").collect()} == {"a": 2.0, "b": 5.0, "d": 2.5}
    timed = df.select(F.col("k").alias("cleaner_used"), F.lit("1").alias("cleaner_version"), F.col("x").alias("cleaning_time_ms"))
    got = {r.cleaner_used: (r.total_cleaned, r.median_time_ms, r.avg_time_ms) for r in st.cleaner_performance(timed).collect()}
    assert got == {"a": (4, 2.0, 3.5), "b": (1, 5.0, 5.0), "c": (1, None, None), "d": (2, 2.5, 2.5)}


def test_data_summary_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([("abc", "en"), (None, "en"), ("", None)], "content string, language string")
    got = st.data_summary(df).first()
    assert (got.total_records, got.median_length, got.min_length, got.max_length) == (3, 1.5, 0, 3)
    assert got["columns"] == "content,language"
    assert [(r.language, r.record_count) for r in st.language_distribution(df).collect()] == [("en", 2)]
    assert st.data_summary(df.limit(0)).first().total_records == 0


def test_duplicate_titles_with_a_hot_title(spark):
    # One title on a third of all rows: its ids come back whole, in bounded blocks.
    raw = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("title"), F.lit("2024-01-01").alias("created_at"))
    blocks = st.duplicate_title_ids(raw, width=100).collect()
    assert {b.title for b in blocks} == {"hot"} and max(len(b.raw_data_ids) for b in blocks) <= 100
    assert sorted(i for b in blocks for i in b.raw_data_ids) == list(range(0, 3000, 3))
    assert st.duplicate_titles(raw).first().duplicate_count == 1000


def test_map_blocks_hold_every_name(spark):
    targets = spark.range(1000).select("id", F.lit(1).cast("bigint").alias("collection_type_id"), F.lit("en").alias("language_code"), F.concat(F.lit("n"), F.col("id") % 700).alias("collection_name"), F.col("id").alias("created_at"))
    maps = st.grouped_target_maps(targets, vocab.lookup(spark, ["only"]), width=64).collect()
    assert max(len(m.entries) for m in maps) <= 64
    merged = {k: v for m in maps for k, v in m.entries.items()}
    assert len(merged) == 700 and merged["n5"] == 705 and merged["n650"] == 650


def test_assigned_ids_are_whole_and_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    first = {r.key: r.id for r in ordering.assign_ids(df, F.col("key"), 100).collect()}
    again = {r.key: r.id for r in ordering.assign_ids(df.repartition(7), F.col("key"), 100).collect()}
    assert sorted(first.values()) == list(range(101, 5101)) and first == again


def test_new_rows_are_repeat_safe(spark):
    table = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (2, "z"), (2, "y")], "k int, v string")
    fresh = mt.new_rows(batch, table, ["k"], [F.col("v").asc()])
    assert [tuple(r) for r in fresh.collect()] == [(2, "y")]
    assert mt.new_rows(batch, table.unionByName(fresh), ["k"], [F.col("v").asc()]).isEmpty()
    assert sorted(r.k for r in mt.conflicts(batch, table, ["k"]).collect()) == [1, 2]


def test_merge_can_set_null(spark):
    table = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, v string, n int")
    updates = spark.createDataFrame([(1, None)], "id int, v string")
    assert sorted(tuple(r) for r in mt.merge_update(table, updates, "id", ["v"]).collect()) == [(1, None, 5), (2, "b", 6)]
    assert mt.matched_count(table, updates, "id").first().updated_count == 1


def test_retention_keeps_and_removes_all_rows(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 30)), (3, None)], "id int, created_at timestamp")
    assert [r.id for r in mt.keep_recent(df, 10, "2024-02-01").orderBy("id").collect()] == [2, 3]
    assert [r.id for r in mt.older_than(df, 10, "2024-02-01").collect()] == [1]


def test_get_or_create_twice(spark):
    lookup = vocab.lookup(spark, ["a", "b"])
    names = spark.createDataFrame([("b",), ("c",), ("c",), (None,)], "n string")
    once = mt.get_or_create(lookup, names, "n")
    assert sorted((r.id, r.name) for r in once.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert mt.get_or_create(once, names, "n").count() == 3


def test_delete_rules(spark):
    make = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    world = {
        "collection_targets": make([(1,), (2,)], "id bigint"),
        "collection_attempts": make([(10, 1), (11, 1), (12, 2)], "id bigint, collection_target_id bigint"),
        "raw_data": make([(20, 10), (21, 11), (22, 12)], "id bigint, collection_attempt_id bigint"),
        "cleaned_data": make([(30, 20), (31, 22)], "id bigint, raw_data_id bigint"),
        "run_collection_metadata": make([(40, 10), (41, 12)], "id bigint, collection_attempt_id bigint"),
    }
    ids = lambda d: sorted(r.id for r in d.collect())
    after, refused = integrity.delete_with_rules(world, "collection_attempts", make([(10,)], "id bigint"))
    assert ids(refused) == [] and ids(after["collection_attempts"]) == [11, 12]
    assert ids(after["raw_data"]) == [21, 22] and ids(after["cleaned_data"]) == [31]
    runs = {r.id: r.collection_attempt_id for r in after["run_collection_metadata"].collect()}
    assert runs == {40: None, 41: 12}
    after, refused = integrity.delete_with_rules(world, "collection_targets", make([(1,)], "id bigint"))
    assert ids(refused) == [1] and ids(after["collection_targets"]) == [1, 2]


PAGES = [
    (1, "en", "The Art of War"), (2, "en", "The War"), (3, "en", "the war"), (4, "fr", "La Guerre"), (5, "en", "Peace"),
    *[(10 + i, "en", f"The Title {i:02d}") for i in range(12)],
]


def test_checks_and_resolution_order(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, language_code string, title string")
    targets = spark.createDataFrame(
        [(1, "en", "THE WAR"), (2, "en", "War and Peace"), (3, "en", "nothing known"), (4, "fr", "The War"), (5, "en", "the zzz")],
        "id bigint, language_code string, collection_name string",
    )
    got = {r.collection_target_id: r for r in resolve.check_targets(targets, pages).collect()}
    assert got[1].test_status == "success" and got[1].search_results_found == ["The War"] and got[1].error_message == ""
    # Each shares one of three words, so titles go by name.
    assert got[2].test_status == "failed_with_suggestions" and got[2].search_results_found == ["Peace", "The Art of War", "The War"]
    assert got[3].test_status == "failed" and got[3].search_results_found == []
    assert got[4].test_status == "failed"
    assert len(got[5].search_results_found) == 5 and "10 search suggestions" in got[5].error_message
    found = {r.collection_target_id: (r.resolved_by, r.page_id) for r in resolve.resolve_pages(targets, pages).collect()}
    assert found == {1: ("exact", 2), 2: ("search", 5), 3: ("none", None), 4: ("none", None), 5: ("search", 1)}


def test_suggestions_go_by_shared_words_and_are_complete(spark):
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(12)] + ["the"] * 6
    titles = {" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 5))) for _ in range(150)}
    titles |= {"river bridge of stone", "Zeta river bridge", "Alpha zebra", "Beta zebra"}
    pages = spark.createDataFrame([(i, "en", t) for i, t in enumerate(sorted(titles))], "page_id bigint, language_code string, title string")
    wanted = {" ".join(r.choice([*vocabulary, "new"]) for _ in range(r.randint(1, 6))) for _ in range(80)} | {"old river bridge stone zebra"}
    asked = spark.createDataFrame([("en", w) for w in wanted], "language_code string, folded string")
    got = {x.folded: x.titles for x in resolve.search(asked, pages).collect()}
    for query in wanted:
        own = set(query.split())
        shared = {t: len(own & set(t.lower().split())) for t in titles}
        best = sorted((t for t, n in shared.items() if n and 3 * n >= len(own)), key=lambda t: (-shared[t], t))
        assert got.get(query, []) == best[:10]
    assert got["old river bridge stone zebra"][:2] == ["river bridge of stone", "Zeta river bridge"]


def test_aliases_in_order_and_depth(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, language_code string, title string")
    rows = [
        ("war", "missing", 1), ("war", "The War", 2), ("war", "Peace", 3),
        ("deep", "war", 1), ("deep", "Peace", 2),
        ("deeper", "deep", 1),
        ("late", "m1", 1), ("late", "m2", 2), ("late", "m3", 3), ("late", "m4", 4), ("late", "m5", 5), ("late", "Peace", 6),
        ("loop", "loop", 1),
    ]
    aliases = spark.createDataFrame([("en", *r) for r in rows], "language_code string, alias string, option string, position int")
    asked = aliases.select("language_code", F.col("alias").alias("title")).distinct()
    answer = lambda depth: {r.title: r.page_id for r in resolve.resolve_aliases(asked, aliases, pages, 5, depth).collect()}
    assert answer(0) == {"war": 2, "deep": 5, "deeper": None, "late": None, "loop": None}
    assert answer(1) == {"war": 2, "deep": 2, "deeper": 5, "late": None, "loop": None}
    assert answer(2)["deeper"] == 2


def test_clean_job_skips_what_is_done(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    tables.conform(spark.range(0), clean_job.CLEANED_DATA).write.parquet(path)
    raw = spark.createDataFrame(
        [(1, "t", "en", None, '{"title": "T", "content": "c [1]"}'), (2, "t", "en", None, "{}"), (3, "t", "en", None, '{"title": ""}')],
        "id bigint, title string, language_code string, url string, metadata string",
    )
    cleaner = cleaners.get_cleaner("wikipedia_cleaner", cleaned_at="now")
    run = lambda rows: clean_job.run_clean(spark, rows, path, cleaner, 1, clean_job.ARTICLE_SCHEMA["schema"], "2024-01-01").first()
    assert (run(raw.filter("id < 3")).success_count, spark.read.parquet(path).count()) == (2, 2)
    assert (run(raw).success_count, spark.read.parquet(path).count()) == (3, 3)
    run(raw)
    stored = {r.raw_data_id: r for r in spark.read.parquet(path).collect()}
    assert len(stored) == 3 and len({r.id for r in stored.values()}) == 3
    assert (stored[1].validation_status_id, stored[2].validation_status_id, stored[3].validation_status_id) == (1, 2, 2)
    assert stored[2].metadata == "{}" and "cleaning_failed" in stored[2].validation_error


def test_clean_job_figures_come_from_the_pass_that_writes(spark, tmp_path):
    path = str(tmp_path / "cleaned")
    tables.conform(spark.range(0), clean_job.CLEANED_DATA).write.parquet(path)
    rows = [(i, "t", "en", None, '{"title": "T", "content": "c"}' if i % 5 else "{}") for i in range(50)]
    raw = spark.createDataFrame(rows, "id bigint, title string, language_code string, url string, metadata string")
    cleaner = cleaners.get_cleaner("wikipedia_cleaner", cleaned_at="now")
    run = lambda asked: clean_job.run_clean(spark, asked, path, cleaner, 1, clean_job.ARTICLE_SCHEMA["schema"], "2024-01-01").first()
    first = run(raw.filter("id < 30"))
    stored = spark.read.parquet(path)
    summary = st.cleaner_summary(stored, cleaner.name, cleaner.version, 1).first()
    assert (first.success_count, first.error_count, first.skipped_count) == (30, 0, 0)
    assert (first.valid_count, first.invalid_count, first.failed_count) == (summary.valid_count, summary.invalid_count, 6) == (24, 6, 6)
    assert first.average_time_per_record == summary.avg_cleaning_time_ms >= summary.min_cleaning_time_ms >= 1
    second = run(raw.unionByName(raw.filter("id = 40")))
    assert (second.success_count, second.error_count, second.skipped_count) == (50, 1, 30)
    third = run(raw)
    assert (third.success_count, third.skipped_count, third.valid_count, third.average_time_per_record) == (50, 50, 0, 0.0)


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    raw = spark.range(500).select("id", F.lit("t").alias("title"))
    cleaned = raw.filter("id % 3 = 0").select(F.col("id").alias("raw_data_id"), F.lit("c").alias("cleaner_used"), F.lit("1").alias("cleaner_version"))
    names = [f"{kind}_{tmp_path.name}" for kind in ("raw", "cleaned")]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        tables.write_bucketed(raw, names[0], "id", 4, str(tmp_path / "raw"))
        tables.write_bucketed(cleaned, names[1], "raw_data_id", 4, str(tmp_path / "cleaned"))
        left = lookups.not_cleaned(spark.table(names[0]), spark.table(names[1]), "c", "1")
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 333
        tables.append_table(cleaned.limit(1).withColumn("raw_data_id", F.lit(1).cast("bigint")), names[1])
        left = lookups.not_cleaned(spark.table(names[0]), spark.table(names[1]), "c", "1")
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 332
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_cleaner_registry():
    assert cleaners.available_cleaners() == ["fivethirtyeight_cleaner", "wikipedia_cleaner"]
    with pytest.raises(ValueError, match="unknown cleaner"):
        cleaners.get_cleaner("nobody")


def test_check_job_marks_targets(spark):
    pages = spark.createDataFrame(PAGES, "page_id bigint, language_code string, title string")
    targets = spark.createDataFrame([(1, "en", "Peace", 1), (2, "en", "qqq", 1), (3, "en", "rrr", 1)], "id bigint, language_code string, collection_name string, collection_status_id bigint")
    earlier = spark.createDataFrame([(3,)], "collection_target_id bigint")
    done = collect_job.check_job(targets, pages, earlier, "2024-01-01")
    assert {r.id: r.collection_status_id for r in done.targets.collect()} == {1: 1, 2: 4, 3: 1}
    assert done.checks.count() == 2


def test_record_files(spark, tmp_path):
    df = spark.createDataFrame([("a\nb \"q\", c", ["x"])], "content string, links array<string>")
    folder = tables.write_records(df, "kind", str(tmp_path), "s1", "weird")
    assert folder.endswith("kind_s1")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(folder).first()
    assert back.content == 'a\nb "q", c' and back.links == '["x"]'
    assert tables.write_records(df.limit(0), "kind", str(tmp_path), "s2") is None


def test_parts_of_a_large_table_are_finer_than_its_splits(spark, tmp_path):
    from sheafline.sources.tables import dealt_finely

    rows = spark.range(4000).selectExpr("id % 1000 AS a", "id % 500 AS b")
    rows.repartition(64).write.parquet(str(tmp_path / "many"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    many, one = [spark.read.parquet(str(tmp_path / name)) for name in ("many", "one")]
    splits = many.rdd.getNumPartitions()
    pairs = dealt_finely(many, "a", "b").distinct()
    # No part is joined with another before repeated pairs are dropped, and none is dealt twice.
    assert pairs.rdd.getNumPartitions() == 8 * splits >= 64 and pairs.count() == 1000
    assert "ENSURE_REQUIREMENTS" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert dealt_finely(one, "a", "b") is one
