import json

from pyspark.sql import functions as F

from sheafline.functions import polls
from sheafline.plans import cleaners
from sheafline.sources import poll_files
from sheafline.vocab import ARTICLE_OPERATIONS, POLL_OPERATIONS


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_dates(spark):
    texts = ["2016-1-5", "11/3/2020", "2020-11-03T00:00:00", "13-2020", " 1/2/2016 ", "2020-012-5", "", None, "1/2/16"]
    want = ["2016-1-5", "2020-11-03", "2020-11-03", None, "2016-01-02", None, None, None, None]
    assert column(spark, texts, polls.iso_date_text) == want


def test_percentages(spark):
    got = column(spark, ["-1", "101", "abc", "NaN", None, "12.12345678", "45", "inf"], polls.percentage)
    assert got == [0.0, 100.0, None, None, None, 12.123457, 45.0, 100.0]


def test_numbers(spark):
    assert column(spark, ["2016.0", "1960", None, "x", "-1.9", "inf", "NaN"], polls.lenient_int) == [2016, 1960, None, None, -1, None, None]


def test_names(spark):
    assert column(spark, ["New York", " West Virginia ", None, "Ohio"], polls.state_name) == ["New_York", "West_Virginia", "", "Ohio"]
    got = column(spark, ["Donald J. Trump", "Bernard  Sanders", " A\t B ", None, "Hillary Rodham Clinton Jr"], polls.candidate_name)
    assert got == ["Donald Trump", "Bernie Sanders", "A B", "", "Hillary Rodham Clinton Jr"]


def test_days_between(spark):
    df = spark.createDataFrame([("2020-10-01", "2020-11-03"), ("2020-13-01", "2020-11-03"), (None, "2020-11-03"), ("2020-1-1", "2020-11-03")], "a string, b string")
    assert [r[0] for r in df.select(polls.days_between(F.col("a"), F.col("b"))).collect()] == [33, None, None, None]


def test_version_order():
    assert polls.version_at_least("10.0.0", "2.0.0")
    assert not polls.version_at_least("1.5.0", "2.0.0")
    assert polls.version_at_least("2.0", "2.0.0")


RAW = {
    "cycle": 2016, "state": "New York", "candidate_name": "Donald J. Trump", "pct_estimate": 120.5, "pct_trend_adjusted": 44.1234567,
    "modeldate": "11/1/2016", "election_date": "11/8/2016", "collection_source": "file", "sum_influence": "1.5",
}


def clean(spark, documents, version):
    raw = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "id bigint, metadata string")
    return {r.id: r for r in cleaners.clean_polls(raw, "now", version, 2024).collect()}


def test_poll_transform_both_versions(spark):
    new = json.loads(clean(spark, [json.dumps(RAW)], "2.0.0")[0].cleaned_metadata)
    assert new["model_date"] == "2016-11-01" and "modeldate" not in new
    assert new["pct_estimate"] == 100.0 and new["pct_trend_adjusted"] == 44.123457
    assert new["cleaned_state"] == "New_York" and new["cleaned_candidate_name"] == "Donald Trump"
    assert new["dataset_type"] == "1968-2016" and new["is_outlier"] is True
    assert new["data_quality_score"] == 1.0 and new["sum_influence"] == 1.5
    assert new["cleaning_operations_applied"] == POLL_OPERATIONS
    old = json.loads(clean(spark, [json.dumps(RAW)], "1.0.0")[0].cleaned_metadata)
    assert (old["modeldate"], old["election_date"], old["days_before_election"]) == ("2016-11-01", "2016-11-08", 7)


def test_poll_transform_edges(spark):
    rows = clean(spark, ["{}", None, json.dumps({"cycle": None, "state": ""}), json.dumps({"cycle": 1960, "pct_estimate": "abc"})], "2.0.0")
    assert rows[0].cleaned_metadata is None and json.loads(rows[0].failure)["cleaning_failed"] is True
    assert rows[1].failure is not None
    third = json.loads(rows[2].cleaned_metadata)
    assert third["data_quality_score"] == 0.0 and third["dataset_type"] == "2020-2024" and "sum_influence" not in third
    assert third["pct_estimate"] is None
    assert json.loads(rows[3].cleaned_metadata)["is_outlier"] is True


ARTICLE = {
    "title": "Test Article[1]   ",
    "content": "It’s [2] a “test”[clarification needed]\n\n\n\nend",
    "summary": "Sum[1] mary[citation needed]",
    "categories": ["Category 1", "Category 1", 123, "   Category 2   ", "", "Category 2"],
    "links": [None, "Link  A", "Link A"],
    "page_id": "5679119",
    "extra": {"kept": [1]},
}


def test_article_transform(spark):
    raw = spark.createDataFrame([(7, json.dumps(ARTICLE))], "id bigint, metadata string")
    row = cleaners.clean_articles(raw, "now").first()
    got = json.loads(row.cleaned_metadata)
    assert {k: got[k] for k in ARTICLE} == ARTICLE
    assert got["cleaned_content"] == "It's a \"test\"\n\nend"
    assert (got["content_word_count"], got["content_char_count"]) == (4, len(got["cleaned_content"]))
    assert got["cleaned_summary"] == "Sum mary" and got["summary_word_count"] == 2
    assert got["cleaned_title"] == "Test Article"
    assert got["cleaned_categories"] == ["Category 1", "Category 2"] and got["category_count"] == 2
    assert got["cleaned_links"] == ["Link A"] and got["internal_link_count"] == 1
    assert got["original_content_length"] == len(ARTICLE["content"])
    assert got["cleaning_operations_applied"] == ARTICLE_OPERATIONS


def test_article_keys_that_are_absent_stay_absent(spark):
    documents = [json.dumps({"title": "only"}), "{}", None, json.dumps({"content": 5})]
    raw = spark.createDataFrame(list(enumerate(documents)), "id bigint, metadata string")
    rows = {r.id: r for r in cleaners.clean_articles(raw, "now").collect()}
    got = json.loads(rows[0].cleaned_metadata)
    assert "cleaned_content" not in got and got["cleaned_title"] == "only" and got["original_content_length"] == 0
    assert "no metadata" in json.loads(rows[1].failure)["error"]
    assert rows[2].cleaned_metadata is None
    assert json.loads(rows[3].failure)["error_type"] == "TypeError"


def test_typed_article_columns(spark):
    df = spark.createDataFrame([("a [1]", ["x ", "x"])], "content string, links array<string>")
    row = cleaners.article_columns(df).first()
    assert row.cleaned_content == "a" and row.internal_link_count == 1 and "cleaned_title" not in row


def test_csv_layouts_and_row_index(spark, tmp_path):
    old = tmp_path / "old.csv"
    old.write_text(
        "cycle,state,modeldate,candidate_name,candidate_id,pct_estimate,_medpoly2,new_column\n"
        "2016,New York,11/1/2016,Donald J. Trump,9,41.5,0.1,x\n2016,Ohio,11/2/2016,\"B, C\",oops,40,0.2,y\n"
    )
    rows = poll_files.read_poll_csv(spark, str(old), "1968-2016")
    got = {r.state: r for r in rows.collect()}
    assert got["New York"].candidate_id == 9 and got["New York"]["_medpoly2"] == 0.1
    assert got["Ohio"].candidate_name == "B, C" and got["Ohio"].candidate_id is None and got["Ohio"]["_corrupt_record"]
    indexed = poll_files.with_row_index(rows.drop("_corrupt_record"))
    names = [r.collection_name for r in poll_files.target_names(indexed).orderBy("original_row_index").collect()]
    assert names == ["2016_New_York_Donald_J._Trump_2", "2016_Ohio_B,_C_3"]
    stored = poll_files.stored_poll_fields(poll_files.poll_records(indexed, "now")).columns
    assert "_medpoly2" in stored and "new_column" not in stored

    new = tmp_path / "new.csv"
    new.write_text("candidate,date,pct_trend_adjusted,state,cycle,party,pct_estimate,hi,lo\nBiden,2020-10-01,50.5,Ohio,2020,DEM,51,,\n")
    record = poll_files.poll_records(poll_files.with_row_index(poll_files.read_poll_csv(spark, str(new), "2020-2024")), "now").first()
    assert (record.candidate_name, record.modeldate, record.election_date) == ("Biden", "2020-10-01", "11/3/2020")
    assert record.title == "Biden - Ohio - 2020" and record.content == "Polling data for Biden in Ohio (2020): 51.0% estimate"


def test_row_index_over_many_splits(spark, tmp_path):
    path = tmp_path / "many.csv"
    path.write_text("n\n" + "\n".join(str(i) for i in range(20000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = poll_files.with_row_index(spark.read.schema("n INT").csv(str(path), header=True), "place")
        assert df.filter("n <> place").count() == 0 and df.count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_targets_find_their_rows(spark):
    targets = spark.createDataFrame([("2016_NY_A_2",), ("2016_NY_A_99",), ("a_b_3",), ("x_y_z_w",), ("1_2_3_1",)], "collection_name string")
    rows = spark.createDataFrame([(0, "first"), (1, "second")], "original_row_index bigint, payload string")
    assert [r.payload for r in poll_files.match_targets_to_rows(targets, rows).collect()] == ["first"]


def test_aliases_follow_each_other_as_plain_text_and_missing_percentages_are_no_outliers(spark):
    from pyspark.sql import functions as F

    from sheafline.functions import polls as p

    rows = spark.createDataFrame([(" Ann \t B ", 0.5, None), ("C", None, None), (None, 50.0, 91.0), ("x$1", None, 5.0)], "n string, a double, b double")
    named = rows.select(p.candidate_name(F.col("n"), {"Ann B": "C", "C": "D$1"}).alias("n"), p.is_outlier([F.col("a"), F.col("b")], F.lit(2000), 2024).alias("o"))
    assert [tuple(r) for r in named.collect()] == [("D$1", True), ("D$1", False), ("", True), ("x$1", False)]
    assert "regexp_replace(regexp_replace" not in named._jdf.queryExecution().executedPlan().toString()
