import pytest
from pyspark.sql import functions as F

from sheafline.plans import forecast as fc


@pytest.fixture(scope="module")
def polls(spark):
    n = F.col("id")
    state = F.element_at(F.array(*[F.lit(s) for s in ("Texas", "Ohio", "Florida")]), (n % 3 + 1).cast("int"))
    return spark.range(180).select(
        n.alias("poll_id"), F.lit(2016).alias("cycle"), state.alias("cleaned_state"),
        F.when(n % 2 == 0, "Ann Clinton").otherwise("Bob Other").alias("cleaned_candidate_name"),
        (F.lit(40.0) + n % 11).alias("pct_estimate"), F.lit(None).cast("double").alias("pct_trend_adjusted"),
        F.date_format(F.date_sub(F.lit("2016-11-08").cast("date"), (n % 70).cast("int")), "yyyy-MM-dd").alias("model_date"),
        (n % 4 * 0.5).alias("sum_influence"),
    ).persist()


CANDIDATES = ["Ann Clinton", "Bob Other"]


def test_window(polls):
    window = fc.poll_window(polls, CANDIDATES, "2016-11-08", 2016, 60)
    assert window.agg(F.min("days_since_poll"), F.max("days_since_poll")).first() == (0, 60)
    assert fc.poll_window(polls, ["Ann Clinton"], "2016-11-08", 2016, 60, states=["Ohio"]).select("cleaned_state", "cleaned_candidate_name").distinct().count() == 1
    assert fc.poll_window(polls, CANDIDATES, "2016-11-08", 2016, 60, sample_cap=50).count() == 50
    assert fc.poll_window(polls, CANDIDATES, "2016-11-08", 2020, 60).count() == 0
    with pytest.raises(ValueError):
        fc.poll_window(polls, [], "2016-11-08", 2016)


def test_features_in_both_modes(polls):
    window = fc.poll_window(polls, CANDIDATES, "2016-11-08", 2016, 60)
    for mode in ("rows", "days"):
        table = fc.features(window, 2016, mode=mode)
        assert set(fc.FEATURES) <= set(table.columns) and table.count() == window.count()
        assert {(r.cleaned_state, r.state_lean, r.is_swing_state, r.state_encoded) for r in table.collect()} == {
            ("Texas", 1, 0, 2), ("Ohio", 0, 0, 1), ("Florida", 0, 1, 0)
        }


def test_fallbacks_for_zero_weights(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "q double")
    assert {r[0] for r in df.select(fc.normalised(df, "q", 0.5)).collect()} == {0.5}


def test_shy_adjustment(spark):
    rows = [("s", "a", 99.0), ("s", "b", 1.0), ("s", "c", 50.0), ("t", "b", 10.0)]
    df = spark.createDataFrame(rows, "cleaned_state string, cleaned_candidate_name string, support double")
    got = {(r.cleaned_state, r.cleaned_candidate_name): r.support for r in fc.shy_adjusted(df, "a", 4.0).collect()}
    assert got == {("s", "a"): 100.0, ("s", "b"): 0.0, ("s", "c"): 48.0, ("t", "b"): 10.0}
    assert fc.shy_adjusted(df, "nobody", 4.0).filter("support in (99, 1, 50, 10)").count() == 4


def test_noise_is_standard_normal_and_fixed(spark):
    df = spark.range(20000).select(fc.normal(F.col("id").cast("string")).alias("z"))
    mean, std = df.agg(F.avg("z"), F.stddev("z")).first()
    assert abs(mean) < 0.03 and abs(std - 1) < 0.03
    assert df.agg(F.sum("z")).first()[0] == pytest.approx(df.repartition(5).agg(F.sum("z")).first()[0])


def test_outcomes(spark):
    rows = [("Texas", "Ann Clinton", 60.0), ("Texas", "Bob Other", 20.0), ("Ohio", "Ann Clinton", 45.0), ("Ohio", "Bob Other", 45.0), ("Nowhere", "Ann Clinton", 1.0), ("Nowhere", "Bob Other", 90.0)]
    predictions = spark.createDataFrame(rows, "cleaned_state string, cleaned_candidate_name string, support double")
    outcomes = fc.draw_outcomes(predictions, fc.state_votes(spark), 500, 2.0, per_row=40)
    assert outcomes.count() == 1500 and outcomes.select("draw").distinct().count() == 500
    shares = {r.cleaned_candidate_name: r for r in fc.outcome_shares(predictions, outcomes, 500, needed=40).collect()}
    assert sum(r.win_probability for r in shares.values()) == pytest.approx(1.0)
    assert sum(r.expected_electoral_votes for r in shares.values()) == pytest.approx(38 + 18 + 3)
    assert shares["Bob Other"].win_probability == 0.0
    eased = {r.cleaned_candidate_name: r for r in fc.outcome_shares(predictions, outcomes, 500, needed=41, bonus_in_threshold=True).collect()}
    assert eased["Ann Clinton"].win_probability == 1.0
    states = {(r.cleaned_state, r.cleaned_candidate_name): r.win_share for r in fc.state_shares(predictions, outcomes, 500).collect()}
    assert states[("Texas", "Ann Clinton")] == 1.0 and 0.4 < states[("Ohio", "Ann Clinton")] < 0.6
    assert states[("Nowhere", "Ann Clinton")] == 0.0


def test_one_prediction_pass_equals_one_pass_per_model(spark, polls):
    from pyspark.ml.feature import VectorAssembler

    table = fc.features(fc.poll_window(polls, CANDIDATES, "2016-11-08", 2016, 60), 2016)
    models = fc.fit_models(table, 2016, trees=4, at_once=2)
    assert [m.candidate for m in models] == CANDIDATES
    assert [m.n_train + m.n_test for m in models] == [m.n_samples for m in models] and all(m.n_test for m in models)
    alone = fc.fit_models(table.filter(F.col("cleaned_candidate_name") == "Bob Other"), 2016, trees=4, at_once=1)
    assert (alone[0].train_r2, alone[0].n_train) == (models[1].train_r2, models[1].n_train)
    extra = table.limit(1).withColumn("cleaned_candidate_name", F.lit("Nobody"))
    got = sorted(map(tuple, fc.predict(models, table.unionByName(extra)).collect()))
    rows = VectorAssembler(inputCols=fc.FEATURES, outputCol="features").transform(table)
    want = []
    for m in models:
        own = m.model.transform(rows.filter(F.col("cleaned_candidate_name") == m.candidate))
        want += [(r.cleaned_state, r.cleaned_candidate_name, min(100.0, max(0.0, r.prediction))) for r in own.collect()]
    assert got == sorted(want)
    with pytest.raises(ValueError):
        fc.predict([], table)


def test_whole_forecast(polls):
    result = fc.run_forecast(
        polls, CANDIDATES, "2016-11-08", 2016, states=["Texas", "Ohio", "Utah"], draws=200, trees=3, shy_points=2.0, shy_candidate="Bob Other"
    )
    predictions = result.predictions.collect()
    assert len(predictions) == 6 and all(0 <= r.support <= 100 for r in predictions)
    assert result.shares.count() == 2 and result.state_shares.count() == 6
    assert {r.candidate for r in result.scores.collect()} == set(CANDIDATES)
    assert result.importances.groupBy("candidate").agg(F.sum("importance").alias("s")).filter("abs(s - 1) > 1e-6").count() == 0
    summary = result.summary.first()
    assert summary.n_candidates == 2 and summary.target_column == "pct_estimate"


def test_rounds_of_a_model_have_a_task_per_many_rows_and_no_long_lineage(spark, polls, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, rows: seen.append(rows) or fit(self, rows))
    table = fc.features(fc.poll_window(polls, CANDIDATES, "2016-11-08", 2016, 60), 2016).repartition(40)
    assert len(fc.fit_models(table, 2016, trees=2)) == 2
    assert [rows.rdd.getNumPartitions() for rows in seen] == [1, 1]
    plans = [rows._jdf.queryExecution().executedPlan().toString() for rows in seen]
    assert len(plans) == 2 and not any("InMemoryTableScan" in p or "Exchange" in p for p in plans)
