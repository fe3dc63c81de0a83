"""Polls to features, per-candidate models, state predictions and outcome shares."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.polls import as_date, time_weight
from ..operators.ordering import sample_by_hash, stable_number
from ..operators.trailing import trailing_means, trailing_means_by_days
from ..session import stage
from ..vocab import (
    BONUS_SURNAMES,
    BONUS_VOTES,
    DECAY_RATE,
    DEFAULT_DAYS,
    DEFAULT_SUPPORT,
    LEAN_LEFT,
    LEAN_RIGHT,
    ROW_WINDOWS,
    STATE_VOTES,
    SWING,
    VOTES_NEEDED,
    values_frame,
)

STATE, CANDIDATE, DAYS = "cleaned_state", "cleaned_candidate_name", "days_since_poll"

# Feature names, and the short names used in the model summary.
FEATURES = [
    "days_since_poll_norm", "weeks_since_poll", "state_encoded", "poll_avg_7d", "poll_avg_14d", "poll_avg_30d",
    "quality_score_norm", "influence_norm", "time_weight", "state_lean", "is_swing_state",
]
FEATURE_LABELS = [
    "days_since_poll_norm", "weeks_since_poll", "state", "avg_7d", "avg_14d", "avg_30d",
    "quality", "influence", "time_weight", "lean", "swing",
]


def target_column(cycle: int) -> str:
    return "pct_estimate" if cycle <= 2016 else "pct_trend_adjusted"


def poll_window(
    polls: DataFrame,
    candidates: list[str],
    as_of: str,
    cycle: int,
    lookback_days: int = 60,
    states: list[str] | None = None,
    sample_cap: int | None = None,
    sample_key: Column | None = None,
) -> DataFrame:
    """Polls of one cycle and some candidates within the days before ``as_of``.

    Adds ``days_since_poll`` and the weights. Every test but the date is a plain
    predicate on a stored column and reaches the scan; ``model_date`` does too
    when it is stored as a date. Sampling is off by default.
    """
    if not candidates:
        raise ValueError("No candidates entered")
    target = target_column(cycle)
    typed = polls.schema["model_date"].dataType.typeName() == "date"
    day = F.col("model_date") if typed else as_date(F.col("model_date"))
    today = F.lit(as_of).cast("date")
    df = polls.filter(
        (F.col("cycle") == cycle)
        & F.col(CANDIDATE).isin(candidates)
        & (day >= F.date_sub(today, lookback_days))
        & (day <= today)
    )
    if sample_cap:
        df = sample_by_hash(df, sample_key if sample_key is not None else F.col("poll_id"), sample_cap)
    if states:
        df = df.filter(F.col(STATE).isin(states))
    df = df.filter(F.col(STATE).isNotNull() & F.col(target).isNotNull())

    def filled(name: str, value: float) -> Column:
        return F.coalesce(F.col(name), F.lit(value)) if name in polls.columns else F.lit(value)

    weighted = df.withColumns(
        {
            "model_date": day,
            DAYS: F.datediff(today, day).cast("bigint"),
            "data_quality_score": filled("data_quality_score", 0.5),
            "sum_influence": filled("sum_influence", 1.0),
        }
    )
    return weighted.withColumn("time_weight", time_weight(F.col(DAYS), DECAY_RATE)).withColumn(
        "poll_weight", F.col("data_quality_score") * F.col("sum_influence") * F.col("time_weight")
    )


def date_range(window: DataFrame) -> DataFrame:
    """Least, most and span of the days since a poll (0 where either end is 0 or missing)."""
    low, high = F.min(DAYS), F.max(DAYS)
    return window.agg(
        F.when((low != 0) & (high != 0), high - low).otherwise(F.lit(0)).cast("bigint").alias("days_of_data"),
        F.coalesce(low, F.lit(0)).alias("most_recent_poll_days_ago"),
        F.coalesce(high, F.lit(0)).alias("oldest_poll_days_ago"),
    )


def state_codes(polls: DataFrame) -> DataFrame:
    """0-based place of each state in alphabetical order."""
    # One row per state name.
    return polls.select(STATE).distinct().select(
        STATE, (F.row_number().over(W.orderBy(STATE)) - 1).cast("int").alias("state_encoded")
    )


def state_lean(state: Column) -> Column:
    return F.when(state.isin(LEAN_LEFT), -1).when(state.isin(LEAN_RIGHT), 1).otherwise(0)


def is_swing(state: Column) -> Column:
    return state.isin(SWING).cast("int")


def normalised(df: DataFrame, column: str, fallback: float, largest: Column | None = None) -> Column:
    """``column`` over its largest value; ``fallback`` when that is not positive."""
    largest = df.select(F.max(column)).scalar() if largest is None else largest
    return F.when(largest > 0, F.col(column) / largest).otherwise(F.lit(fallback))


def features(
    window: DataFrame,
    cycle: int,
    row_id: str = "poll_id",
    tie: list[str] | None = None,
    mode: str = "rows",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """The feature table: times, state code, trailing means, normalised weights, lean and swing.

    ``mode="rows"`` takes the last 7, 14 and 30 polls of a state and candidate,
    newest first; ``mode="days"`` takes that many days.
    """
    target = target_column(cycle)
    windows = {f"poll_avg_{n}d": n for n in ROW_WINDOWS}
    keys = [STATE, CANDIDATE]
    if mode == "rows":
        averaged = trailing_means(window, keys, DAYS, row_id, target, windows, tie, block_rows)
    else:
        averaged = trailing_means_by_days(window, keys, DAYS, target, windows)
    measures = ["data_quality_score", "sum_influence"]
    largest = window.select(F.struct(*[F.max(c).alias(c) for c in measures])).scalar()
    return averaged.join(state_codes(window), STATE).withColumns(
        {
            "days_since_poll_norm": F.col(DAYS) / F.lit(365),
            "weeks_since_poll": F.col(DAYS) / F.lit(7),
            "quality_score_norm": normalised(window, "data_quality_score", 0.5, largest["data_quality_score"]),
            "influence_norm": normalised(window, "sum_influence", 1.0, largest["sum_influence"]),
            "state_lean": state_lean(F.col(STATE)),
            "is_swing_state": is_swing(F.col(STATE)),
        }
    )


def sample_counts(window: DataFrame, least: int = 10) -> DataFrame:
    """Candidates with enough polls to train on."""
    return window.groupBy(CANDIDATE).agg(F.count("*").alias("n_samples")).filter(F.col("n_samples") >= least)


def serving_inputs(window: DataFrame, states: DataFrame, candidates: list[str], cycle: int) -> DataFrame:
    """Mean support and latest poll of every state and candidate; defaults where there is no poll.

    ``states`` holds ``cleaned_state``; each state row is unfolded over the given candidates.
    """
    means = window.groupBy(STATE, CANDIDATE).agg(F.avg(target_column(cycle)).alias("_avg"), F.min(DAYS).alias("_days"))
    grid = states.select(STATE, F.explode(F.array(*[F.lit(c) for c in candidates])).alias(CANDIDATE))
    return grid.join(means, [STATE, CANDIDATE], "left").select(
        STATE,
        CANDIDATE,
        F.coalesce("_avg", F.lit(DEFAULT_SUPPORT)).alias("recent_avg"),
        F.coalesce("_days", F.lit(DEFAULT_DAYS)).cast("bigint").alias("days_recent"),
    )


def serving_features(inputs: DataFrame, codes: DataFrame, window: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Model inputs for prediction.

    Quality, influence, weight and lean are constants (0.5, 0.5, 1, 0) as the
    model has always been served; ``strict=False`` uses the lean of the state.
    """
    avg = F.col("recent_avg")
    return inputs.join(codes, STATE, "left").withColumns(
        {
            "days_since_poll_norm": F.col("days_recent") / F.lit(365),
            "weeks_since_poll": F.col("days_recent") / F.lit(7),
            "state_encoded": F.coalesce("state_encoded", F.lit(0)),
            **{f"poll_avg_{n}d": avg for n in ROW_WINDOWS},
            "quality_score_norm": F.lit(0.5),
            "influence_norm": F.lit(0.5),
            "time_weight": F.lit(1.0),
            "state_lean": F.lit(0) if strict else state_lean(F.col(STATE)),
            "is_swing_state": is_swing(F.col(STATE)),
        }
    )


# Models


#: Rows of a training set per task. A boosted tree takes several rounds over all rows, and a round costs its tasks.
TASK_ROWS = 50_000


@dataclass(frozen=True)
class CandidateModel:
    candidate: str
    model: object
    train_r2: float
    test_r2: float
    n_samples: int
    n_train: int
    n_test: int


def fit_models(
    table: DataFrame,
    cycle: int,
    trees: int = 100,
    depth: int = 4,
    rate: float = 0.1,
    seed: int = 42,
    split_key: str = "poll_id",
    least: int = 10,
    split_above: int = 20,
    weighted: bool = False,
    at_once: int = 4,
) -> list[CandidateModel]:
    """One boosted-tree model per candidate with enough polls, each trained on the cluster.

    A fifth of the polls, chosen by hash of their key, is held out for candidates
    with more than ``split_above`` polls. Only one count per candidate reaches the driver.
    The models are fitted side by side, ``at_once`` at a time: the jobs of one fill the
    gaps that the many small rounds of another leave. Every round of a model has a task
    per ``TASK_ROWS`` of its polls, not one per partition of the table, and starts from
    a table in the shared folder: with a cached one, every task of the thousand jobs
    carries the plan behind ``table``.
    """
    from pyspark import inheritable_thread_target
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    target = target_column(cycle)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        table.withColumns({"label": F.col(target).cast("double"), "_held": stable_number(F.col(split_key)) % 5 == 0})
    )
    slim = stage(assembled.select(CANDIDATE, "features", "label", "_held", *(["poll_weight"] if weighted else [])), "training")

    @inheritable_thread_target
    def fitted(row: Row) -> CandidateModel:
        own = slim.filter(F.col(CANDIDATE) == row[CANDIDATE])
        n, held = row["n_samples"], row["n_held"]
        train, test, sizes = own, own, (n, n)
        # Without a row on either side there is nothing to hold out: the train score counts.
        if n > split_above and 0 < held < n:
            train, test, sizes = own.filter(~F.col("_held")), own.filter("_held"), (n - held, held)
        train, test = [part.coalesce(-(-size // TASK_ROWS)) for part, size in zip((train, test), sizes)]
        trainer = GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed)
        if weighted:
            trainer = trainer.setWeightCol("poll_weight")
        model = trainer.fit(train)
        judge = RegressionEvaluator(metricName="r2")
        scores = [judge.evaluate(model.transform(part)) for part in (train, test)]
        return CandidateModel(row[CANDIDATE], model, *scores, n, *sizes)

    held = slim.groupBy(CANDIDATE).agg(F.count("*").alias("n_samples"), F.count_if("_held").alias("n_held"))
    counts = held.filter(F.col("n_samples") >= least).orderBy(CANDIDATE).collect()
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(fitted, counts))


def model_scores(spark: SparkSession, models: list[CandidateModel]) -> DataFrame:
    rows = [(m.candidate, float(m.train_r2), float(m.test_r2), m.n_samples, m.n_train, m.n_test) for m in models]
    kinds = "candidate STRING, train_r2 DOUBLE, test_r2 DOUBLE, n_samples BIGINT, n_train BIGINT, n_test BIGINT"
    return values_frame(spark, kinds, rows)


def feature_importances(spark: SparkSession, models: list[CandidateModel]) -> DataFrame:
    rows = [
        (m.candidate, label, float(value))
        for m in models
        for label, value in zip(FEATURE_LABELS, m.model.featureImportances.toArray())
    ]
    return values_frame(spark, "candidate STRING, feature STRING, importance DOUBLE", rows)


def predict(models: list[CandidateModel], serving: DataFrame) -> DataFrame:
    """Support of every state and candidate with a model, held within 0-100.

    One pass: each model adds a column, and each row takes that of its candidate.
    """
    from pyspark.ml.feature import VectorAssembler

    if not models:
        raise ValueError("no trained models")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(serving)
    own = F.lit(None).cast("double")
    for i, m in enumerate(models):
        rows = m.model.copy({m.model.predictionCol: f"_support{i}"}).transform(rows)
        own = F.when(F.col(CANDIDATE) == m.candidate, F.col(f"_support{i}")).otherwise(own)
    chosen = rows.select(STATE, CANDIDATE, own.alias("support")).filter(F.col("support").isNotNull())
    return chosen.withColumn("support", F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("support"))))


def shy_adjusted(predictions: DataFrame, candidate: str, points: float) -> DataFrame:
    """Move support to one candidate: others give up equal parts, none below 0, all at most 100."""
    if not candidate or points == 0:
        return predictions
    in_state = W.partitionBy(STATE)
    mine = F.col(CANDIDATE) == candidate
    others = F.count("*").over(in_state) - 1
    asked = F.max(mine.cast("int")).over(in_state) == 1
    moved = F.when(mine, F.col("support") + points).otherwise(F.greatest(F.lit(0.0), F.col("support") - F.lit(points) / others))
    return predictions.withColumn("support", F.when(asked, F.least(F.lit(100.0), moved)).otherwise(F.col("support")))


# Outcomes


def uniform(key: Column) -> Column:
    """A fixed number within (0, 1) for a key, the same in every run and engine."""
    return (stable_number(key) + F.lit(0.5)) / F.lit(4294967296.0)


def normal(key: Column) -> Column:
    """A fixed standard normal number for a key (Box-Muller on two hashes)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(F.concat(key, F.lit("|r")))))
    return radius * F.cos(F.lit(6.283185307179586) * uniform(F.concat(key, F.lit("|a"))))


def state_votes(spark: SparkSession, votes: dict[str, int] = STATE_VOTES) -> DataFrame:
    return values_frame(spark, f"{STATE} STRING, votes BIGINT", list(votes.items()))


def draw_outcomes(
    predictions: DataFrame, votes: DataFrame, draws: int = 10_000, std: float = 2.0, per_row: int = 100, partitions: int | None = None
) -> DataFrame:
    """Winner and votes of every (draw, state): support plus noise, first largest wins.

    The candidates of a state stand in one row, so a winner needs no shuffle;
    draws are unfolded in two steps, with the rows spread over the cluster in between.
    States without votes count 0.
    """
    per_state = predictions.groupBy(STATE).agg(F.sort_array(F.collect_list(F.struct(CANDIDATE, "support"))).alias("_field"))
    voted = per_state.join(votes, STATE, "left").withColumn("votes", F.coalesce("votes", F.lit(0)))
    batches = (draws + per_row - 1) // per_row
    # A fixed number of partitions: the rows are few and small before they are unfolded,
    # so a number chosen by their size would be 1.
    count = partitions or 2 * predictions.sparkSession.sparkContext.defaultParallelism
    spread = voted.withColumn("_batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))).repartition(count, STATE, "_batch")
    start = F.col("_batch") * per_row
    drawn = spread.withColumn("draw", F.explode(F.sequence(start, F.least(start + per_row - 1, F.lit(draws - 1)))))
    noisy = F.transform(
        "_field",
        lambda c, place: F.struct(
            (c["support"] + F.lit(std) * normal(F.concat_ws("|", F.col("draw").cast("string"), F.col(STATE), c[CANDIDATE]))).alias("score"),
            (-place).alias("place"),
            c[CANDIDATE].alias("winner"),
        ),
    )
    best = F.array_max(noisy)
    return drawn.select("draw", STATE, "votes", best["winner"].alias("winner"))


def outcome_shares(
    predictions: DataFrame,
    outcomes: DataFrame,
    draws: int,
    needed: int = VOTES_NEEDED,
    bonus_surnames: list[str] = BONUS_SURNAMES,
    bonus: int = BONUS_VOTES,
    bonus_in_threshold: bool = False,
) -> DataFrame:
    """Per candidate: win probability (shares add up to 1), expected votes and mean support.

    The first candidate with a listed surname has ``bonus`` added to the expected
    votes; the threshold leaves it out unless ``bonus_in_threshold`` is set.
    """
    support = predictions.groupBy(CANDIDATE).agg(F.avg("support").alias("expected_popular_vote"))
    listed = F.lit(False)
    for surname in bonus_surnames:
        listed = listed | F.contains(F.col(CANDIDATE), F.lit(surname))
    # One row per candidate from here on.
    first = F.min(F.when(listed, F.col(CANDIDATE))).over(W.partitionBy())
    extra = F.when(F.col(CANDIDATE) == first, F.lit(bonus)).otherwise(F.lit(0))
    field = support.withColumn("_extra", extra)
    won = outcomes.groupBy("draw", "winner").agg(F.sum("votes").alias("_votes"))
    reached = won.groupBy(F.col("winner").alias(CANDIDATE)).agg(
        F.count_if(F.col("_votes") >= needed).alias("_plain"),
        F.count_if(F.col("_votes") >= needed - bonus).alias("_eased"),
        F.sum("_votes").alias("_sum"),
    )
    wins = F.when(F.lit(bonus_in_threshold) & (F.col("_extra") > 0), F.col("_eased")).otherwise(F.col("_plain"))
    totals = field.join(reached, CANDIDATE, "left").select(
        CANDIDATE,
        "expected_popular_vote",
        "_extra",
        (F.coalesce(wins, F.lit(0)) / F.lit(draws)).alias("_wins"),
        (F.coalesce(F.col("_sum"), F.lit(0)) / F.lit(draws)).alias("_mean"),
    )
    total = F.sum("_wins").over(W.partitionBy())
    return totals.select(
        CANDIDATE,
        F.when(total > 0, F.col("_wins") / total).otherwise(F.col("_wins")).alias("win_probability"),
        (F.col("_mean") + F.col("_extra")).alias("expected_electoral_votes"),
        "expected_popular_vote",
    )


def state_shares(predictions: DataFrame, outcomes: DataFrame, draws: int) -> DataFrame:
    """Share of draws each candidate wins in each state, zeros included."""
    wins = outcomes.groupBy(STATE, F.col("winner").alias(CANDIDATE)).agg((F.count("*") / F.lit(draws)).alias("win_share"))
    return predictions.select(STATE, CANDIDATE).join(wins, [STATE, CANDIDATE], "left").select(
        STATE, CANDIDATE, F.coalesce("win_share", F.lit(0.0)).alias("win_share")
    )


def data_summary(window: DataFrame, as_of: str, cycle: int) -> DataFrame:
    """One row on the polls behind a forecast."""
    per_candidate = window.groupBy(CANDIDATE).agg(F.count("*").alias("_n"), F.min(DAYS).alias("_low"), F.max(DAYS).alias("_high"))
    return per_candidate.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_polls"),
        F.count("*").alias("n_candidates"),
        F.coalesce(F.min("_low"), F.lit(0)).alias("most_recent_poll_days_ago"),
        F.coalesce(F.max("_high"), F.lit(0)).alias("oldest_poll_days_ago"),
    ).withColumns({"nowcast_date": F.lit(as_of), "target_column": F.lit(target_column(cycle))})


@dataclass(frozen=True)
class Forecast:
    predictions: DataFrame
    shares: DataFrame
    state_shares: DataFrame
    scores: DataFrame
    importances: DataFrame
    summary: DataFrame


def run_forecast(
    polls: DataFrame,
    candidates: list[str],
    as_of: str,
    cycle: int,
    states: list[str] | None = None,
    lookback_days: int = 60,
    draws: int = 10_000,
    shy_points: float = 0.0,
    shy_candidate: str = "",
    std: float = 2.0,
    trees: int = 100,
    votes: dict[str, int] = STATE_VOTES,
    row_id: str = "poll_id",
    tie: list[str] | None = None,
) -> Forecast:
    """Window, features, models, predictions, outcomes and summary in one call.

    The window is read by every step after it, so it is written once.
    """
    spark = polls.sparkSession
    window = stage(poll_window(polls, candidates, as_of, cycle, lookback_days, states), "poll-window")
    models = fit_models(features(window, cycle, row_id, tie), cycle, trees=trees, split_key=row_id)
    if not models:
        raise ValueError("no candidate has enough polls")
    names = states or [s for s in votes if s != "National"]
    grid = values_frame(spark, f"{STATE} STRING", [(s,) for s in names])
    inputs = serving_inputs(window, grid, [m.candidate for m in models], cycle)
    raw_predictions = predict(models, serving_features(inputs, state_codes(window)))
    predictions = shy_adjusted(raw_predictions, shy_candidate, shy_points)
    outcomes = draw_outcomes(predictions, state_votes(spark, votes), draws, std)
    return Forecast(
        predictions,
        outcome_shares(predictions, outcomes, draws),
        state_shares(predictions, outcomes, draws),
        model_scores(spark, models),
        feature_importances(spark, models),
        data_summary(window, as_of, cycle),
    )
