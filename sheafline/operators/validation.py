"""Record rules, storage rules, routing by validity, and checks of user input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonio import has_key, field_text
from ..functions.polls import lenient_float
from ..functions.text import strip
from ..vocab import ARTICLE_REQUIRED, MIN_CONTENT_LENGTH, MOJIBAKE_PATTERNS, values_frame

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class Fields:
    """The fields of a record: typed columns (null = absent), or a JSON text column."""

    def __init__(self, df: DataFrame, json: str | None = None):
        self._df, self._json = df, json
        self._types = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def has(self, name: str) -> Column:
        if self._json:
            return has_key(F.col(self._json), name)
        return F.col(name).isNotNull() if name in self._types else F.lit(False)

    def text(self, name: str) -> Column:
        if self._json:
            return field_text(F.col(self._json), name)
        return F.col(name).cast("string") if name in self._types else F.lit(None).cast("string")

    def whole(self, name: str) -> Column:
        """As a whole number: typed numbers lose their fraction, text has to be a whole number as it stands; else null."""
        if not self._json and self._types.get(name, "").startswith(_NUMERIC):
            return F.col(name).try_cast("bigint")
        return self.text(name).try_cast("bigint")

    def empty(self, name: str) -> Column:
        """Null, ``''``, and for typed columns 0, false and empty arrays and maps."""
        if self._json or name not in self._types:
            return self.text(name).isNull() | (self.text(name) == "")
        kind = self._types[name]
        if kind.startswith(("array", "map")):
            return F.coalesce(F.size(name) <= 0, F.lit(True))
        if kind.startswith(_NUMERIC):
            return F.coalesce(F.col(name) == 0, F.lit(True))
        if kind == "boolean":
            return ~F.coalesce(F.col(name), F.lit(False))
        return F.col(name).isNull() | (F.col(name).cast("string") == "")


def collect_errors(rules: list[tuple[Column, Column | str]]) -> Column:
    """Array of the messages whose test holds; a null test does not hold."""
    messages = [F.when(test, F.lit(m) if isinstance(m, str) else m) for test, m in rules]
    return F.array_compact(F.array(*messages))


def has_mojibake(c: Column, patterns: list[str] = MOJIBAKE_PATTERNS) -> Column:
    """Any sign of a broken decode. Patterns that hold another one are not searched for twice."""
    needed = [p for p in patterns if not any(q != p and q in p for q in patterns)]
    test = F.contains(c, F.lit(needed[0]))
    for pattern in needed[1:]:
        test = test | F.contains(c, F.lit(pattern))
    return test


# The message texts below are fixed values: they are stored with the rows.


def record_errors(
    fields: Fields,
    required: list[str] = ARTICLE_REQUIRED,
    check_content: bool = True,
    min_length: int = MIN_CONTENT_LENGTH,
    patterns: list[str] = MOJIBAKE_PATTERNS,
) -> Column:
    """Rule errors of a collected record: required fields, content, language, URL."""
    names = sorted(required)
    missing = F.array_compact(F.array(*[F.when(~fields.has(n), F.lit(n)) for n in names]))
    rules: list[tuple[Column, Column | str]] = [
        (F.size(missing) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(missing, ", ")))
    ]
    rules += [(fields.has(n) & fields.empty(n), f"Field '{n}' is empty") for n in names]
    if check_content:
        content = fields.text("content")
        rules.append((F.length(strip(content)) < min_length, f"Content too short <{min_length} characters."))
        rules.append((has_mojibake(content, patterns), "Potential encoding issues in content"))
    language, url = fields.text("language"), fields.text("url")
    rules.append(
        (
            fields.has("language") & F.coalesce(F.length(language) != 2, F.lit(True)),
            F.concat(F.lit("Invalid language code: "), F.coalesce(language, F.lit("None"))),
        )
    )
    rules.append(
        (
            fields.has("url") & ~F.coalesce(F.startswith(url, F.lit("http://")) | F.startswith(url, F.lit("https://")), F.lit(False)),
            F.concat(F.lit("Invalid URL format: "), F.coalesce(url, F.lit("None"))),
        )
    )
    return collect_errors(rules)


def batch_verdict(checked: DataFrame, errors: str = "errors") -> DataFrame:
    """One row: records, error count, and whether the batch passes (some records, no error)."""
    return checked.agg(
        F.count("*").alias("record_count"),
        F.coalesce(F.sum(F.size(errors)), F.lit(0)).alias("error_count"),
    ).withColumn("passed", (F.col("record_count") > 0) & (F.col("error_count") == 0))


def first_errors(checked: DataFrame, key: str, errors: str = "errors", limit: int = 10) -> DataFrame:
    """The first errors of a batch by record key, for a report."""
    exploded = checked.select(key, F.posexplode(errors).alias("place", "message"))
    return exploded.orderBy(key, "place").limit(limit)


def article_errors(fields: Fields, required: list[str] = ARTICLE_REQUIRED, min_length: int = MIN_CONTENT_LENGTH) -> Column:
    """Rule errors of an article before storage."""
    rules: list[tuple[Column, Column | str]] = []
    for name in required:
        rules.append((~fields.has(name), f"Missing required field: {name}"))
        rules.append((fields.has(name) & fields.empty(name), f"Empty required field: {name}"))
    content = fields.text("content")
    rules.append(
        (
            F.length(strip(content)) < min_length,
            F.concat(F.lit("Content too short: "), F.length(content).cast("string"), F.lit(" char")),
        )
    )
    return collect_errors(rules)


def poll_errors(fields: Fields) -> Column:
    """Rule errors of a poll before storage: 13 rules on names, ranges, dates and consistency."""
    # Limits of the poll rules.
    required = ["cycle", "state", "candidate_name", "pct_estimate"]
    first_cycle, last_cycle, longest_state, longest_name, widest_gap = 1968, 2024, 50, 100, 50
    rules: list[tuple[Column, Column | str]] = []
    for name in required:
        rules.append((~fields.has(name), f"Missing required field: {name}"))
        rules.append((fields.has(name) & fields.text(name).isNull(), f"Required field is null: {name}"))

    text = fields.text

    def shown(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    # A number is cut to a whole one; a text has to be one.
    cycle = fields.whole("cycle")
    rules.append((text("cycle").isNotNull() & cycle.isNull(), F.concat(F.lit("Cycle must be an integer: "), text("cycle"))))
    rules.append(
        (
            ~cycle.between(first_cycle, last_cycle),
            F.concat(F.lit("Invalid cycle: "), shown(cycle), F.lit(f". Expected between {first_cycle} and {last_cycle}")),
        )
    )
    for name, label, longest in (("state", "State", longest_state), ("candidate_name", "Candidate name", longest_name)):
        size = F.length(strip(text(name)))
        long_label = "State name" if name == "state" else label
        rules.append((size == 0, f"{label} cannot be empty"))
        rules.append(
            (size > longest, F.concat(F.lit(f"{long_label} too long: "), shown(size), F.lit(f" characters (max {longest})")))
        )
    for name, label, short in (
        ("pct_estimate", "Percentage estimate", "percentage estimate"),
        ("pct_trend_adjusted", "Trend-adjusted percentage", "trend-adjusted percentage"),
    ):
        value = text(name).try_cast("double")
        rules.append((text(name).isNotNull() & value.isNull(), F.concat(F.lit(f"{label} must be a number: "), text(name))))
        rules.append(
            (
                ~F.isnan(value) & ((value < 0) | (value > 100)),
                F.concat(F.lit(f"Invalid {short}: "), shown(value), F.lit(". Must be between 0.0 and 100.0")),
            )
        )
    candidate_id = fields.whole("candidate_id")
    rules.append(
        (text("candidate_id").isNotNull() & candidate_id.isNull(), F.concat(F.lit("Candidate ID must be an integer: "), text("candidate_id")))
    )
    rules.append((candidate_id <= 0, F.concat(F.lit("Candidate ID must be positive: "), shown(candidate_id))))
    for name in ("modeldate", "election_date", "timestamp", "collected_at"):
        rules.append((F.length(strip(text(name))) == 0, f"{name} cannot be empty string"))
    rules.append(
        (
            fields.has("language") & F.coalesce(text("language") != "en", F.lit(True)),
            F.concat(F.lit("Invalid language code: "), shown(text("language")), F.lit(". Expected 'en' for FiveThirtyEight data")),
        )
    )
    estimate, trend = lenient_float(text("pct_estimate")), lenient_float(text("pct_trend_adjusted"))
    rules.append(
        (
            F.abs(estimate - trend) > widest_gap,
            F.concat(
                F.lit("Large difference between estimate ("), shown(estimate), F.lit(") and trend-adjusted ("), shown(trend),
                F.lit("): "), shown(F.abs(estimate - trend)), F.lit("%"),
            ),
        )
    )
    return collect_errors(rules)


def error_document(errors: Column) -> Column:
    """Stored form of rule errors: JSON, or null when there are none."""
    return F.when(F.size(errors) > 0, F.to_json(F.struct(errors.alias("validation_errors"))))


def route(df: DataFrame, errors: str = "errors", validate: bool = True) -> DataFrame:
    """Give each row ``validation_status`` and ``validation_error``; without validation it is pending."""
    if not validate:
        return df.withColumns(
            {"validation_status": F.lit("pending"), "validation_error": F.lit(None).cast("string")}
        )
    status = F.when(F.size(errors) == 0, "valid").otherwise("invalid")
    return df.withColumns({"validation_status": status, "validation_error": error_document(F.col(errors))})


def failure_document(message: Column, kind: str = "ValueError") -> Column:
    """Stored form of a row whose transform could not run."""
    return F.to_json(
        F.struct(message.alias("error"), F.lit(kind).alias("error_type"), F.lit(True).alias("cleaning_failed"))
    )


def target_outcomes(targets: DataFrame, saved: DataFrame, target_col: str = "collection_target_id") -> DataFrame:
    """``collected`` for targets with at least one saved row, else ``failed``."""
    hit = saved.groupBy(F.col(target_col).alias("id")).agg(F.count("*").alias("saved_count"))
    return targets.select("id").join(hit, "id", "left").select(
        "id",
        F.coalesce("saved_count", F.lit(0)).alias("saved_count"),
        F.when(F.col("saved_count") > 0, "collected").otherwise("failed").alias("collection_status_name"),
    )


def failed_check_targets(checked: DataFrame) -> DataFrame:
    """Targets that become ``check_failed``: every checked target that was not found."""
    failed = checked.filter(F.col("test_status") != "success")
    return failed.select(F.col("collection_target_id").alias("id"), F.lit("check_failed").alias("collection_status_name")).distinct()


def unknown_inputs(available: DataFrame, requested: dict[str, list[str]]) -> DataFrame:
    """Requested names that do not exist, of all kinds together.

    ``available`` holds ``kind, name``; ``requested`` maps a kind to names.
    """
    rows = [(kind, name) for kind, names in requested.items() for name in names]
    asked = values_frame(available.sparkSession, "kind STRING, name STRING", rows)
    return asked.join(available.select("kind", "name"), ["kind", "name"], "left_anti").distinct()


def available_inputs(targets: DataFrame, types: DataFrame, statuses: DataFrame) -> DataFrame:
    """``kind, name`` of the types and languages in use and of all statuses."""
    used = targets.select(F.col("collection_type_id").alias("id")).distinct().join(types, "id")
    return (
        used.select(F.lit("type").alias("kind"), "name")
        .unionByName(targets.select(F.lit("language").alias("kind"), F.col("language_code").alias("name")).distinct())
        .unionByName(statuses.select(F.lit("status").alias("kind"), "name"))
    )
